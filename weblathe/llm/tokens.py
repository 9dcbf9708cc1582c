"""Token ids of a byte-level BPE vocabulary, exactly as the tokenizers library gives them, with a chunk cache.

A text is encoded chunk by chunk, a chunk being a blank and what follows it up to the next blank. That gives the ids of
the whole text because the vocabulary's split pattern never joins what stands before a blank to the blank, unless the
blank touches other white space; texts where it does are encoded whole. New chunks go through tiktoken's ranks of the
same vocabulary, which is several times as fast; texts with characters beyond the Latin blocks or with a special token's
string go through the tokenizers library itself.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np

#: Chunks that a worker remembers, and the longest that it remembers; both bound memory only.
CACHED, CACHED_CHARS = 200_000, 40
_TOUCHING = re.compile(r" \s|\s ")
_WIDE = re.compile("[^\x00-ɏ]")
SPECIAL = "<|endoftext|>"


class ByteBpe:
    """ids(text): little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, library_file: str, ranks_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(library_file)
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        outer = self

        class Chunks(dict):
            def __init__(self, lead: str):
                self.lead = lead

            def __missing__(self, chunk: str) -> bytes:
                ids = outer.whole(self.lead + chunk)
                if len(chunk) <= CACHED_CHARS:
                    if len(self) >= CACHED:
                        self.clear()
                    self[chunk] = ids
                return ids

        self.later = Chunks(" ")

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids if SPECIAL in text or _WIDE.search(text) else self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if SPECIAL in text or _TOUCHING.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.later.__getitem__, rest))


@cache
def byte_bpe(library_file: str | None = None, ranks_file: str | None = None) -> ByteBpe:
    """The worker's encoder; without files, the public 50k vocabulary of this machine."""
    import public_tokenizers

    return ByteBpe(
        library_file or public_tokenizers.path("byte_bpe_50k.json"),
        ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
