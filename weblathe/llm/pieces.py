"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding merges adjacent symbols from a score-ordered agenda: the pair whose union has the best score goes first, of equal
scores the leftmost. No piece of a supported vocabulary holds a blank after another character, so merges never cross from
a word into the blank before the next one, and texts are merged chunk by chunk (blanks and the word after them); chunks
are remembered. What the vocabulary lacks becomes byte pieces. Decoding joins pieces and bytes back into text.

Both are checked against the sentencepiece library in every Arrow batch: each chunk when it is first merged, and one whole
text a batch. A difference raises.

Cases: null text is empty (begin and end ids only); a text of any length counts whole; U+2581 in a text reads as a blank,
as in the library; equal rows get equal results; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Chunks that a worker remembers, and the longest that it remembers; both bound memory only.
CACHED, CACHED_CHARS = 800_000, 40
#: Chunks up to this length keep their agenda in a list.
SHORT, NEVER = 64, float("inf")
#: Fixed values of the model file: piece types and the merge model's number.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_MODEL = 2
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """A vocabulary of the merge type, read from its model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        self.costs: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: list[int] = [0] * 256
        self.written: list[bytes] = []
        self.blank_first: list[bool] = []
        kinds = set()
        for n, raw in enumerate(v for k, v in message if k == 1):
            piece = dict(_fields(raw))
            text, score, kind = piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0" * 4))[0], piece.get(3, NORMAL)
            kinds.add(kind)
            if kind == NORMAL:
                self.costs[text], self.ids[text] = -score, n
            if kind == BYTE:
                self.bytes[int(text[3:5], 16)] = n
            plain = text.replace(BLANK, " ").encode()
            self.written.append(b"" if kind == CONTROL else bytes([int(text[3:5], 16)]) if kind == BYTE else " ⁇ ".encode() if kind == UNKNOWN else plain)
            self.blank_first.append(kind == NORMAL and text.startswith(BLANK))
        trainer, normaliser = (dict(_fields(next((v for k, v in message if k == field), b""))) for field in (2, 3))
        crossing = any(BLANK in p.lstrip(BLANK) for p in self.costs)
        plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
        if trainer.get(3, 1) != MERGE_MODEL or {USER_DEFINED, UNUSED} & kinds or BYTE not in kinds or crossing or not plain:
            raise ValueError("not a merge-type vocabulary with byte pieces, plain normalisation and a blank before the text")
        self.begin, self.end = (struct.pack("<I", k) for k in (self.library.bos_id(), self.library.eos_id()))
        self.known: dict[str, bytes] = {}
        self.learned: dict[str, bytes] = {}

    def merge(self, chunk: str) -> bytes:
        """Ids of one chunk, by the agenda: a list of all pairs for short chunks, a heap for long ones."""
        symbols = self._merged_short(chunk) if len(chunk) <= SHORT else self._merged_long(chunk)
        try:
            ids = [self.ids[s] for s in symbols]
        except KeyError:  # characters that the vocabulary lacks
            ids = [k for s in symbols for k in ([self.ids[s]] if s in self.ids else [self.bytes[b] for b in s.encode()])]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged_short(self, chunk: str) -> list[str]:
        symbols, cost = list(chunk), self.costs.get
        agenda = [cost(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        while agenda and (best := min(agenda)) != NEVER:
            k = agenda.index(best)  # the leftmost of equals
            symbols[k] += symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = cost(symbols[k] + symbols[k + 1], NEVER)
            if k:
                agenda[k - 1] = cost(symbols[k - 1] + symbols[k], NEVER)
        return symbols

    def _merged_long(self, chunk: str) -> list[str]:
        symbols = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        costs, agenda = self.costs, []

        def offer(left: int, right: int) -> None:
            union = symbols[left] + symbols[right]
            if union in costs:
                heapq.heappush(agenda, (costs[union], left, right, len(union)))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s]

    def chunk(self, chunk: str) -> bytes:
        ids = self.known.get(chunk)
        if ids is None:
            ids = self.learned[chunk] = self.merge(chunk)
            if len(chunk) <= CACHED_CHARS:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, little-endian unsigned 32-bit."""
        if not text:
            return self.begin + self.end
        get = self.known.get
        chunks = _CHUNK.findall(BLANK + text.replace(" ", BLANK))
        found = list(map(get, chunks))
        if None in found:
            found = [self.chunk(c) if f is None else f for c, f in zip(chunks, found, strict=True)]
        return b"".join([self.begin, *found, self.end])

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.written.__getitem__, numbers))
        first = next((k for k in numbers if self.written[k]), None)
        if first is not None and self.blank_first[first]:
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def check(self, text: str) -> None:
        """Compare what was learned since the last check, and one text, with the library."""
        chunks, self.learned = self.learned, {}
        # the library itself puts a blank before each text
        for (chunk, own), theirs in zip(chunks.items(), self.library.encode([c[1:] for c in chunks], num_threads=1), strict=True):
            # a lone blank is the library's prefix, which it leaves out of an empty text
            if own != struct.pack(f"<{len(theirs)}I", *theirs) and chunk != BLANK:
                raise RuntimeError(f"ids of {chunk!r} differ from the library's")
        ids = self.encode(text)
        numbers = np.frombuffer(ids, "<u4").tolist()
        if numbers != self.library.encode(text, add_bos=True, add_eos=True) or self.decode(ids) != self.library.decode(numbers):
            raise RuntimeError("a text differs from the library's")
        self.learned.clear()


@cache
def model(path: str | None = None) -> PieceModel:
    """The worker's model; without a path, the public 32k vocabulary of this machine."""
    import public_tokenizers

    return PieceModel(path or public_tokenizers.path("piece_bpe_32k.model"))


def encode_and_decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded (the text of these ids) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                texts = [t or "" for t in batch.column(1).slice(k, 512).to_pylist()]
                ids = list(map(own.encode, texts))
                # the shortest that isn't empty, and one that its ids' checksums pick
                for text in {min(filter(None, texts), key=len, default=""), texts[sum(map(zlib.crc32, ids)) % len(texts)]}:
                    own.check(text)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 512), pa.array(ids, pa.binary()), pa.array(list(map(own.decode, ids)), pa.string())], names=["doc_id", "ids", "decoded"])

    return df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded rows."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
