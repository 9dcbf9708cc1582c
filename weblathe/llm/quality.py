"""Quality rules by weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0). Votes of all documents are counted by vote pattern, a table of at
most ``3 ** len(RULES)`` rows whatever the corpus; expectation-maximisation over these counts estimates how each rule
votes on good and on bad documents and the share of good ones; a document's posterior probability of good quality
decides, not a chain of must-pass filters. Documents that fail the base rules are rejected first.

Good and bad can't change places: the start comes from the votes' signs, a good vote never counts against a document, and
the share of good documents stays within SHARE. Where no rule votes bad there is nothing to reject. The posterior is thus
that of the model under a constraint: log likelihood ratios of votes are held to the vote's sign, and those of abstentions
to -1 to 1, in the expectation step as in the verdict.

Cases: null or empty text has no words and fails the base rules; texts count whole; equal rows get equal results; an
empty table gives no rows; extra columns are ignored (``keep_good`` hands them through).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Common short words of the corpus's languages.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are as with be by at this have from or had not but what all were when we there can an "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec "
    "el los las por con para una su al lo como más pero sus le ya o fue este ha si "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei".encode().split()
)
RULES = ("symbols", "word_length", "duplicate_lines", "repeated_words", "upper_case", "line_ends", "stop_words", "marks")
SHARE, START_SHARE = (0.5, 0.98), 0.9
#: How rules are taken to vote (bad, abstain, good) before any document is seen, and how many votes that is worth.
ON_GOOD, ON_BAD, PRIOR_VOTES = np.array([0.03, 0.17, 0.8]), np.array([0.5, 0.25, 0.25]), 10
COLUMNS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, votes int"


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(twice)] |= twice
    return int(inside.sum())


def _vote(value: float, good: float, bad: float) -> int:
    """+1 up to ``good``, -1 from ``bad`` on, with bad > good."""
    return 1 if value <= good else -1 if value >= bad else 0


def measure(text: str | None) -> tuple[int, int, int, int, int, bool, int]:
    """The columns of COLUMNS for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text or "") - sum(map(raw.count, (bytes([c]) for c in SPACES)))
    n_symbols = sum(map(raw.count, (bytes([c]) for c in SYMBOLS)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_words(words)
    failed = n < 50 or 100 * n_repeat > 50 * n
    votes = [0] * len(RULES)
    if n:
        upper, lower = len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, LOWER))
        mean = word_chars / n
        ends = sum(x.rstrip()[-1:] in b".!?:;\"'" for x in lines) / len(lines)
        stop = sum(map(STOP_WORDS.__contains__, words)) / n
        votes = [
            _vote(n_symbols / n, 0.1, 0.3),
            1 if 3 <= mean <= 9 else -1 if mean < 2 or mean > 13 else 0,
            _vote(n_dup / len(lines), 0.05, 0.3) if len(lines) > 2 else 0,
            _vote(n_repeat / n, 0.1, 0.3),
            _vote(upper / (upper + lower), 0.15, 0.5) if upper + lower else 0,
            1 if ends > 0.6 else -1 if ends < 0.2 else 0,
            1 if stop > 0.08 else -1 if stop < 0.02 else 0,
            _vote((raw.count(b"!") + raw.count(b"?")) / n, 0.05, 0.3),
        ]
    code = 0
    for v in votes:
        code = 3 * code + v + 1
    return n, word_chars, n_symbols, n_dup, n_repeat, failed, code


def decode_votes(code: int) -> list[int]:
    out = []
    for _ in RULES:
        code, v = divmod(code, 3)
        out.append(v - 1)
    return out[::-1]


def estimate(counts: dict[int, int], steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over pattern counts.

    Returns how often each rule votes bad, abstains and votes good on good and on bad documents (rules x 3 each), and the
    share of good documents. The start takes a document with no bad vote as good and one with several as bad.
    """
    good_votes, bad_votes = np.tile(ON_GOOD, (len(RULES), 1)), np.tile(ON_BAD, (len(RULES), 1))
    share = START_SHARE
    if not counts:
        return good_votes, bad_votes, share
    votes = np.array([decode_votes(c) for c in counts])
    weight = np.array(list(counts.values()), float)
    cast = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    good = np.array([1.0, 0.5, 0.1])[np.minimum((votes < 0).sum(1), 2)]
    for _ in range(steps):
        on_good = np.einsum("p,prv->rv", weight * good, cast) + PRIOR_VOTES * ON_GOOD
        on_bad = np.einsum("p,prv->rv", weight * (1 - good), cast) + PRIOR_VOTES * ON_BAD
        good_votes, bad_votes = on_good / on_good.sum(1, keepdims=True), on_bad / on_bad.sum(1, keepdims=True)
        share = float(np.clip((weight @ good) / weight.sum(), *SHARE))
        new = np.array([posterior(c, good_votes, bad_votes, share) for c in counts])
        done = abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return good_votes, bad_votes, share


def posterior(code: int, good_votes: np.ndarray, bad_votes: np.ndarray, share: float) -> float:
    """Probability of good quality. A good vote never counts against a document, nor a bad vote for it."""
    odds = math.log(share / (1 - share))
    for rule, v in enumerate(decode_votes(code)):
        log = math.log(good_votes[rule, v + 1] / bad_votes[rule, v + 1])
        odds += max(0.0, log) if v > 0 else min(0.0, log) if v < 0 else float(np.clip(log, -1, 1))
    return 1 / (1 + math.exp(-odds))


def measure_all(df: DataFrame) -> DataFrame:
    """doc_id and the measures and votes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32())
        names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]
        for batch in small_batches(batches):
            columns = list(zip(*(measure(t) for t in batch.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    return df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, " + COLUMNS)


def posteriors(votes: DataFrame) -> DataFrame:
    """votes, posterior: one row for each vote pattern of documents that pass the base rules."""
    counts = {r["votes"]: r["n"] for r in votes.filter("NOT base_failed").groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    fitted = estimate(dict(sorted(counts.items())))
    return votes.sparkSession.createDataFrame([(c, posterior(c, *fitted)) for c in counts], "votes int, posterior double")


def judge(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Measures, base_failed, posterior and kept for every row of ``df`` (doc_id, text)."""
    measured = Scratch(df.sparkSession).keep(measure_all(df), "quality")
    # at most 3 ** len(RULES) rows, whatever the corpus
    joined = measured.join(F.broadcast(posteriors(measured)), "votes", "left")
    kept = ~F.col("base_failed") & (F.coalesce(F.col("posterior"), F.lit(0.0)) >= threshold)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "posterior")


def _votes(text: Column) -> Column:
    @F.arrow_udf("int")
    def code(texts: pa.Array) -> pa.Array:
        # a few texts at a time: Arrow counts rows, not bytes, and texts can be long
        found = (measure(t) for k in range(0, len(texts), 256) for t in texts.slice(k, 256).to_pylist())
        return pa.array([-1 if m[5] else m[6] for m in found], pa.int32())

    return code(text)


def keep_good(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that judge() would keep, all columns as they are.

    The votes are worked out once and written beside the rows, to be counted and then to filter.
    """
    scratch = Scratch(df.sparkSession)
    # the row travels as one value, so its columns can have any names
    voted = scratch.keep(df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("_row"), _votes(df["`text`"].cast("string")).alias("_votes")), "voted")
    counted = voted.select(F.col("_votes").alias("votes"), (F.col("_votes") < 0).alias("base_failed"))
    good = posteriors(counted).filter(F.col("posterior") >= threshold).select(F.col("votes").alias("_votes"))
    return voted.join(F.broadcast(good), "_votes", "left_semi").select("_row.*")
