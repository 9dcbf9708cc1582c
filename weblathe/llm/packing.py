"""Best-fit packing of documents into token sequences by fitted length patterns.

1. Texts become token ids (Arrow batches) and pieces of at most ``width`` tokens; only their lengths and checksums stay.
2. The histogram of lengths (``width`` rows at most) goes to the driver. Patterns of two or three lengths that fill a
   sequence are fitted to it by non-negative least squares: patterns enter by their gradient, so all of them count
   without a matrix of all. Repeat counts are rounded, down first and then up by the largest remainder as far as the
   histogram holds, and what is left is fitted again until nothing more rounds. Pieces of up to ``width / RESERVE`` are no
   part of the fit: they fill the gaps of the residuals, which are packed best fit first, longest first, over lengths and
   counts. Where the plan needs more sequences than best fit alone would (it can on small tables), the last patterns go
   back to the residuals until it doesn't. The plan's size depends on ``width``, not on the corpus.
3. Each piece gets its rank among the pieces of its length (counts of small groups, then a row number within the group)
   and reads its sequence and offset from the plan. A row's group comes from its number in the stored table of pieces, so
   neither a common length nor a repeated doc_id meets in one task.

Cases: null or empty text is the end id alone; a text of any length is cut, never shortened; equal lengths are placed in
the order of group, doc_id and piece; repeated rows are packed each; empty tables give no rows; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches
from .tokens import byte_bpe

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
Pattern = tuple[int, ...]


def tokenize(df: DataFrame, width: int = 1024, end_id: int = 2, with_ids: bool = False, files: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Pieces of every row's text; ``with_ids`` adds each piece's ids (binary, little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = byte_bpe(*files), int(end_id).to_bytes(4, "little")
        for batch in small_batches(batches):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                n = len(ids) // 4
                at, k, size = 0, 0, n % width or min(n, width)
                while at < n:
                    own = ids[4 * at : 4 * (at + size)]
                    for column, value in zip(out, (doc_id, k, at, size, zlib.crc32(own), own), strict=True):
                        column.append(value)
                    at, k, size = at + size, k + 1, width
            arrays = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 6 if with_ids else 5], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5])

    rows = df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def _price(g: np.ndarray, width: int, most: int) -> list[Pattern]:
    """The patterns of two and three lengths that sum to ``width`` with the largest positive gradient."""
    half = np.arange(1, width // 2 + 1)
    pairs = g[half] + g[width - half]
    found = [(float(pairs[k]), (int(width - half[k]), int(half[k]))) for k in np.argsort(-pairs)[:most]]
    i, j = np.arange(1, width // 3 + 1)[:, None], np.arange(1, width)[None, :]
    k = width - i - j
    triples = np.where((j >= i) & (k >= j), g[i] + g[j] + g[np.clip(k, 0, width)], -np.inf)
    for at in np.argpartition(-triples, min(most, triples.size - 1), axis=None)[:most]:
        a, b = int(at) // triples.shape[1] + 1, int(at) % triples.shape[1] + 1
        found.append((float(triples[a - 1, b - 1]), (width - a - b, b, a)))
    return [p for gain, p in sorted(found, reverse=True)[:most] if gain > 1e-6]


def fit_patterns(counts: dict[int, int], width: int, rounds: int = 20, batch: int = 128, sweeps: int = 8) -> dict[Pattern, float]:
    """Non-negative least squares of pattern repeats against the histogram, by rounds of pricing and descent.

    Long pieces weigh more: they are the hard ones to place later.
    """
    h = np.zeros(width + 1)
    for length, n in counts.items():
        h[length] = n
    h[width] = 0  # full pieces are sequences as they are
    scale = h.sum()
    if not scale:
        return {}
    weight = np.sqrt(np.arange(width + 1) / width)
    target = weight * h / scale
    patterns: list[Pattern] = []
    columns = np.zeros((width + 1, 0))
    x, known = np.zeros(0), set()
    residual = target.copy()
    for _ in range(rounds):
        gradient = weight * residual
        gradient[h == 0] = -1.0  # a length that no piece has can't be used
        new = [p for p in _price(gradient / max(1e-12, np.abs(residual).max()), width, batch) if p not in known and all(h[v] for v in p)]
        if not new:
            break
        known.update(new)
        patterns += new
        more = np.zeros((width + 1, len(new)))
        for k, p in enumerate(new):
            for v in p:
                more[v, k] += weight[v]
        columns = np.hstack([columns, more])
        x = np.concatenate([x, np.zeros(len(new))])
        gram, right = columns.T @ columns, columns.T @ target
        diagonal = np.diag(gram).copy()
        slope = gram @ x - right
        for _ in range(sweeps):
            for k in range(len(x)):
                step = max(0.0, x[k] - slope[k] / diagonal[k]) - x[k]
                if step:
                    x[k] += step
                    slope += step * gram[:, k]
        residual = target - columns @ x
    return {p: float(v) * scale for p, v in zip(patterns, x, strict=True) if v > 0}


def best_fit(counts: dict[int, int], width: int) -> dict[Pattern, int]:
    """Best fit, longest first, over lengths and counts: equal bins move together."""
    bins: dict[int, dict[Pattern, int]] = defaultdict(lambda: defaultdict(int))
    spaces = np.zeros(width + 1, bool)
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left = counts[length]
        while left:
            fitting = np.flatnonzero(spaces[length:])
            if not len(fitting):
                # a new bin takes as many of this length as it can: they would fill it one after another
                each = width // length
                whole, rest = divmod(left, each)
                for repeat, n in ((each, whole), (rest, 1)):
                    if repeat and n:
                        bins[width - repeat * length][(length,) * repeat] += n
                        spaces[width - repeat * length] = True
                break
            space = int(fitting[0]) + length
            pattern, n = next(iter(bins[space].items()))
            each = min(space // length, left)
            n = min(n, left // each)
            bins[space][pattern] -= n
            if not bins[space][pattern]:
                del bins[space][pattern]
            bins[space - each * length][(*pattern, *(length,) * each)] += n
            spaces[space - each * length] = True
            spaces[space] = bool(bins[space])
            left -= n * each
    out: dict[Pattern, int] = defaultdict(int)
    for own in bins.values():
        for pattern, n in own.items():
            out[pattern] += n
    return out


#: Pieces of up to width / RESERVE stay out of the fit.
RESERVE = 8


def round_patterns(fitted: dict[Pattern, float], left: dict[int, int]) -> list[tuple[Pattern, int]]:
    """Whole repeats of fitted patterns, taken out of ``left``: rounded down, then up by the largest remainder."""
    out = []
    for up in (False, True):
        for pattern, x in sorted(fitted.items(), key=lambda p: (-(p[1] % 1 if up else p[1]), p[0])):
            want = int(x % 1 > 0.05) if up else int(x)
            n = min([want, *(left[v] // pattern.count(v) for v in pattern)])
            if n > 0:
                out.append((pattern, n))
                for v in pattern:
                    left[v] -= n
    return out


def plan(counts: dict[int, int], width: int) -> dict[Pattern, int]:
    """Patterns and how often each is used; together they hold every piece once, in no more sequences than best fit."""
    left = dict(counts)
    full = left.pop(width, 0)
    most = sum(best_fit(left, width).values())
    small = {v: left.pop(v) for v in sorted(left) if v <= width // RESERVE}
    taken: list[tuple[Pattern, int]] = []
    while got := round_patterns(fit_patterns(left, width), left):
        taken += got
    left |= small
    rest = best_fit(left, width)
    while taken and sum(n for _, n in taken) + sum(rest.values()) > most:
        back = max(1, len(taken) // 16)
        for pattern, n in taken[-back:]:
            for v in pattern:
                left[v] += n
        taken = taken[:-back]
        rest = best_fit(left, width)
    used: dict[Pattern, int] = defaultdict(int)
    if full:
        used[(width,)] = full
    for pattern, n in [*taken, *rest.items()]:
        used[pattern] += n
    return used


def _layout(used: dict[Pattern, int]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, sequence of the first rank, offset)."""
    rows, ranks, sequence = [], defaultdict(int), 0
    for pattern, n in sorted(used.items(), reverse=True):
        offset = 0
        for length in pattern:
            rows.append((length, ranks[length], ranks[length] + n, sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    return rows


def pack_pieces(pieces: DataFrame, width: int = 1024, row: str = "_row") -> DataFrame:
    """Add sequence_id and offset to pieces: a stored table with length and ``row``, a number of its own for every row."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # about four groups a task; at most `width` rows more than that, and a plan of a size that the corpus doesn't change
    each = max(1, -(-sum(counts.values()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    groups = spark.createDataFrame([(k, -(-n // each)) for k, n in counts.items()], "length bigint, _groups bigint")
    layout = spark.createDataFrame(_layout(plan(counts, width)), "length bigint, _from bigint, _to bigint, _sequence bigint, _offset bigint")
    ranked = pieces.join(F.broadcast(groups), "length").withColumn("_group", F.pmod(F.xxhash64(row), F.col("_groups")))
    before = "sum(n) OVER (PARTITION BY length ORDER BY _group ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS _before"
    starts = ranked.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("n")).selectExpr("length", "_group", before)
    number = F.expr(f"row_number() OVER (PARTITION BY length, _group ORDER BY doc_id, piece, start, ids_crc32, {row})")
    ranked = ranked.withColumn("_n", number).join(F.broadcast(starts), ["length", "_group"]).withColumn("_rank", F.col("_before") + F.col("_n") - 1)
    inside = (ranked["length"] == layout["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(layout), inside).drop(layout["length"])
    kept = [c for c in pieces.columns if c != row]
    return placed.select(*kept, (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack(df: DataFrame, width: int = 1024, end_id: int = 2, with_ids: bool = False, files: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Pack every row of ``df`` (doc_id, text); see the module's text."""
    pieces = Scratch(df.sparkSession).keep(tokenize(df, width, end_id, with_ids, files).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    return pack_pieces(pieces, width)
