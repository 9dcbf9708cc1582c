"""Near-duplicate groups by SetSketch registers, banding, joint likelihood and exact confirmation.

1. Sketch (Arrow batches): a text's distinct word shingles become REGISTERS SetSketch registers, K = floor(1 - log_b x) with
   x the least of exponentially spaced hash values over the set. Registers of a union are the maxima of the registers, so
   sketches merge; for b near 1 two registers agree with about the Jaccard similarity. Four 16-bit registers pack into one
   BIGINT, which is one band.
2. Equal sets (128 bits of set digest) collapse into one node with the smallest doc_id that has it, so exact copies cost
   one row each.
3. Candidates share a band. No bucket is expanded into all its pairs: first its members meet one centre, confirmed links
   are contracted into components, members of other components meet another centre. What is left are pairs *across* the
   components of a bucket: buckets of up to SMALL members are estimated as one block each, without sets, and list their
   likely pairs; in larger ones, the members outside the component of a random member meet all members in blocks of
   bounded bytes, in which pairs are estimated and confirmed in place, so only links leave them. No link between different
   texts can get lost on the way, as pairs within a component add nothing to it.
4. A candidate pair is estimated by maximum likelihood from both sketches and set sizes; pairs far below the threshold go.
   The rest is confirmed on the full sets.
5. Components come from contraction by random priorities, a few rounds in expectation whatever the shape.

At the threshold of 0.75, four registers a band and 32 bands, a linked pair misses every band with probability
(1 - 0.75**4) ** 32 < 6e-6, and fewer still for closer pairs. Likelihood drops a pair whose ratio exceeds e**14; for a pair
at the threshold that has the chance of a normal value beyond sqrt(28) = 5.3 deviations, about 6e-8.

Cases: a document is a row. No words gives an empty set, linked with nothing; fewer words than a shingle make one shingle
of all; rows that repeat doc_id and text get equal results in ``group``, and ``drop_copies`` leaves one of them; rows that
share a doc_id but no text are documents of their own; a row without doc_id is linked with nothing and its component is
null; empty tables give no rows; ``group`` ignores extra columns, ``drop_copies`` hands them through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches

WORDS = 5
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: SetSketch parameters: base, rate and the largest register value less one.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
_random = np.random.default_rng(20240229)
SCALE = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2)
PLACE = _random.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = 2048
#: Buckets up to SMALL members list their pairs; blocks of larger ones hold two chunks of sets of about CHUNK shingles in all.
SMALL, CHUNK = 16, 250_000
#: Pairs that are estimated at a time.
PAIRS = 8192
#: A bucket's rows are dealt over so many tasks.
SALTS = 16
#: Log likelihood ratio beyond which a pair goes. Pairs with at most FEW equal registers are beyond it in any case.
SLACK, FEW = 14.0, 48
CACHED = 150_000


class _Words(dict):
    """Word hashes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


_words = _Words()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """64-bit values of a text's distinct shingles, ascending. Only A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(len(w), WORDS)
    total = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        total += w[k : len(w) - size + 1 + k] * PLACE[k]
    return np.unique(mix(total))


def registers(values: np.ndarray) -> np.ndarray:
    """The SetSketch of a set, packed: BANDS 64-bit integers of ROWS 16-bit registers each."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(values), BLOCK):
        np.minimum(least, (values[k : k + BLOCK, None] * SCALE + SHIFT).min(axis=0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    x = np.maximum(x, 1e-300)
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT + 1).astype("<u2").view("<i8")


def similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, at: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes.

    Rows of ``left`` and ``right`` are registers. Also returns how far the log likelihood of ``at`` lies below the best.
    """
    more, less = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - less
    u, v = n_left / (n_left + n_right), n_right / (n_left + n_right)
    rate, log_base = (BASE - 1) / BASE, np.log(BASE)

    def part(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * rate) / log_base

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = np.maximum(part(u - v * j), 1e-12), np.maximum(part(v - u * j), 1e-12)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    most = np.minimum(u / v, v / u)
    low, high = np.zeros(len(u)), most.copy()
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(a) < likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    best = (low + high) / 2
    return best, likelihood(best) - likelihood(np.minimum(at, most))


def set_digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return int(mix(values ^ SCALE[0]).sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(mix(values ^ SCALE[1]), initial=np.uint64(0)).astype(np.int64))


def sketch(df: DataFrame) -> DataFrame:
    """doc_id, n (set size), set_a, set_b (digest of the set) and bands (packed registers) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n, a, b, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                values = shingles(text)
                n.append(len(values))
                x, y = set_digest(values)
                a.append(x)
                b.append(y)
                bands.append(registers(values).tolist() if len(values) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "set_a", "set_b", "bands"])

    return df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>")


def full_sets(df: DataFrame) -> DataFrame:
    """doc_id, set_a, set_b and values (the whole shingle set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            digests = [set_digest(v) for v in sets]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *(v.view(np.int64) for v in sets)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in digests], pa.int64()), pa.array([y for _, y in digests], pa.int64()), values], names=["doc_id", "set_a", "set_b", "values"])

    return df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, set_a bigint, set_b bigint, values array<bigint>")


def likely(pairs: DataFrame, sketches: DataFrame, at: float, slack: float = SLACK) -> DataFrame:
    """The pairs (a, b) whose similarity may be ``at`` or more: the likelihood ratio leaves the rest no chance to speak of."""
    s = sketches.select("rep", "n", "bands")
    both = pairs.join(s.toDF("a", "n_a", "bands_a"), "a").join(s.toDF("b", "n_b", "bands_b"), "b").select("a", "b", "n_a", "n_b", "bands_a", "bands_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2048):
            n_a, n_b = (batch.column(k).to_numpy().astype(float) for k in (2, 3))
            left, right = (batch.column(k).flatten().to_numpy().view("<u2").reshape(-1, REGISTERS).astype(np.int32) for k in (4, 5))
            best, below = similarity(left, right, n_a, n_b, at)
            keep = pa.array((best >= at) | (below <= slack))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""
    both = pairs.join(sets.toDF("b", "_b"), "b").join(sets.toDF("a", "_a"), "a")
    shared = F.size(F.array_intersect("_a", "_b")).cast("bigint")
    both = both.select("a", "b", (F.size("_a") + F.size("_b")).cast("bigint").alias("_sum"), shared.alias("_shared"))
    return both.filter(F.lit(100) * F.col("_shared") >= F.lit(percent) * (F.col("_sum") - F.col("_shared"))).select("a", "b")


def likely_pairs(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, allowed: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices (i, j) of pairs that may be links, and their estimates, by descending estimate.

    ``left`` and ``right`` are registers. Pairs that share a band before ``band`` belong to that band's block.
    """
    packed = [np.ascontiguousarray(x.astype("<u2")).view("<i8")[:, :band] for x in (left, right)]
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(left)):
        js = np.flatnonzero(allowed[i] & (100 * np.minimum(n_right, n_left[i]) >= percent * np.maximum(n_right, n_left[i])))
        if len(js):
            js = js[((right[js] == left[i]).sum(1) > FEW) & ~(packed[1][js] == packed[0][i]).any(1)]
            rows.append(np.full(len(js), i))
            columns.append(js)
    i, j = np.concatenate(rows), np.concatenate(columns)
    best, below = np.zeros(len(i)), np.zeros(len(i))
    for k in range(0, len(i), PAIRS):
        a, b = i[k : k + PAIRS], j[k : k + PAIRS]
        best[k : k + PAIRS], below[k : k + PAIRS] = similarity(left[a], right[b], n_left[a], n_right[b], percent / 100)
    maybe = np.flatnonzero((best >= percent / 100) | (below <= SLACK))
    maybe = maybe[np.argsort(-best[maybe], kind="stable")]
    return i[maybe], j[maybe], best[maybe]


def _registers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().view("<u2").reshape(-1, REGISTERS).astype(np.int32)


def likely_in_buckets(buckets: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) across the components of small buckets: band and m, a list of (rep, root, n, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for band in set(batch.column(0).to_pylist()):
                # the buckets of a band are looked at together; a pair belongs to one bucket of it at most
                m = batch.column(1).filter(pc.equal(batch.column(0), band))
                which = np.repeat(np.arange(len(m)), m.value_lengths().to_numpy())
                flat = m.flatten()
                rep, root, n = (flat.field(f).to_numpy() for f in ("rep", "root", "n"))
                sketch = _registers(flat.field("bands"))
                allowed = (which[:, None] == which[None, :]) & (root[:, None] < root[None, :])
                i, j, _ = likely_pairs(sketch, sketch, n.astype(float), n.astype(float), allowed, band, percent)
                low.append(np.minimum(rep[i], rep[j]))
                high.append(np.maximum(rep[i], rep[j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], names=["a", "b"])

    return buckets.select("band", "m").mapInArrow(run, "a bigint, b bigint")


def block_links(left: dict, right: dict, band: int, percent: int) -> list[tuple[int, int]]:
    """Links across components between the two sides of a block, confirmed on full sets.

    A side has arrays rep, root, rest (whether the member is outside the bucket's first component), sketch, and a list
    sets. Confirmed links merge components at once, so pairs within one are not looked at again.
    """
    allowed = (left["root"][:, None] != right["root"][None, :]) & (~right["rest"][None, :] | (left["rep"][:, None] < right["rep"][None, :]))
    sizes = [np.array(list(map(len, side["sets"])), float) for side in (left, right)]
    to: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := to.get(x, x)) != x:
            x = y
        return x

    found = []
    for i, j, _ in zip(*likely_pairs(left["sketch"], right["sketch"], *sizes, allowed, band, percent), strict=True):
        a, b = find(int(left["root"][i])), find(int(right["root"][j]))
        if a == b:
            continue
        x, y = left["sets"][i], right["sets"][j]
        shared = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * shared >= percent * (len(x) + len(y) - shared):
            found.append((int(min(left["rep"][i], right["rep"][j])), int(max(left["rep"][i], right["rep"][j]))))
            to[max(a, b)] = min(a, b)
    return found


def confirm_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of blocks: band and m, a list of (rep, root, rest, side, bands, values); side 0 holds no row of the first component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                m = batch.column(1)[k].values
                m = m.take(pa.array(np.argsort(m.field("rep").to_numpy(), kind="stable")))
                sides = []
                for own in (m.filter(pc.equal(m.field("side"), side)) for side in (0, 1)):
                    arrays = {f: own.field(f).to_numpy(zero_copy_only=False) for f in ("rep", "root", "rest")}
                    sides.append(arrays | {"sketch": _registers(own.field("bands")), "sets": [v.values.to_numpy() for v in own.field("values")]})
                found = block_links(*sides, batch.column(0)[k].as_py(), percent)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return blocks.select("band", "m").mapInArrow(run, "a bigint, b bigint")


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """node, root of every node of the edges (a, b); equal roots mean connected. Hub nodes aggregate before shuffling.

    Each round every node joins its neighbour of least random priority and the edges are contracted; about half of the
    nodes go in a round, on paths and stars alike.
    """
    spark = scratch.spark
    labels = spark.createDataFrame([], "node bigint, root bigint")
    edges = edges.filter("a <> b")
    step = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("p"), c.alias("id"))
        least = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        to = least.select(F.col("a").alias("node"), F.least(F.col("m"), rank(F.col("a")))["id"].alias("to"))
        to = scratch.keep(to, f"{name}-to-{step}")
        moved = edges.join(to.toDF("a", "x"), "a").join(to.toDF("b", "y"), "b").filter("x <> y")
        moved = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = scratch.keep(moved, f"{name}-edges-{step}")
        if step:
            scratch.drop(f"{name}-edges-{step - 1}")
            old = labels.join(to.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            labels = scratch.keep(old, f"{name}-labels-{step}")
            scratch.drop(f"{name}-labels-{step - 1}", f"{name}-to-{step}", f"{name}-to-{step - 1}")
        else:
            labels = to.toDF("node", "root")
        step += 1
    return labels


def _grouped(df: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """doc_id, n, set_a, set_b and component of every row of ``df``; nothing but tables of ``scratch`` is read."""
    at = percent / 100
    sketches = scratch.keep(sketch(df), "sketches")
    # a node is a set; it has the smallest doc_id of its rows
    unique = sketches.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "set_a", "set_b").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    # the numbers hold once they are written
    unique = scratch.keep(unique.withColumn("rep", F.monotonically_increasing_id()), "unique")
    banded = unique.select("rep", "n", F.posexplode("bands").alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).filter("centre <> last")
    members = scratch.keep(banded.join(buckets.drop("last"), ["band", "value"]), "members")
    candidates = members.select("rep").distinct()
    sketched = scratch.keep(unique.join(candidates, "rep", "left_semi"), "candidate-sketches")
    own = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).join(sketched.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # rows that repeat a doc_id and a set are one set here, and rows of other sets find no node
    sets = full_sets(own).groupBy("doc_id", "set_a", "set_b").agg(F.first("values").alias("values"))
    sets = scratch.keep(sets.join(sketched.select(F.col("first").alias("doc_id"), "set_a", "set_b", "rep"), ["doc_id", "set_a", "set_b"]).select("rep", "values"), "sets")
    sketched = sketched.select("rep", "n", "bands")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        return scratch.keep(confirm(likely(pairs, sketched, at), sets, percent), name)

    # sets whose sizes differ more can't reach the threshold
    near = lambda x, y: (F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y))
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    salt = F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int").alias("salt")
    salted = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    key = ["band", "value", "salt"]

    def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of buckets with the component that each is in so far."""
        return rows.select("band", "value", "rep", "n", salt).join(labels.toDF("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))

    edges = links(members.filter("rep <> centre").select(*ordered("rep", "centre")).distinct(), "edges-0")
    labels = components(scratch, edges, "parts-0")

    # buckets that span components: one more centre, by a random priority
    rows = labelled(members, labels)
    spans = rows.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.struct(F.xxhash64("rep"), "rep", "root", "n")).alias("c")).filter("lo <> hi")
    open_ = scratch.keep(rows.join(salted(spans.select("band", "value", "c")), key), "open-0")
    scratch.drop("members")
    second = open_.filter((F.col("root") != F.col("c.root")) & near(F.col("n"), F.col("c.n")))
    more = links(second.select(*ordered("rep", "c.rep")).distinct(), "more-0")
    edges = scratch.keep(edges.unionByName(more), "edges-1")
    labels = components(scratch, edges, "parts-1")

    # what is left: pairs across components of a bucket, and only those
    rows = labelled(open_, labels)
    sums = (F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min(F.struct(F.xxhash64("rep", "band"), "root")).alias("c"))
    spans = rows.groupBy("band", "value").agg(*sums).filter("lo <> hi").select("band", "value", "size", "shingles", F.col("c.root").alias("first"))
    open_ = scratch.keep(rows.join(salted(spans), key), "open-1")
    scratch.drop("open-0")
    bands = sketched.select("rep", "bands")
    small = open_.filter(F.col("size") <= SMALL).join(bands, "rep").groupBy("band", "value").agg(F.collect_list(F.struct("rep", "root", "n", "bands")).alias("m"))
    pairs = scratch.keep(likely_in_buckets(small, percent).distinct(), "pairs")
    more = scratch.keep(confirm(pairs, sets, percent), "more-1")
    # side 0: members outside the first component, in chunks of their own; side 1: all members
    large = open_.filter(F.col("size") > SMALL).withColumn("rest", F.col("root") != F.col("first"))
    rest = large.filter("rest").groupBy("band", "value").agg(F.ceil(F.sum("n") / F.lit(CHUNK)).alias("lefts"))
    large = large.withColumn("rights", F.ceil(F.col("shingles") / F.lit(CHUNK))).join(salted(rest), key)
    part = lambda parts: F.pmod(F.xxhash64("rep", F.lit(1)), F.col(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))
    right = large.select("rep", "root", "rest", "band", "value", F.lit(1).alias("side"), part("rights").alias("r"), every("lefts").alias("l"))
    left = large.filter("rest").select("rep", "root", "rest", "band", "value", F.lit(0).alias("side"), every("rights").alias("r"), part("lefts").alias("l"))
    held = left.unionByName(right).join(bands, "rep").join(sets, "rep")
    blocks = held.groupBy("band", "value", "l", "r").agg(F.collect_list(F.struct("rep", "root", "rest", "side", "bands", "values")).alias("m"))
    more = more.unionByName(scratch.keep(confirm_blocks(blocks, percent), "more-2"))
    labels = components(scratch, scratch.keep(edges.unionByName(more), "edges-2"), "parts-2")

    firsts = labels.join(unique.select("rep", "first"), labels["node"] == unique["rep"])
    least = firsts.groupBy("root").agg(F.min("first").alias("component"))
    named = scratch.keep(labels.join(least, "root").select(F.col("node").alias("rep"), "component"), "named")
    known = unique.select("n", "set_a", "set_b", "rep", "first").join(named, "rep", "left").select("n", "set_a", "set_b", F.coalesce("component", "first").alias("component"))
    out = sketches.select("doc_id", "n", "set_a", "set_b").join(known, ["n", "set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("component"), F.col("doc_id")))
    scratch.drop_others("sketches", "unique", "named")
    return out.select("doc_id", "n", "set_a", "set_b", component.alias("component"))


def group(df: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``df`` (doc_id, text)."""
    out = _grouped(df, percent, Scratch(df.sparkSession))
    kept = F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def drop_copies(df: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``df`` that stay when one document of each group does, all columns as they are.

    The smallest doc_id of a group stays, once. Rows without words are in no group and stay.
    """
    scratch = Scratch(df.sparkSession)
    found = scratch.keep(_grouped(df.select("doc_id", "text"), percent, scratch), "verdicts").filter("doc_id IS NOT NULL")
    stays = F.col("component") == F.col("doc_id")
    by_id = found.groupBy(F.col("doc_id").alias("_which")).agg(F.bool_or(stays).alias("_any"), F.count(F.lit(1)).alias("_n"))
    gone = scratch.keep(by_id.filter("NOT _any OR _n > 1"), "gone")
    # the row travels as one value, so its columns can have any names
    rows = df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("_row"), df["`doc_id`"].cast("bigint").alias("_id"))
    out = rows.join(gone, F.col("_id") == F.col("_which"), "left_anti").select("_row.*")
    again = gone.filter("_any")
    scratch.drop_others("verdicts", "gone")
    if again.isEmpty():
        return out
    # ids with several rows: decided by id and set, and one row of each stays
    several = rows.join(again.select("_which"), F.col("_id") == F.col("_which"), "left_semi")
    digest = F.arrow_udf(_digests, "struct<n: bigint, a: bigint, b: bigint>")(F.col("_row.text").cast("string"))
    several = several.withColumn("_d", digest)
    verdicts = found.filter(stays).select(F.col("doc_id").alias("_which"), F.struct(F.col("n").alias("n"), F.col("set_a").alias("a"), F.col("set_b").alias("b")).alias("_own")).distinct()
    several = several.join(verdicts, (F.col("_id") == F.col("_which")) & (F.col("_d") == F.col("_own")), "left_semi")
    once = several.filter("_d.n > 0").groupBy("_id", "_d").agg(F.min_by("_row", F.col("_row.text")).alias("_row")).select("_row.*")
    return out.unionByName(several.filter("_d.n = 0").select("_row.*")).unionByName(once)


def _digests(texts: pa.Array) -> pa.Array:
    """(n, a, b) of each text's shingle set."""
    sets = [shingles(t) for k in range(0, len(texts), 256) for t in texts.slice(k, 256).to_pylist()]
    digests = [set_digest(v) for v in sets]
    parts = [pa.array(x, pa.int64()) for x in (list(map(len, sets)), [x for x, _ in digests], [y for _, y in digests])]
    return pa.StructArray.from_arrays(parts, names=["n", "a", "b"])
