"""Approximate nearest neighbours by inner product: NN-descent builds graphs, greedy search walks them.

1. Vectors are checked, packed and dealt by a hash of their ids over shards that one task can hold; every vector is in one.
   A shard's graph is built and walked where its vectors are, so no hop and no round is a job or a shuffle of its own.
2. Start: every vector joins one leaf in each of PARTITIONS partitions of its shard by random hyperplanes. A leaf larger
   than LEAF is split, so its size is bounded whatever the data; within leaves all pairs are scored by blocks.
3. NN-descent: each node gathers a sample of its neighbours and of those whose neighbour it is; pairs among them are joined and
   each is offered the others that beat its present worst. Every node keeps DEGREE neighbours. Rounds go on until one changes
   at most SETTLED of the neighbours; lists only improve, so they end.
4. Search: a query walks the graphs of all shards of its length. It starts beside its place in each partition and, where it
   is at home, at its own node, and expands the best unexpanded nodes of its beam until all of its beam is expanded; the best
   are scored again on the original vectors in double precision. The best of all shards are the query's neighbours.

Samples and beams bound work a node, a round and a hop, and beams widen with the logarithm of the shard; recall is
measured against brute force in tests/llm and, by table size, in the README. Every vector is indexed, and rounds and hops
are as many as the shard needs. As queries visit every shard, walks grow with queries times shards. ``exact`` finds the true
neighbours without any of these bounds, by scoring blocks of queries against blocks of all rows.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without vec_id; an
inner product needs two vectors of one length, so each is searched among those of its own length, and a vector alone in
its length has no neighbours; of rows with one vec_id the least vector counts; equal vectors are one node of a graph and
all of them are found with it; ties go to the smaller vec_id; a query with fewer candidates than k gets all of them; empty
tables give no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches

PARTITIONS, LEAF, DEGREE, SAMPLE, SETTLED = 16, 800, 32, 16, 0.01
BEAM, RESCORED = 256, 96
#: A hop expands this part of a beam.
PART = 4
#: Planes of a partition, and nodes on either side of a query's place in it where a walk begins.
BITS, BESIDE = 24, 16
#: Components of a shard, which bound what a task holds; up to SPREAD shards are made of smaller tables, with LEAST vectors each.
SHARD, SPREAD, LEAST = 2**23, 16, 2048
#: Pairs that wait to be offered, and of these as many as are scored at once.
JOINED, MET = 2**22, 2**16
#: Rows of a block of ``exact``.
BLOCK = 2048
#: Vectors up to which BEAM suffices as it is; each doubling beyond adds half of it.
BASE = 10_000
SEED = 5


def load(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (array of double) and dim (its length) of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(id).cast("bigint").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _quantise(vectors: DataFrame) -> DataFrame:
    """id, dim and v, packed: in single precision where that holds every component exactly, else in double."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            flat, offsets = batch.column(1).flatten().to_numpy(), np.cumsum([0, *batch.column(1).value_lengths().to_pylist()])
            with np.errstate(over="ignore"):
                single = flat.astype(np.float32)
            exact = single == flat
            packed = [(single if exact[a:b].all() else flat)[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["id", "dim", "v"])

    return vectors.select("id", "v", "dim").mapInArrow(run, "id bigint, dim int, v binary")


def _unpack(packed: pa.Array, dim: int) -> np.ndarray:
    """Rows of components from a column of packed vectors."""
    rows = packed.to_pylist()
    if all(len(r) == 4 * dim for r in rows):
        return np.frombuffer(b"".join(rows), np.float32).reshape(-1, dim)
    return np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in rows]).astype(np.float64)


def _best(score: np.ndarray, most: int) -> np.ndarray:
    """Columns of each row's ``most`` highest scores, highest first."""
    top = np.argpartition(-score, most - 1, axis=1)[:, :most] if most < score.shape[1] else np.broadcast_to(np.arange(score.shape[1]), score.shape)
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable"), 1)


class _Shard:
    """A shard's vectors, their graph and the places where walks begin.

    Equal vectors are one node. ``near`` and ``score`` are DEGREE neighbours of each node, best first; node ``n`` stands for
    none, with score -inf.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray, leaf: int = LEAF):
        v = v[order := np.argsort(ids)] + v.dtype.type(0)  # no negative zeros
        ids = ids[order]
        _, first, node = np.unique(v.view(np.dtype((np.void, v.itemsize * v.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.ids, self.node, self.v, self.n = ids, node, v[first], len(first)
        members = np.argsort(node, kind="stable")  # a node's ids lie side by side, smaller ones first
        self.members, self.begins = ids[members], np.concatenate([[0], np.cumsum(np.bincount(node, minlength=self.n))])
        self.x = (self.v / np.abs(self.v).max()).astype(np.float32)
        self.random = np.random.default_rng([SEED, v.shape[1]])
        self.planes = self.random.normal(size=(v.shape[1], PARTITIONS * BITS)).astype(np.float32)
        codes = self._codes(self.x)
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.order, 1)
        self.near, self.score = np.full((self.n, DEGREE), self.n, np.int32), np.full((self.n, DEGREE), -np.inf, np.float32)
        self._start(leaf)
        if self.n > leaf:
            self._descend()
        self.next = np.concatenate([self.near, np.full((1, DEGREE), self.n, np.int32)])

    def _codes(self, x: np.ndarray) -> np.ndarray:
        """A number for each partition and row: on which side of BITS planes it lies."""
        parts = [(x[k : k + 4096] @ self.planes > 0).reshape(-1, PARTITIONS, BITS) @ (1 << np.arange(BITS, dtype=np.int32)[::-1]) for k in range(0, len(x), 4096)]
        return np.ascontiguousarray(np.concatenate(parts).T, np.int32)

    def _scores(self, y: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Scores of runs of ``nodes``, as many to each row of ``y`` as ``sizes`` says."""
        x, out, at = self.x[nodes], np.empty(len(nodes), np.float32), 0
        for k, size in enumerate(sizes.tolist()):
            np.dot(x[at : at + size], y[k], out=out[at : at + size])
            at += size
        return out

    def _start(self, most: int) -> None:
        """All pairs within each partition's leaves of at most ``most`` nodes."""
        bits = max(0, int(np.ceil(np.log2(self.n / most))))
        for p in range(PARTITIONS if self.n > most else 1):
            edges = np.flatnonzero(np.diff(self.codes[p] >> max(0, BITS - bits))) + 1
            for leaf in np.split(self.order[p], edges):
                for m in np.array_split(leaf, -(-len(leaf) // most)):
                    s = self.x[m] @ self.x[m].T
                    np.fill_diagonal(s, -np.inf)
                    if p:
                        at, other = np.nonzero(s > self.score[m, -1:])
                        self._offer(m, at, m[other], s[at, other])
                    else:
                        best = _best(s, min(DEGREE, len(m)))
                        self.score[m, : best.shape[1]] = value = np.take_along_axis(s, best, 1)
                        self.near[m, : best.shape[1]] = np.where(value > -np.inf, m[best], self.n)

    def _offer(self, rows: np.ndarray, at: np.ndarray, nodes: np.ndarray, score: np.ndarray) -> int:
        """Offer nodes, each one once to a row, to the neighbours of ``rows``, of which ``at`` has places in order; how many were taken."""
        fresh = ~(self.near[rows[at]] == nodes[:, None]).any(1)
        at, nodes, score = at[fresh], nodes[fresh], score[fresh]
        sizes = np.bincount(at, minlength=len(rows))
        place = DEGREE + np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        wide = DEGREE + int(sizes.max(initial=0))
        lists, scores = np.full((len(rows), wide), self.n, np.int32), np.full((len(rows), wide), -np.inf, np.float32)
        lists[:, :DEGREE], scores[:, :DEGREE] = self.near[rows], self.score[rows]
        lists[at, place], scores[at, place] = nodes, score
        best = _best(scores, DEGREE)
        self.near[rows], self.score[rows] = np.take_along_axis(lists, best, 1), np.take_along_axis(scores, best, 1)
        return np.count_nonzero((best >= DEGREE) & (self.score[rows] > -np.inf))

    def _descend(self) -> None:
        """NN-descent: each node gathers samples of its neighbours and of those whose neighbour it is; pairs among them are joined."""
        n, unsettled = self.n, True
        x, pairs = np.concatenate([self.x, np.zeros((1, self.x.shape[1]), np.float32)]), 4 * SAMPLE * SAMPLE
        step = max(1, 2**22 // (2 * SAMPLE * self.x.shape[1] + pairs))
        while unsettled:
            pick = np.argsort(self.random.random((n, DEGREE), np.float32), axis=1)[:, :SAMPLE]
            mixed = self.random.permutation(n * DEGREE)
            at, to = (mixed // DEGREE).astype(np.int32), self.near.ravel()[mixed]
            by = np.argsort(to, kind="stable")
            at, to = at[by], to[by]
            rank = np.arange(len(to)) - np.searchsorted(to, np.arange(n + 1))[to]
            at, to, rank = (c[(rank < SAMPLE) & (to < n)] for c in (at, to, rank))
            joined = np.full((n, 2 * SAMPLE), n, np.int32)
            joined[:, :SAMPLE] = np.take_along_axis(self.near, pick, 1)
            joined[to, SAMPLE + rank] = at
            changed, keys, held = 0, [], 0
            for a in range(0, n, step):
                m = joined[a : a + step]
                own = x[m]
                worst = np.append(self.score[:, -1], np.float32(np.inf))[m]
                good = (own @ own.transpose(0, 2, 1) > worst[:, :, None]) & (m < n)[:, None, :] & (m[:, :, None] != m[:, None, :])
                k, i, j = np.nonzero(good)
                keys.append(m[k, i].astype(np.int64) * n + m[k, j])
                held += len(k)
                if held > JOINED or a + step >= n:
                    changed += self._meet(np.unique(np.concatenate(keys)))
                    keys, held = [], 0
            unsettled = changed > SETTLED * n * DEGREE

    def _meet(self, keys: np.ndarray) -> int:
        """Score pairs (node times n, and the other) and offer the nodes the others; how many were taken."""
        node, other = np.divmod(keys, self.n)
        edges = np.flatnonzero(np.diff(node, prepend=-1))
        sizes, taken = np.diff(edges, append=len(node)), 0
        for part in np.array_split(np.arange(len(edges)), -(-len(node) // MET)):
            if len(part):
                a, rows, many = edges[part[0]], node[edges[part]], sizes[part]
                nodes = other[a : a + many.sum()].astype(np.int32)
                score, at = self._scores(self.x[rows], nodes, many), np.repeat(np.arange(len(rows)), many)
                good = score > self.score[rows[at], -1]
                taken += self._offer(rows, at[good], nodes[good], score[good])
        return taken

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The graph of vectors: ids, and DEGREE neighbours or fewer of each with scores, equal vectors among them."""
        own = np.arange(self.n)
        nodes = np.concatenate([own[:, None], self.near], 1)[self.node]
        score = np.concatenate([np.einsum("nd,nd->n", self.x, self.x)[:, None], self.score], 1)[self.node]
        row, column = np.nonzero(nodes < self.n)
        return self._ranked(row, nodes[row, column], score[row, column], self.ids, DEGREE)

    def _ranked(self, row: np.ndarray, node: np.ndarray, score: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best ids of each row's nodes but the row's own, ties to smaller ids: sizes of lists, scores, ids.

        Equal vectors have equal scores, so no more than the k + 1 smallest ids of a node can be among them.
        """
        many = np.minimum(self.begins[node + 1] - self.begins[node], k + 1)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        ids, row, score = self.members[np.repeat(self.begins[node], many) + place], np.repeat(row, many), np.repeat(score, many)
        other = ids != own[row]
        ids, row, score = ids[other], row[other], score[other]
        order = np.lexsort((ids, -score, row))
        ids, row, score = ids[order], row[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        return np.bincount(row[top], minlength=len(own)), score[top], ids[top]

    def search(self, ids: np.ndarray, v: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Queries' ids with their k nearest here, in parts: ids, sizes of lists, exact scores, ids found."""
        wide = 1 + max(0.0, np.log2(self.n / BASE)) / 2
        width, best = int(BEAM * wide), max(RESCORED, 4 * k)
        step = max(1, min(64, 2**21 // (width // PART * DEGREE * self.x.shape[1])))  # what a hop gathers stays in a core's cache
        for a in range(0, len(ids), step):
            own, u = ids[a : a + step], v[a : a + step].astype(np.float64)
            row, node = self._walk((u / np.abs(u).max(1, keepdims=True)).astype(np.float32), own, width, best)
            # summed in order, as by ``exact``
            score = np.cumsum(self.v[node].astype(np.float64) * u[row], axis=1)[:, -1]
            yield own, *self._ranked(row, node, score, own, k)

    def _walk(self, y: np.ndarray, own: np.ndarray, width: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``y`` and their ``best`` nodes met by the time the whole beam is expanded; a node is met once."""
        n, count, expand, most = self.n, len(y), width // PART, max(width, best)
        met = np.zeros((count, n + 1), bool)
        met[:, n] = True
        beam, score, done = np.full((count, most), n, np.int32), np.full((count, most), -np.inf, np.float32), np.ones((count, most), bool)
        # begin at the query's own node, if it is here, and beside its place in each partition
        codes = self._codes(y)
        at = np.stack([np.searchsorted(self.codes[p], codes[p]) for p in range(PARTITIONS)], 1)
        window = np.clip(at[:, :, None] + np.arange(-BESIDE, BESIDE), 0, n - 1)
        place = np.minimum(np.searchsorted(self.ids, own), len(self.ids) - 1)
        here = np.where(self.ids[place] == own, self.node[place], n)
        new = np.concatenate([self.order[np.arange(PARTITIONS)[None, :, None], window].reshape(count, -1), here[:, None]], 1)
        live = np.arange(count)
        while len(live):
            new = np.sort(new.astype(np.int32), axis=1)
            good = ~met[live[:, None], new]
            good[:, 1:] &= new[:, 1:] != new[:, :-1]
            row, column = np.nonzero(good)
            nodes, sizes = new[row, column], good.sum(1)
            met[live[row], nodes] = True
            place = most + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            wide = most + int(sizes.max(initial=0))
            b, s, d = np.full((len(live), wide), n, np.int32), np.full((len(live), wide), -np.inf, np.float32), np.ones((len(live), wide), bool)
            b[:, :most], s[:, :most], d[:, :most] = beam[live], score[live], done[live]
            b[row, place], s[row, place], d[row, place] = nodes, self._scores(y[live], nodes, sizes), False
            top = _best(s, most)
            b, s, d = (np.take_along_axis(c, top, 1) for c in (b, s, d))
            todo = ~d[:, :width]
            todo &= np.cumsum(todo, axis=1) <= expand
            d[:, :width] |= todo
            beam[live], score[live], done[live] = b, s, d
            is_open = todo.any(1)
            live, todo, b = live[is_open], todo[is_open], b[is_open, :width]
            first = np.argsort(~todo, axis=1, kind="stable")[:, :expand]
            new = self.next[np.where(np.take_along_axis(todo, first, 1), np.take_along_axis(b, first, 1), n)].reshape(len(live), expand * DEGREE)
        row, column = np.nonzero(beam[:, :best] < n)
        return row, beam[row, column]


def _shards(packed: DataFrame, scratch: Scratch) -> DataFrame:
    """dim and shards: over how many shards the vectors of each length are dealt."""
    # enough of them to keep small tables from one task, and none too large for one
    few, most = F.least(F.lit(SPREAD), F.floor(F.col("n") / F.lit(LEAST))), F.ceil(F.col("n") * F.col("dim") / F.lit(SHARD))
    sizes = packed.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", F.greatest(few, most, F.lit(1)).cast("int").alias("shards"))
    return scratch.keep(sizes, "sizes")


def _dealt(packed: DataFrame, queries: DataFrame | None, sizes: DataFrame) -> DataFrame:
    """dim, shard, asked, id, v: each vector in the shard of its id and each query in all shards of its length; a shard's
    rows lie in one partition, vectors before queries."""
    known = F.broadcast(sizes)
    rows = packed.join(known, "dim").select("dim", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int").alias("shard"), F.lit(False).alias("asked"), "id", "v")
    if queries is not None:
        asked = packed.join(queries, "id", "left_semi").join(known, "dim")
        rows = rows.unionByName(asked.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(True).alias("asked"), "id", "v"))
    # with several ranges a shard each shard gets at least one of its own
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    return rows.repartitionByRange(4 * total, "dim", "shard").sortWithinPartitions("dim", "shard", "asked", "id")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, np.ndarray, np.ndarray]]:
    """Runs of rows of one shard and kind: (dim, shard), asked, ids, vectors."""
    for batch in small_batches(batches, 4096):
        if not batch.num_rows:
            continue
        dim, shard, asked = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        edges = np.flatnonzero((np.diff(dim) != 0) | (np.diff(shard) != 0) | (asked[1:] != asked[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield (int(dim[a]), int(shard[a])), bool(asked[a]), batch.column(3)[a:b].to_numpy(), _unpack(batch.column(4)[a:b], int(dim[a]))


def _shard(parts: list[tuple[np.ndarray, np.ndarray]], leaf: int) -> _Shard:
    ids, v = zip(*parts, strict=True)
    return _Shard(np.concatenate(ids), np.concatenate(v), leaf)


def _lists(ids: np.ndarray, sizes: np.ndarray, scores: np.ndarray, others: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    inner = pa.StructArray.from_arrays([pa.array(scores, kind), pa.array(others, pa.int64())], names=["score", "id"])
    near = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), inner)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), near], names=["id", "near"])


def build(packed: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """The neighbour graphs of all shards: id and near, DEGREE neighbours by descending score (on vectors scaled to a largest
    component of 1 in their shard). Shards follow from the vectors themselves, so ``n``, their number, is no longer used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, runs in groupby(_runs(batches), key=itemgetter(0)):
            shard = _shard([r[2:] for r in runs], LEAF)
            yield _lists(shard.ids, *shard.lists(), pa.float32())

    return scratch.keep(_dealt(packed, None, _shards(packed, scratch)).mapInArrow(run, "id bigint, near array<struct<score: float, id: bigint>>"), "graph")


def search(df: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest others of each queried row of ``df``: query_id, rank, vec_id, score. ``queries`` has ids in ``id``."""
    scratch = Scratch(df.sparkSession)
    packed = scratch.keep(_quantise(load(df, id, vector)), "packed")
    asked = queries.select(F.col(id).cast("bigint").alias("id")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, runs in groupby(_runs(batches), key=itemgetter(0)):
            parts, shard = [], None
            for _, is_query, ids, v in runs:
                if not is_query:
                    parts.append((ids, v))
                    continue
                if shard is None and parts:
                    shard, parts = _shard(parts, LEAF), []
                for found in shard.search(ids, v, k) if shard else []:
                    yield _lists(*found, pa.float64())

    found = _dealt(packed, asked, _shards(packed, scratch)).mapInArrow(run, "id bigint, near array<struct<score: double, id: bigint>>")
    merged = found.groupBy("id").agg(F.flatten(F.collect_list("near")).alias("near"))
    best = F.slice(F.array_sort(F.transform("near", lambda x: F.struct((0 - x["score"]).alias("cost"), x["id"].alias("id")))), 1, k)
    ranked = merged.select(F.col("id").alias("query_id"), F.posexplode(best).alias("rank", "x"))
    out = scratch.keep(ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (0 - F.col("x.cost")).alias("score")), "found")
    scratch.drop_others("found")
    return out


def _ranked(pairs: DataFrame, full: DataFrame, k: int) -> DataFrame:
    """The k best of pairs (query_id, vec_id), scored on the original vectors in double precision."""
    pairs = pairs.join(full.select(F.col("id").alias("vec_id"), F.col("v").alias("_v")), "vec_id").join(full.select(F.col("id").alias("query_id"), F.col("v").alias("_u")), "query_id")
    scored = pairs.select("query_id", "vec_id", F.expr("aggregate(zip_with(_u, _v, (x, y) -> x * y), 0D, (s, x) -> s + x)").alias("score"))
    ranked = scored.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def exact(df: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """As ``search``, by brute force: every block of queries meets every block of rows of its length, and nothing is capped."""
    scratch = Scratch(df.sparkSession)
    full = scratch.keep(load(df, id, vector), "vectors")
    asked = full.join(queries.select(F.col(id).cast("bigint").alias("id")).distinct(), "id", "left_semi")

    def blocks(rows: DataFrame) -> DataFrame:
        parts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("parts"))
        dealt = rows.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        return dealt.groupBy("dim", "part", "parts").agg(F.collect_list(F.struct("id", "v")).alias("m"))

    asked = scratch.keep(blocks(asked).select("dim", F.col("part").alias("at"), F.col("parts").alias("blocks"), F.col("m").alias("q")), "asked")
    every = blocks(full).join(asked.select("dim", "blocks").distinct(), "dim").withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            if not batch.num_rows:
                continue
            (a, x), (b, y) = ((c[0].values.field("id").to_numpy(), c[0].values.field("v").flatten().to_numpy().reshape(len(c[0].values), -1)) for c in batch.columns)
            score = x @ y.T
            score[a[:, None] == b[None, :]] = -np.inf
            most = min(2 * k, len(b))
            best = np.argpartition(-score, most - 1, axis=1)[:, :most]
            # ties with the worst kept go along, so that the smaller ids can win
            low = np.take_along_axis(score, best, 1).min(1, keepdims=True)
            rows, columns = np.nonzero((score >= low) & (a[:, None] != b[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(a[rows]), pa.array(b[columns])], names=["query_id", "vec_id"])

    pairs = every.join(asked.drop("blocks"), ["dim", "at"]).select("q", "m").mapInArrow(run, "query_id bigint, vec_id bigint")
    return _ranked(pairs, full, k)
