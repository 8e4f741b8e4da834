"""Approximate nearest neighbours by vantage-point trees, one per shard.

Every usable vector is indexed: rows are dealt to shards by a hash of their id
and each shard's tree is built in a task and stored as one row.  An inner node
holds a vantage point and the median distance to it; the near half is searched
first, the far half only if ``|d - median| <= factor * (k-th distance so far)``.
By the triangle inequality factor 1 loses nothing (exact search); smaller
factors prune more.  Equal vectors of a shard are stored once with their ids.

Queries are a stated set against all rows: blocks of at most ``BLOCK`` queries
(a proven size) are broadcast, one after the other; a task keeps the running
best of the block over all its shards, so ``k`` rows per query and task leave
it, and the best of a query are found by a window over those.

Distances are Euclidean in double precision on the original vectors, ties go
to the smaller id.  Defined results: vectors that are null, zero or that hold
null or non-finite components take no part, nor do null ids; vectors of
different lengths have no distance, so each length is searched by itself; rows
that repeat an id and a vector count once, an id with several vectors is
searched by each of them and found at its nearest; a query's own id is no
candidate; a distance beyond the range of doubles is infinite and ranks last;
fewer candidates than ``k`` give all of them; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import cut

SHARD = 4096
LEAF = 512
BLOCK = 8192
FACTOR = 0.15
NONE = np.iinfo(np.int64).max               # no neighbour yet
SCHEMA = "dim int, shard int, n long, vectors binary, ids binary, first binary, nodes binary"


def usable(rows: DataFrame) -> DataFrame:
    """(id, vec) of the rows that take part."""
    v = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = (F.col("id").isNotNull() & F.col("vec").isNotNull()
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    return v.where(fine).distinct()


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` to one vector or to rows.
    Squares that leave the range of doubles are taken again in units of the
    largest difference; a distance beyond the range is infinite."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        d = np.sqrt(np.square(x - q).sum(axis=-1))
        odd = ~((d > 1e-140) & (d < 1e150))
        if odd.any():
            gap = np.abs(x - q)[odd]
            unit = gap.max(axis=-1)
            safe = np.where((unit > 0) & (unit < np.inf), unit, 1.0)
            d[odd] = np.where(unit < np.inf, safe * np.sqrt(np.square(gap / safe[:, None]).sum(axis=-1)), np.inf)
    return d


def build(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): the points in leaf order and the tree's nodes as rows
    (vantage row or -1, median, left, right); a leaf's left and right are its
    range in the order."""
    rng, order, nodes = np.random.default_rng(seed), [], []

    def grow(at: np.ndarray) -> int:
        me = len(nodes)
        nodes.append(None)
        if len(at) > LEAF:
            vantage = int(at[rng.integers(len(at))])
            d = distances(x[at], x[vantage])
            median = float(np.partition(d, len(at) // 2)[len(at) // 2])
            if median == d.max():                         # many at the same distance
                less = d[d < median]
                median = float(less.max()) if len(less) else -1.0
            if median >= 0:
                nodes[me] = (vantage, median, grow(at[d <= median]), grow(at[d > median]))
                return me
        nodes[me] = (-1, 0.0, len(order), len(order) + len(at))
        order.extend(at.tolist())
        return me

    if len(x):
        grow(np.arange(len(x)))
    return np.array(order, np.int64), np.array(nodes, np.float64).reshape(-1, 4)


class Best:
    """The k nearest so far per query: distances and ids, nearest first."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int):
        self.q, self.own, self.k = queries, ids, k
        self.d = np.full((len(ids), k), np.inf)
        self.i = np.full((len(ids), k), NONE)

    def offer(self, qs: np.ndarray, d: np.ndarray, i: np.ndarray) -> None:
        """Candidates: per entry a query, ascending, its distance and its id."""
        keep = i != self.own[qs]
        qs, d, i = qs[keep], d[keep], i[keep]
        if not len(qs):
            return
        who, start, count = np.unique(qs, return_index=True, return_counts=True)
        column = np.arange(len(qs)) - np.repeat(start, count) + self.k
        row = np.repeat(np.arange(len(who)), count)
        both_d, both_i = np.full((len(who), self.k + count.max()), np.inf), np.full((len(who), self.k + count.max()), NONE)
        both_d[:, :self.k], both_i[:, :self.k] = self.d[who], self.i[who]
        both_d[row, column], both_i[row, column] = d, i
        best = np.lexsort((both_i, both_d), axis=1)[:, :self.k]
        self.d[who], self.i[who] = np.take_along_axis(both_d, best, 1), np.take_along_axis(both_i, best, 1)


def _leaf(x: np.ndarray, norms: np.ndarray, best: Best, qs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs of a leaf that may be among the k nearest: one matrix
    product gives squared distances up to a proven rounding bound, and whatever
    that bound cannot rule out is a candidate."""
    q = best.q[qs]
    with np.errstate(over="ignore", invalid="ignore"):
        own = np.square(q).sum(axis=1)
        square = own[:, None] + norms - 2 * (q @ x.T)
        # each product and sum of up to dim terms is off by at most dim rounding steps of (|q| + |x|)^2
        slack = (4 * x.shape[1] + 32) * np.finfo(np.float64).eps * (np.sqrt(own)[:, None] + np.sqrt(norms)) ** 2
        # k + 1 rows of the leaf are within this (one of them may be the query's own)
        at = min(best.k, len(x) - 1)
        reach = np.partition(square + slack, at, axis=1)[:, at] if len(x) > best.k else np.full(len(qs), np.inf)
        limit = np.minimum(reach, np.square(best.d[qs, -1]) * (1 + 1e-12))
        return np.nonzero(~(square - slack > limit[:, None]))  # what overflows is taken exactly


def search(x: np.ndarray, ids: np.ndarray, first: np.ndarray, nodes: np.ndarray, best: Best, factor: float) -> int:
    """Search one shard's tree for all queries of ``best``; the number of
    distances taken.  ``x`` is in leaf order; vector ``j``'s ids are
    ``ids[first[j]:first[j + 1]]``, ascending."""
    taken = 0
    with np.errstate(over="ignore"):
        norms = np.square(x).sum(axis=1)

    def visit(node: int, qs: np.ndarray) -> None:
        nonlocal taken
        if not len(qs):
            return
        vantage, median, left, right = nodes[node]
        if vantage < 0:
            lo, hi = int(left), int(right)
            for at in range(0, len(qs), 512):
                part = qs[at:at + 512]
                who, row = _leaf(x[lo:hi], norms[lo:hi], best, part)
                taken += len(part) * (hi - lo)
                if not len(who):
                    continue
                who, row = part[who], row + lo
                d = distances(x[row], best.q[who])
                # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
                many = np.minimum(first[row + 1] - first[row], best.k + 1)
                place = np.repeat(first[row] - np.cumsum(many) + many, many) + np.arange(many.sum())
                best.offer(np.repeat(who, many), np.repeat(d, many), ids[place])
            return
        d = distances(best.q[qs], x[int(vantage)])
        taken += len(qs)
        inside = d <= median
        near, far = qs[inside], qs[~inside]
        visit(int(left), near)
        visit(int(right), far)
        visit(int(right), near[median - d[inside] <= factor * best.d[near, -1]])
        visit(int(left), far[d[~inside] - median <= factor * best.d[far, -1]])

    if len(nodes):
        visit(0, np.arange(len(best.own)))
    return taken


def build_index(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per shard: its vectors in leaf order, ids and tree.  Vectors of
    different lengths never share a shard."""
    shards = max(1, -(-vectors.count() // shard))

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("id").combine_chunks()
        ids = t["id"].to_numpy()
        x = np.stack([np.asarray(v) for v in t["vec"].to_numpy(zero_copy_only=False)])
        same, back = np.unique(x, axis=0, return_inverse=True)
        back = back.reshape(-1)
        order, nodes = build(same)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        inner = nodes[:, 0] >= 0
        nodes[inner, 0] = place[nodes[inner, 0].astype(np.int64)]
        group = place[back]
        by = np.lexsort((ids, group))
        first = np.searchsorted(group[by], np.arange(len(order) + 1))
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "shard": pa.array([t["shard"][0].as_py()], pa.int32()), "n": pa.array([len(order)], pa.int64()),
                         "vectors": [same[order].tobytes()], "ids": [ids[by].tobytes()], "first": [first.astype(np.int64).tobytes()], "nodes": [nodes.tobytes()]})

    dealt = vectors.withColumn("dim", F.size("vec")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(run, SCHEMA)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = FACTOR, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for the (id, vec) rows of ``queries``
    against all of ``vectors``."""
    spark = vectors.sparkSession
    index = cut(build_index(cut(vectors, "vp-vectors"), shard), "vp-index")
    # one shard a task, dealt by number: a hash of the number would leave tasks without any
    number = F.row_number().over(Window.orderBy("dim", "shard")) - 1
    places = index.select("dim", "shard").withColumn("place", number)   # two narrow columns, one row per shard
    shards = max(1, index.count())
    index = index.join(F.broadcast(places), ["dim", "shard"]).repartitionByRange(shards, "place")
    queries = cut(queries.select("id", "vec").distinct(), "vp-queries")
    blocks = max(1, -(-queries.count() // block))
    found = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)) == b).toArrow()
        if not rows.num_rows:
            continue
        by: dict[int, tuple[list, list]] = {}
        for i, v in zip(rows["id"].to_pylist(), rows["vec"].to_numpy()):
            by.setdefault(len(v), ([], []))
            by[len(v)][0].append(i), by[len(v)][1].append(np.asarray(v))
        shared = spark.sparkContext.broadcast({dim: (np.array(own, np.int64), np.stack(q)) for dim, (own, q) in by.items()})

        def run(batches, shared=shared):
            held = {dim: Best(q, own, k) for dim, (own, q) in shared.value.items()}
            for t in batches:
                for r in t.to_pylist():
                    if r["dim"] in held:
                        x = np.frombuffer(r["vectors"]).reshape(r["n"], -1)
                        search(x, np.frombuffer(r["ids"], np.int64), np.frombuffer(r["first"], np.int64), np.frombuffer(r["nodes"]).reshape(-1, 4), held[r["dim"]], factor)
            for best in held.values():
                at, col = np.nonzero(best.i != NONE)
                yield pa.RecordBatch.from_arrays([pa.array(best.own[at]), pa.array(best.i[at, col]), pa.array(best.d[at, col])], names=["query_id", "vec_id", "score"])

        part = index.drop("place").mapInArrow(run, "query_id long, vec_id long, score double")
        if blocks > 1:                        # one block's results are done before the next is sent
            part = cut(part, "vp-found")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    # an id that repeats with other vectors is one neighbour, at its smallest distance
    single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return single.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
