"""Exact top-k by inner product: branch and bound over a ball tree for each shard."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spill, table

_FORM = "query_id long, vec_id long, score long"
_TREE = "dim int, shard long, ids binary, points binary, centres binary, radius binary, spans binary"
LEAST, MOST = -(2**63), 2**63 - 1


class BallTree:
    """Nodes of points with centre and radius; a node's inner products with q are at most q.centre + |q| radius.

    Points are put in the order of the leaves, so that a node is a range of rows; spans has the
    range and the two children (-1: a leaf) of each node.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = 40):
        self._order = np.arange(len(points))
        self._nodes: list[list] = []
        self._grow(points.astype(np.float64), 0, len(points), leaf)
        self.ids, self.points = ids[self._order], points[self._order]
        self.centres = np.array([n[0] for n in self._nodes])
        self.radius = np.array([n[1] for n in self._nodes])
        self.spans = np.array([n[2:] for n in self._nodes], np.int64)
        del self._order, self._nodes

    def _grow(self, points: np.ndarray, a: int, b: int, leaf: int) -> int:
        own = points[self._order[a:b]]
        centre = own.mean(0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(1).max()))
        at = len(self._nodes)
        self._nodes.append([centre, radius, a, b, -1, -1])
        if b - a > leaf and radius > 0:
            # Split at the median along the line from the farthest point to the one farthest from it.
            far = own[((own - centre) ** 2).sum(1).argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            along = own @ (other - far)
            self._order[a:b] = self._order[a:b][np.argsort(along, kind="stable")]
            m = (a + b) // 2
            self._nodes[at][4:] = self._grow(points, a, m, leaf), self._grow(points, m, b, leaf)
        return at

    def row(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.points, self.centres, self.radius, self.spans)]

    @classmethod
    def of(cls, dim: int, ids: bytes, points: bytes, centres: bytes, radius: bytes, spans: bytes) -> BallTree:
        tree = cls.__new__(cls)
        tree.ids, tree.radius, tree.spans = np.frombuffer(ids, np.int64), np.frombuffer(radius), np.frombuffer(spans, np.int64).reshape(-1, 4)
        tree.points, tree.centres = np.frombuffer(points, np.int64).reshape(-1, dim), np.frombuffer(centres).reshape(-1, dim)
        return tree


def _dot(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as far as a long goes: in doubles or longs where they hold every sum, else in unbounded integers."""
    most = float(np.abs(points.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * len(q)
    if most < 2**53:
        return (points.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return points @ q
    return np.array([min(max(sum(a * b for a, b in zip(row, q.tolist(), strict=True)), LEAST), MOST) for row in points.tolist()], np.int64)


def search(tree: BallTree, q: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
    """(score, id) of the k best points but `own`, best first, ties to the smaller id; none below the score `floor`.

    Nodes are taken by their upper bound; a node whose bound is below the kth score so far, or below
    floor, which another shard has reached, holds nothing of use, and nor does any later one.
    """
    wide = q.astype(np.float64)
    norm = float(np.sqrt((wide**2).sum()))
    tops = tree.centres @ wide + norm * tree.radius
    tops = tops + np.abs(tops) * 1e-9 + norm * 1e-6 + 1e-6
    best: list[tuple[int, int]] = []
    heap = [(-float(tops[0]), 0)]
    while heap:
        above, node = heapq.heappop(heap)
        least = best[-1][0] if len(best) == k else None
        if (least is not None and -above < least) or (floor is not None and -above < floor):
            break
        a, b, left, right = tree.spans[node].tolist()
        if left >= 0:
            for child in (left, right):
                heapq.heappush(heap, (-float(tops[child]), child))
            continue
        ids, points = tree.ids[a:b], tree.points[a:b]
        other = ids != own
        ids, scores = ids[other], _dot(points[other], q)
        if len(ids) > k:
            pick = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[pick], scores[pick]
        best = sorted([*best, *zip(scores.tolist(), ids.tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
    return [x for x in best if floor is None or x[0] >= floor]


def _plant(group: pa.Table) -> pa.Table:
    ids = np.asarray(group["vec_id"])
    points = np.asarray(group["q"].combine_chunks().flatten(), np.int64).reshape(len(ids), -1)
    row = [points.shape[1], group["shard"][0].as_py(), *BallTree(ids, points).row()]
    names = [x.split()[0] for x in _TREE.split(", ")]
    return pa.table({n: pa.array([v], t) for n, v, t in zip(names, row, (pa.int32(), pa.int64(), *[pa.binary()] * 5), strict=True)})


def _search_all(batches: Iterator[pa.RecordBatch], asked: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    """The best of a task's shards for each asked vector; the kth score so far is the floor in the next shard."""
    best: dict[int, list[tuple[int, int]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            tree = BallTree.of(row["dim"], *(row[c] for c in ("ids", "points", "centres", "radius", "spans")))
            for i, (query, q, floor) in enumerate(asked.value):
                if len(q) != row["dim"]:
                    continue
                so_far = best.get(i, [])
                kth = so_far[k - 1][0] if len(so_far) >= k else None
                floors = [x for x in (kth, floor) if x is not None]
                found = search(tree, q, query, k, max(floors, default=None))
                best[i] = sorted([*so_far, *found], key=lambda x: (-x[0], x[1]))[:k]
    out = [(asked.value[i][0], v, s) for i, rows in best.items() for s, v in rows]
    for a in range(0, len(out), 50_000):
        part = out[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 10, shard_rows: int = 4096, round_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query, for vectors (vec_id, embedding).

    Components become floor(1024 * x); scores are integer inner products, held at a long's limits.
    Vectors that are null or hold null or non-finite components, or one whose integer is no long, take
    no part, nor do rows with a null vec_id. Only vectors of one length are compared. Equal rows count
    once; all rows of a query's own vec_id are its own. Fewer than k candidates give fewer rows.

    Candidates lie in shards of about shard_rows, whose trees are grown and written once and then
    stay where they are. Queries come to them in rounds of about round_rows, each broadcast (that is
    its size bound): first to one shard, whose kth scores are the floors with which a round starts,
    then to all, where the kth score so far goes from shard to shard within a task.
    """
    spark = vectors.sparkSession
    whole = F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double")))
    fits = F.forall("embedding", lambda x: F.coalesce(F.abs(F.lit(1024.0) * x.cast("double")) < F.lit(2.0**63), F.lit(False)))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(fits, F.lit(False)))
    rows = spill(rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("q")).dropDuplicates(["vec_id", "q"]).withColumn("asked", is_query(F.col("vec_id"))))
    n, asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    shards, rounds = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / round_rows))
    held = rows.select(F.size("q").alias("dim"), F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shards)).alias("shard"), "vec_id", "q")
    trees = spill(held.filter("dim > 0").groupBy("dim", "shard").applyInArrow(_plant, _TREE))
    queries = rows.filter("asked").select("vec_id", "q", F.pmod(F.xxhash64("vec_id"), F.lit(rounds)).alias("round"))
    parts = []
    for r in range(rounds):
        block = [(x.vec_id, np.array(x.q, np.int64)) for x in queries.filter(F.col("round") == r).collect()]
        start = trees.filter("shard = 0").mapInArrow(partial(_search_all, asked=spark.sparkContext.broadcast([(i, q, None) for i, q in block]), k=k), _FORM)
        kth = {x.query_id: x.floor for x in start.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") == k).collect()}
        told = spark.sparkContext.broadcast([(i, q, kth.get(i)) for i, q in block])
        parts.append(trees.mapInArrow(partial(_search_all, asked=told, k=k), _FORM))
        if rounds > 1:
            parts[-1] = spill(parts[-1])
    found = reduce(DataFrame.unionByName, parts)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda v: v % 100 == 0)


OP2_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""
