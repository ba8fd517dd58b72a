"""Exact top-k search by inner product: aggregation of sorted lists without random access.

Rows are dealt to shards of bounded size; in a shard each component is a list of (value, row) sorted by value, and nothing else is kept of
the rows. A query reads its lists in step, in slices, each from the end that adds most to the score. The lower bound of a row has what was
read of it, and the least value of each list that has not shown it yet; its upper bound has the value last read there instead. A row that was
not seen has the sum of the values last read as its upper bound. When that is under the k-th lower bound, no unseen row can qualify, and of
the others those are dropped whose upper bound is under it; the final scores of the rest are what reading on adds, until all lists have shown
them. The best k of each shard meet in one window a query.

Queries go to the shards, as the rows are many times more; a shard's lists are made once, and the queries pass by in blocks. The queries of a
block read the lists together, so that bounds are products of weights and of what was read; a query whose scores are settled leaves the block.

Defined results: rows with a null vec_id, or a vector that is null or has a null, NaN or infinite component, take no part; vectors of
different lengths meet over the components that both have; rows with the query's own vec_id are left out; a query row that is repeated is
one query; ties go to the smaller vec_id; an integer component or a score beyond 64 bits is the nearest that fits, and ranks by its exact
sum within a shard; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a shard, about; entries that the first slice of each list has (the depth then grows fourfold, or by half of what is left); queries of a block.
SHARD, SLICE, BLOCK = 8192, 64, 128
#: Whole numbers below this are exact as floats.
EXACT = 1 << 53
NEVER = float("-inf")
FOUND = "query_key long, query_id long, vec_id long, score long"
LONG = np.iinfo(np.int64)


def usable(vectors: DataFrame, scale: float = 1024.0) -> DataFrame:
    """vec_id and the vector as integers floor(scale * x); rows that take no part are left out."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(wide, lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v"))


def _matrix(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Lists:
    """Sorted lists of the components of some rows, and the entries that were read of them."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        lines = np.ascontiguousarray(x.T)
        self.rows = np.argsort(lines, axis=1, kind="stable")
        self.values, self.ids, self.read = np.take_along_axis(lines, self.rows, axis=1), ids, 0
        self.largest = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0

    def best(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and scores of the k best rows but those with the vec_id ``own``."""
        return self.best_of(q[None], k, np.array([own]))[0]

    def best_of(self, queries: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for a block of queries, which read the lists together."""
        q, n = queries[:, : len(self.values)], len(self.ids)
        out = [(self.ids[:0], self.values.ravel()[:0])] * len(q)
        if not n:
            return out
        most = max(abs(int(q.min())), abs(int(q.max()))) if q.size else 0
        # Sums of floats are exact below 2**53; Python's integers have any size.
        kind = np.float64 if max(self.largest, 1) * most * q.shape[1] < EXACT and self.largest < EXACT else object
        # Lists that are read from the greatest value down, and from the least one up.
        sides = [
            (at, np.where(sign * q[:, at] > 0, q[:, at], 0).astype(kind), self.rows[at], self.values[at].astype(kind), sign)
            for sign in (1, -1) for at in [np.flatnonzero((sign * q > 0).any(axis=0))]
        ]
        # What was read of each row, and what adds least where nothing was read yet.
        known = [np.repeat(values[:, :1] if sign > 0 else values[:, -1:], n, axis=1) for _, _, _, values, sign in sides]
        weights = [w for _, w, *_ in sides]
        asked, depth = np.arange(len(q)), 0
        while len(asked):
            start, depth = depth, min(n, max(SLICE, min(4 * depth, depth + max(SLICE, n // 16, (n - depth) // 2))))
            if not sum(len(at) for at, *_ in sides):
                depth = n  # without a list every row scores 0
            last = []
            for (at, _, rows, values, sign), seen in zip(sides, known, strict=True):
                part = slice(n - depth, n - start) if sign > 0 else slice(start, depth)
                seen[np.arange(len(at))[:, None], rows[:, part]] = values[:, part]
                last.append(values[:, n - depth if sign > 0 else depth - 1][:, None])
                self.read += rows[:, part].size
            lower = sum(w @ seen for w, seen in zip(weights, known, strict=True))
            lower[own[asked][:, None] == self.ids] = NEVER
            bar = np.partition(lower, n - k, axis=1)[:, n - k] if n >= k else np.full(len(asked), NEVER)
            unseen = sum((w @ x)[:, 0] for w, x in zip(weights, last, strict=True))
            closed = np.flatnonzero((unseen < bar) | (depth == n))  # no unseen row can qualify
            if not len(closed):
                continue
            bound = [np.maximum(seen, x) if sign > 0 else np.minimum(seen, x) for (*_, sign), seen, x in zip(sides, known, last, strict=True)]
            upper = sum(w[closed] @ x for w, x in zip(weights, bound, strict=True))
            low, bars = lower[closed], bar[closed][:, None]
            stay = (upper >= bars) & (low > NEVER)
            settled = (~stay | (upper == low)).all(axis=1)
            for i in np.flatnonzero(settled):
                rows = np.flatnonzero(stay[i])
                order = np.array(sorted(range(len(rows)), key=lambda r: (-int(low[i, rows[r]]), int(self.ids[rows[r]])))[:k], np.int64)
                out[asked[closed[i]]] = self.ids[rows[order]], low[i, rows[order]]
            left = np.ones(len(asked), bool)
            left[closed[settled]] = False
            asked, weights = asked[left], [w[left] for w in weights]
        return out


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows and, after them, queries of one shard after the other; the queries of a shard go in blocks."""
    shard, rows, ids, lists = None, [], [], None
    asked: list[tuple] = []

    def answers() -> pa.RecordBatch:
        keys, own, vectors = zip(*asked, strict=True) if asked else ((), (), ())
        best = lists.best_of(_matrix(vectors), k, np.array(own, np.int64)) if asked else []
        found = [(key, i, row, min(max(int(s), LONG.min), LONG.max)) for key, i, hits in zip(keys, own, best, strict=True) for row, s in zip(*hits, strict=True)]
        asked.clear()
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query_key", "query_id", "vec_id", "score"])

    for batch in batches:
        kinds, shards = batch.column("query_key"), batch.column("shard").to_pylist()
        for at, key, i, v in zip(shards, kinds.to_pylist(), batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
            if at != shard:
                yield answers()
                shard, rows, ids, lists = at, [], [], None
            if key is None:
                rows.append(np.array(v, np.int64))
                ids.append(i)
                continue
            if lists is None:
                lists, rows = Lists(_matrix(rows), np.array(ids, np.int64)), []
            asked.append((key, i, v))
            if len(asked) == BLOCK:
                yield answers()
    yield answers()


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best of ``vectors`` for each of ``queries`` (both as ``usable`` gives them).

    The rows are shuffled once; the queries are a stated set, and each goes once to every shard.
    """
    shards = max(1, -(-vectors.count() // SHARD))
    queries = queries.select(F.xxhash64("vec_id", "v").alias("query_key"), "vec_id", "v").dropDuplicates(["query_key"])
    rows = vectors.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"), F.lit(None).cast("long").alias("query_key"), "vec_id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "query_key", "vec_id", "v")
    met = rows.unionByName(asked).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", F.col("query_key").asc_nulls_first())
    found = met.mapInArrow(lambda it: _search(it, k), FOUND)
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))


QUERIES = {"op4_topk": op4_topk}
ORACLE = {
    "op4_topk": """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM s QUALIFY rank <= 10
"""
}
