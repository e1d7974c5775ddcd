"""Approximate nearest neighbours with a forest of sorted hash strings.

Vectors are dealt to shards of bounded size.  A shard keeps, per tree, one sorted array of
64-bit hash strings (signs of a seeded random rotation, taken around the mean of a bounded
sample of the shard).  A query descends every tree to its longest matching prefix and then
ascends all trees together, one bit at a time, until the prefixes reached hold at least
``SHARE`` of the shard's vectors, counted over the trees; those candidates are compared by
exact Euclidean distance, and the shards' nearest are merged per query.

``SHARE`` is a fixed share, not a fixed number, so recall does not fall as the table grows.
Queries are taken in blocks of ``QUERY_BLOCK`` vectors, which bounds what is broadcast.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part,
neither do vectors of another length than the most frequent one, nor null ids; equal vectors are
all candidates, ties go to the smaller id; a query's own id is never its neighbour; with fewer
candidates than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 64
BITS = 64
SHARE = 0.45
SHARD_ROWS = 8192
SAMPLE_ROWS = 2048  # of a shard, to fit its centre
QUERY_BLOCK = 4096
SEED = 7


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (top.d if top else 0))


class Forest:
    """The sorted hash strings of one shard."""

    def __init__(self, x: np.ndarray):
        n, d = x.shape
        self.x, rng = x, np.random.default_rng(SEED)
        self.centre = x[np.linspace(0, n - 1, min(n, SAMPLE_ROWS)).astype(int)].mean(0)
        self.turns = []
        for _ in range(TREES):
            wide = [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(-(-BITS // d))]
            self.turns.append(np.hstack(wide)[:, :BITS])
        keys = [self._strings(x, t) for t in self.turns]
        self.order = [np.argsort(k, kind="stable") for k in keys]
        self.sorted = [k[o] for k, o in zip(keys, self.order)]

    def _strings(self, x, turn):
        bits = np.packbits((x - self.centre) @ turn > 0, axis=1)
        return np.ascontiguousarray(bits).view(">u8").astype(np.uint64).ravel()

    def candidates(self, q: np.ndarray, wanted: int):
        """Rows under the prefixes reached for each query, by a common ascent of all trees."""
        keys = [self._strings(q, t) for t in self.turns]
        out, left = [None] * len(q), np.arange(len(q))
        for length in range(BITS, -1, -1):
            keep = np.uint64(((1 << length) - 1) << (BITS - length))
            lo = np.stack([np.searchsorted(s, k[left] & keep) for s, k in zip(self.sorted, keys)], 1)
            hi = np.stack([np.searchsorted(s, k[left] | ~keep, "right") for s, k in zip(self.sorted, keys)], 1)
            stop = np.zeros(len(left), bool)
            for at in np.flatnonzero((hi - lo).sum(1) >= wanted):  # distinct rows are at most these
                mark = np.zeros(len(self.x), bool)
                for o, a, b in zip(self.order, lo[at], hi[at]):
                    mark[o[a:b]] = True
                if length == 0 or int(mark.sum()) >= wanted:
                    out[left[at]], stop[at] = np.flatnonzero(mark), True
            left = left[~stop]
            if not len(left):
                break
        return out


def _search(shared, k):
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        ids = np.concatenate([np.asarray(b.column("id")) for b in got])
        x = np.concatenate([np.asarray(b.column("v").flatten()).reshape(b.num_rows, -1) for b in got])
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        q_ids, q = shared.value
        forest = Forest(x)
        for lo in range(0, len(q_ids), 256):
            out = []
            for i, rows in zip(range(lo, lo + 256), forest.candidates(q[lo:lo + 256], min(len(ids), int(np.ceil(SHARE * len(ids))) + k + 1))):
                rows = rows[ids[rows] != q_ids[i]]
                dist = np.sqrt(((x[rows] - q[i]) ** 2).sum(1))
                if len(rows) > k:
                    near = dist <= np.partition(dist, k - 1)[k - 1]
                    rows, dist = rows[near], dist[near]
                best = np.lexsort((ids[rows], dist))[:k]
                out += [(q_ids[i], ids[rows[b]], dist[b]) for b in best]
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                                             ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vec_col)
    queries = valid_vectors(vectors.where(is_query), id_col, vec_col).dropDuplicates(["id"])
    n, n_queries = rows.count(), queries.count()
    shards = rows.repartition(max(1, -(-n // SHARD_ROWS)), F.xxhash64("id", "v"))
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    found = None
    for b in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").collect()
        if not part:
            continue
        shared = spark.sparkContext.broadcast((np.array([r.id for r in part]), np.array([r.v for r in part])))
        near = shards.mapInArrow(_search(shared, k), "query_id long, vec_id long, score double")
        found = near if found is None else found.union(near)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
