"""Exact top-k search by inner product over vector-approximation files.

Vectors are integers (``floor(SCALE * x)``).  Every dimension is cut into at most ``CELLS`` cells at the
quantiles of a bounded sample, the outermost ending at the true minimum and maximum; a vector's
approximation is one byte a dimension.  The **scan** compares blocks of queries with blocks of
approximations only: two matrix products give an upper and a lower bound of each score, and
what cannot reach the block's kth lower bound goes.  The **reading** takes exact vectors of the
candidates left over all blocks, the best bound first, in growing rounds, until no bound left
reaches the kth exact score.  Nothing is approximate in the result.

Blocks of queries meet blocks of approximations by a join on the pair of block numbers, so a
task holds one pair, ``QUERY_BLOCK`` by ``SHARD_ROWS``, whatever the table's size.  Equal vectors
are one candidate that carries its ``k + 1`` smallest ids, which is all that a top k can show of
them: a vector that a third of the rows share costs no more than another.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor null
ids, nor vectors of another length than the most frequent one (ties: the shorter); zero
vectors do; whole repeated rows (id and vector) count once; of several vectors under one id each
is a query and a candidate of its own, but none of them is a candidate of that id; components
and scores beyond the range of a long are cut to it; with fewer candidates than ``k`` all
are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 256
CELLS = 64
SAMPLE_ROWS = 4096  # vectors whose quantiles place the marks
SHARD_ROWS = 16384
QUERY_BLOCK = 2048
STEP = 256  # queries compared at once within a pair of blocks
EXACT = 2.0**53


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v``: distinct valid rows with integer components."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (top.d if top else 0))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v")).dropDuplicates(["v", "id"])


def matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, width).astype(kind, copy=False)


def place_marks(vectors: DataFrame, width: int) -> np.ndarray:
    """Cell limits, ``CELLS + 1`` a dimension: cell ``c`` of dimension ``d`` is ``marks[d, c] .. marks[d, c + 1]``.

    Quantiles of ``SAMPLE_ROWS`` vectors (smallest hashes) inside the extremes of all."""
    def extremes(batches):
        low = high = None
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("v"), width)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(low), pa.array(high)], ["d", "low", "high"])

    ends = vectors.select("v").mapInArrow(extremes, "d int, low long, high long").groupBy("d").agg(F.min("low"), F.max("high")).orderBy("d").collect()
    some = vectors.orderBy(F.xxhash64("id", "v"), "id", "v").limit(SAMPLE_ROWS).select("v").toArrow()
    marks = np.quantile(matrix(some.column("v"), width), np.arange(CELLS + 1) / CELLS, axis=0, method="nearest").T.copy()
    marks[:, 0], marks[:, -1] = [r[1] for r in ends], [r[2] for r in ends]
    return np.maximum.accumulate(np.clip(marks, marks[:, :1], marks[:, -1:]), axis=1)


def approximate(marks: np.ndarray):
    """Adds ``cells``: a byte a dimension, the cell whose limits hold the component."""
    def run(batches):
        for b in batches:
            x = matrix(b.column("v"), len(marks))
            code = np.empty(x.shape, np.uint8)
            for d, m in enumerate(marks):
                code[:, d] = np.searchsorted(m[1:-1], x[:, d], "left")  # mark[c] <= x <= mark[c + 1]
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(marks)), len(x), [None, pa.py_buffer(code)]).cast(pa.binary()) if len(x) else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, raw], [*b.schema.names, "cells"])
    return run


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Lower and upper bounds of the products of queries with cells ``low .. high``; sums
    beyond the exact range of doubles get a margin for their rounding."""
    plus, minus = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    a, b = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    reach = np.abs(q.astype(float)).sum(1) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    slack = np.where(reach < EXACT, 0.0, reach * 2.0**-40)[:, None]
    return np.clip(a - slack, -(2.0**63), 2.0**63), np.clip(b + slack, -(2.0**63), 2.0**63)  # scores are cut so, too


def scanner(marks: np.ndarray, k: int):
    """One pair of blocks: candidates whose upper bound reaches the block's kth lower bound."""
    width = len(marks)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"q": [], "rep": [], "low": [], "high": []}
        if left.num_rows and right.num_rows:
            code = np.frombuffer(b"".join(right.column("cells").to_pylist()), np.uint8).reshape(-1, width)
            low, high = (np.take_along_axis(marks.T, code.astype(np.int64) + s, 0).astype(float) for s in (0, 1))
            rep, only = np.asarray(right.column("rep")), right.column("only").fill_null(-1).to_numpy()
            has_one = right.column("only").is_valid().to_numpy()
            q, key, own = matrix(left.column("v"), width), np.asarray(left.column("q")), np.asarray(left.column("id"))
            for s in range(0, len(q), STEP):
                a, b = bounds(q[s:s + STEP], low, high)
                self_only = (own[s:s + STEP, None] == only) & has_one
                a[self_only] = b[self_only] = -np.inf
                kth = np.partition(a, -k, axis=1)[:, -k] if a.shape[1] > k else np.full(len(a), -np.inf)
                i, j = np.nonzero((b >= kth[:, None]) & ~self_only)
                for name, x in zip(out, (key[s + i], rep[j], a[i, j], b[i, j])):
                    out[name].append(x)
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: pa.array(np.concatenate(x) if x else [], t) for (n, x), t in zip(out.items(), types)})
    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row inner products, exact, cut to the range of a long."""
    if len(q) and np.abs(q.astype(float)).max(initial=0) * np.abs(x.astype(float)).max(initial=0) * q.shape[1] < 2.0**62:
        return (q * x).sum(1)
    exact = (sum(int(a) * int(b) for a, b in zip(u, w)) for u, w in zip(q.tolist(), x.tolist()))
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], np.int64)


def _score(width):
    def run(batches):
        for b in batches:
            s = products(matrix(b.column("qv"), width), matrix(b.column("v"), width))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("id"), b.column("ids"), pa.array(s, pa.int64())], ["q", "id", "ids", "score"])
    return run


def best(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def read_in_order(candidates: DataFrame, queries: DataFrame, vectors: DataFrame, width: int, k: int) -> DataFrame:
    """Exact results ``q, id, vec, score`` of the candidates, read by falling upper bound until
    the kth score of each query is certain."""
    kth = lambda rows, col: best(rows, k, F.desc(col)).groupBy("q").agg(F.when(F.count("*") == k, F.min(col)).alias("kth"))
    reaches = F.col("kth").isNull() | (F.col("high") >= F.col("kth"))
    left = written(candidates.join(kth(candidates, "low"), "q").where(reaches).select("q", "rep", "high"), "va-candidates")
    found, wanted = None, 2 * k
    while True:
        turn = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("high"), "rep"))
        ranked = left.withColumn("turn", turn)
        now = ranked.where(F.col("turn") <= wanted).join(vectors, "rep").join(queries.select("q", "id", F.col("v").alias("qv")), "q")
        exact = now.select("q", "id", "ids", "qv", "v").mapInArrow(_score(width), "q long, id long, ids array<bigint>, score long")
        exact = exact.select("q", "id", F.explode("ids").alias("vec"), "score").where("vec <> id")
        found = best(exact if found is None else found.unionByName(exact), k, F.desc("score"), "vec").drop("rank")
        found = written(found, "va-found")
        done = found.groupBy("q").agg(F.when(F.count("*") == k, F.min("score")).cast("double").alias("kth"))
        rest = ranked.where(F.col("turn") > wanted).join(done, "q", "left")
        left = written(rest.where(reaches).select("q", "rep", "high"), "va-candidates")
        if left.isEmpty():
            return found
        wanted *= 4


def top_inner_products(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each row where
    ``is_query`` (over ``id``) holds, ties to the smaller id."""
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, id_col, vec_col), "va-rows")
    some = rows.select(F.size("v").alias("d")).first()
    if not some or not some.d:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # equal vectors: the smallest ids stand for all
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    reps = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("rep", F.monotonically_increasing_id())
    reps = written(reps, "va-vectors")
    queries = written(rows.where(is_query).withColumn("q", F.monotonically_increasing_id()), "va-queries")
    marks = place_marks(rows, some.d)
    cells = reps.select("rep", F.when(F.size("ids") == 1, F.col("ids")[0]).alias("only"), "v")
    cells = cells.mapInArrow(approximate(marks), "rep long, only long, v array<bigint>, cells binary").drop("v")
    cells = written(cells, "va-cells")
    shards, blocks = -(-cells.count() // SHARD_ROWS), max(1, -(-queries.count() // QUERY_BLOCK))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("block", part("q", blocks)).withColumn("shard", spread(shards))
    right = cells.withColumn("shard", part("rep", shards)).withColumn("block", spread(blocks))
    pairs = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
    found = written(pairs.applyInArrow(scanner(marks, k), "q long, rep long, low double, high double"), "va-scan")
    result = read_in_order(found, queries, reps, some.d, k)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec"))
    return result.select(F.col("id").alias("query_id"), rank.alias("rank"), F.col("vec").alias("vec_id"), "score")


ORACLE = """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
