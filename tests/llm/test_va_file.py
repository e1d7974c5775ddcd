"""Exact inner-product search against plain integers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from spanforge.llm import va_file
from spanforge.llm.va_file import top_inner_products


def plain(rows, modulus, k):
    """``rows``: (id, vector); the most frequent length is the first row's."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    sizes = [len(v) for _i, v in rows if v is not None]
    d = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    ok = {(i, tuple(cut(math.floor(256 * x)) if math.isfinite(256 * x) else cut(int(x) * 256) for x in v)) for i, v in ok if len(v) == d}
    out = []
    for i, q in ok:
        if i % modulus == 0:
            near = sorted((-cut(sum(a * b for a, b in zip(q, v))), j) for j, v in ok if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def search(spark, rows, modulus, k, kind="double"):
    d = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit(1) for c in ("q", "v", "id", "rep", "rank", "score", "block")})
    got = top_inner_products(d.repartition(5), F.col("id") % modulus == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_many_blocks_ties_and_hostile_rows(spark, monkeypatch):
    monkeypatch.setattr(va_file, "SHARD_ROWS", 64)
    monkeypatch.setattr(va_file, "QUERY_BLOCK", 8)
    monkeypatch.setattr(va_file, "STEP", 3)
    monkeypatch.setattr(va_file, "CELLS", 8)
    monkeypatch.setattr(va_file, "SAMPLE_ROWS", 50)
    r = random.Random(2)
    vec = lambda: [r.gauss(0, 0.4) for _ in range(6)]
    rows = [(i, vec()) for i in range(400)]
    hot = vec()
    rows += [(1000 + i, hot) for i in range(250)] + [(40, rows[40][1])] * 60  # one common vector, one repeated row
    rows += [(50, vec()), (50, vec()), (7, rows[90][1]), (2000, [0.0] * 6), (2050, [9.0, -9.0, 0.5, 3.0, 0.001, -0.001])]
    rows += [(None, vec()), (3000, None), (3050, [1.0, None] + [0.0] * 4), (3100, [math.nan] * 6), (3150, [math.inf] + [0.0] * 5), (3200, [1.0]), (3250, [])]
    assert search(spark, rows, 10, 5) == plain(rows, 10, 5)


def test_components_beyond_a_long(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) * 10 ** r.choice([0, 3, 9, 16, 17, 40, 300]) for _ in range(4)]) for i in range(40)]
    assert search(spark, rows, 3, 4) == plain(rows, 3, 4)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0]), (50, [2.0]), (3, [-1.0])], [(0, None)]])
def test_few_rows(spark, rows):
    assert search(spark, rows, 50, 5, "float") == plain(rows, 50, 5)


def test_the_scan_leaves_little_to_read(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = va_file.integer_vectors(rows, "vec_id", "embedding").withColumn("rep", F.monotonically_increasing_id())
    marks = va_file.place_marks(vectors, 64)
    cells = vectors.selectExpr("rep", "id AS only", "v").mapInArrow(va_file.approximate(marks), "rep long, only long, v array<bigint>, cells binary").toArrow()
    some = vectors.where("id % 50 = 0").selectExpr("rep AS q", "id", "v").toArrow()
    got = va_file.scanner(marks, 5)(some, cells)
    assert 5 * some.num_rows <= got.num_rows < 0.1 * some.num_rows * cells.num_rows
