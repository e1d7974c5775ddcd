"""The corpus job, stage by stage, on the smallest tables."""

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from spanforge.llm.common import written
from spanforge.llm.oracle import ORACLE_SQL
from spanforge.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(QUERIES) <= set(E.queries()) and "pipeline" in E.queries()


def test_queries_with_twins_match(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        want, got = con.sql(sql), QUERIES[name](spark, SF)
        assert sorted(want.columns) == sorted(got.columns)
        key = lambda r: str(tuple(round(x, 9) if isinstance(x, float) else x for x in r))
        assert sorted(map(key, map(tuple, got.select(*want.columns).collect()))) == sorted(map(key, want.fetchall())), name


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {"documents": docs}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns + (["copy_no"] if i == len(corpus_pipeline.STAGES) - 1 else [])
        kept[name] = docs
    rows = {k: v.collect() for k, v in kept.items()}
    named = {r.doc_id for r in rows["documents"] if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in rows["language_id"]} == named
    groups = brute.jaccard_components([(r.doc_id, r.text) for r in rows["language_id"]], 5, 80, 100)
    assert sorted(r.doc_id for r in rows["near_duplicates"]) == sorted({c for _n, c in groups.values()})
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in rows["near_duplicates"] if any(t in r.text.lower() for t in items)}
    gone = {r.doc_id for r in rows["near_duplicates"]} - {r.doc_id for r in rows["decontamination"]}
    assert leaked and leaked <= gone and len(gone) <= 2 * len(leaked)
    for r in rows["pii"]:
        assert brute.private(r.text)[0] == [0, 0, 0, 0] and r.n_chars == len(r.text)
    clean = {r.doc_id: r for r in rows["pii"]}
    assert {r.doc_id for r in rows["mix"]} <= set(clean) and all(r.text == clean[r.doc_id].text for r in rows["mix"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    import random
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdefgh')}{r.randint(0, 10**6)}" for _ in range(n))


def test_texts_under_one_id_are_judged_alone(spark):
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    rows = [(5, a), (9, a), (9, b), (9, b), (7, c), (None, a), (None, a), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], DOCS).withColumns({"node": F.lit(1), "grp": F.lit(2)})
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(5, a), (9, b), (7, c), (None, a), (None, a), (3, None), (4, "")], key=str)


def test_no_labels_and_clashing_columns(spark):
    rows = [(i, words(30, i) if i % 5 else None, None, f"s{i % 2}", 1) for i in range(20)]
    names = ["score", "lang_pred", "second", "dc_hits", "dc_x", "pii_x", "pii_text", "mix_x", "mix_u", "kept_0", "other_1", "copy_no"]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(f"own {c}") for c in names})
    for labelled in (False, True):
        d = docs.withColumn("lang", F.lit("en")) if labelled else docs
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
            assert sorted(d.columns) == sorted(docs.columns)
        got = d.collect()
        assert got and {r.doc_id for r in got} <= {i for i in range(20) if i % 5}
        assert all(r[c] == f"own {c}" for r in got for c in names if c != "copy_no") and all(isinstance(r.copy_no, int) for r in got)
