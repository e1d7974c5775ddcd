from spanforge.operators.corpus import distinct_corpus, keyword_filter, null_counts, require, union_sources
from spanforge.operators.evaluation import best_run
from spanforge.sources.registry import PANDAS_NA_TOKENS, SourceSpec, land, read_source, source_status


def _csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv_multiline_and_na_tokens(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", 'Job Title,Job Description\n"JavaScript dev","line one\nline ""two"""\nNA,x\n'
                                   'Java,NA\n')
    spec = SourceSpec("a", path, description="Job Description", title="Job Title", fmt="csv",
                      null_tokens=tuple(PANDAS_NA_TOKENS))
    rows = read_source(spark, spec).collect()
    assert [(r.title, r.description) for r in rows] == [
        ("JavaScript dev", 'line one\nline "two"'), (None, "x"), ("Java", None)]


def test_title_filter_rules(spark):
    df = spark.createDataFrame([("JavaScript dev",), (None,), ("Chef",), ("JAVA lead",)], "t string")
    assert [r.t for r in keyword_filter(df, "t", ["java"]).collect()] == ["JavaScript dev", "JAVA lead"]
    assert keyword_filter(df, "t", []).count() == 3
    assert keyword_filter(df, "t", ["a.b", "c++"]).count() == 0  # literals, not regex


def test_union_distinct_and_status(spark, tmp_path):
    a = _csv(tmp_path, "a.csv", "title,description\nRing dev,same\nother,no\nring x,first\n")
    b = _csv(tmp_path, "b.csv", "description\nsame\nfirst\nonly b\n")
    c = _csv(tmp_path, "c.csv", "foo\n1\n")
    specs = [SourceSpec("a", a, description="description", title="title", fmt="csv", rank=0),
             SourceSpec("b", b, description="description", fmt="csv", rank=1),
             SourceSpec("c", c, description="jobdescription", fmt="csv", rank=2)]
    u = union_sources(spark, specs, ["ring"])
    assert sorted((r.source, r.description) for r in u.collect()) == [
        ("a", "first"), ("a", "same"), ("b", "first"), ("b", "only b"), ("b", "same")]
    d = {r.description: r.source for r in distinct_corpus(u).collect()}
    assert d == {"first": "a", "same": "a", "only b": "b"}
    st = {r.source: (r.ok, r.rows) for r in source_status(spark, specs).collect()}
    assert st == {"a": (True, 3), "b": (True, 3), "c": (False, 0)}


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, None)], "a int, b string")
    r = null_counts(df).first()
    assert (r.n_rows, r.null_a, r.null_b) == (3, 1, 2)


def test_filters_reach_the_scan(spark):
    df = require(read_source(spark, SourceSpec("d", "/root/testdata/sf0.001/documents.parquet", description="text")), ["description"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(text)]" in plan and "ReadSchema: struct<text:string>" in plan


def test_unreadable_and_no_sources(spark, tmp_path):
    gone = SourceSpec("gone", str(tmp_path / "none.csv"), description="d", fmt="csv")
    assert read_source(spark, gone) is None and union_sources(spark, [gone], []).count() == 0 and union_sources(spark, [], []).columns == ["source", "source_rank", "description"]
    r = source_status(spark, [gone]).first()
    assert (r.source, r.ok, r.rows) == ("gone", False, 0) and "unreadable" in r.reason and land(spark, gone, str(tmp_path / "x")) == gone


def test_distinct_and_best_run_are_hash_aggregates(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("b", 1, "x"), ("b", 1, "y")], "source string, source_rank int, description string")
    specs = [SourceSpec("a", "", "", rank=0), SourceSpec("b", "", "", rank=1)]
    d = distinct_corpus(df, specs=specs)
    assert "SortAggregate" not in d._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.source, r.description) for r in d.collect()) == [("a", "x"), ("b", "y")] == sorted((r.source, r.description) for r in distinct_corpus(df).collect())
    m = spark.createDataFrame([("r", 1, 0.5), ("r", 3, 0.9), ("r", 2, 0.9), ("s", 4, None)], "run string, id int, f1 double")
    assert [tuple(r) for r in best_run(m, "run", "f1", "id").collect()] == [("r", 2, 0.9)]
