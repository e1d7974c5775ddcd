"""Learned abbreviations and the split by selection."""

import pytest
from pyspark.sql import functions as F

from spanforge.operators.dataset import split_by_selection, train_val_split
from spanforge.operators.sentences import learn_abbreviations, sentence_splitter


def test_abbreviations_of_the_corpus_are_not_cut(spark):
    text = "we met dr. smith at the inc. office. he uses tools e.g. spark daily. the office was open. spark is open. smith left the office daily."
    other = "spark was open in the office and the daily tools were open"
    corpus = spark.createDataFrame([(i, t) for i in range(40) for t in (text, other)], "id int, text string")
    words = {r.word for r in learn_abbreviations(corpus).collect()}
    assert {"dr", "inc", "e.g"} <= words and not words & {"office", "daily", "open", "spark"}
    split = sentence_splitter(words)
    got = corpus.where(F.col("text") == text).limit(1).select(split(F.col("text")).alias("s")).first().s
    assert got == ["we met dr. smith at the inc. office.", "he uses tools e.g. spark daily.", "the office was open.", "spark is open.", "smith left the office daily."]
    rows = spark.createDataFrame([("a dr. b",), ("xdr. b",), ("'dr. b",), ("dr. b",), (None,), ("",)], "t string").select(split(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [["a dr. b"], ["xdr.", "b"], ["'dr. b"], ["dr. b"], None, [""]]
    none = corpus.limit(0)
    assert learn_abbreviations(none).count() == 0
    assert spark.createDataFrame([("a dr. b",)], "t string").select(sentence_splitter([])(F.col("t")).alias("s")).first().s == ["a dr.", "b"]


@pytest.mark.parametrize("n,ratio", [(0, 0.8), (1, 0.8), (11, 0.8), (997, 0.5), (997, 1.0), (997, 0.0), (5000, 0.8)])
def test_selection_equals_the_sorted_split(spark, n, ratio):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("payload").alias("text"))
    got = split_by_selection(df, "id", ratio, 7)
    assert got.columns == ["id", "text", "split"]
    assert {r.id: r.split for r in got.collect()} == {r.id: r.split for r in train_val_split(df, "id", ratio, 7).collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_rows_of_one_key_share_a_side(spark):
    df = spark.createDataFrame([(str(i % 5),) for i in range(50)], "id string")
    sides = {}
    for r in split_by_selection(df, "id", 0.5).collect():
        sides.setdefault(r.id, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values()) and len(sides) == 5
