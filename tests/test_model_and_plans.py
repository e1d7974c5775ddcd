from spanforge.operators.corpus import distinct_corpus, union_sources
from spanforge.operators.dataset import train_val_split
from spanforge.operators.evaluation import evaluate
from spanforge.operators.scoring import CANDIDATE_SCHEMA, piece_candidate_scorer, score_tokens
from spanforge.operators.tagging import tag_words
from spanforge.operators.training import load_tagger, predict_pairs, save_tagger, tag_text, token_features, train_tagger
from spanforge.plans import queries as Q
from spanforge.plans.corpus_job import run_corpus
from spanforge.plans.fixtures import TEST_DICTIONARY, TEST_EXCLUSIONS, TITLE_KEYWORDS
from spanforge.plans.fixtures import test_specs as fixture_specs
from spanforge.sources.dictionary import LABELS

SF = "/root/testdata/sf0.001"


def test_tagger_beats_all_o_baseline_and_is_saved(spark, tmp_path):
    wl = Q.gold_word_level(spark, SF)
    split = train_val_split(wl, "id", 0.8, 42)
    model, metrics = train_tagger(split.where("split = 'train'"), split.where("split = 'validation'"),
                                  grid=(0.0,), max_iter=15)
    r = evaluate(predict_pairs(model, token_features(split.where("split = 'validation'")))).first()
    assert r.f1 > 0.0 and r.tp > 0  # an all-O tagger has F1 = 0
    assert [round(m.f1, 9) for m in metrics.collect()] == [round(r.f1, 9)]
    save_tagger(model, metrics, str(tmp_path / "m"))
    chunks = spark.createDataFrame([(1, 0, "rewh tion, x²"), (2, 0, None)], "doc_id long, chunk_no int, text string")
    got = tag_text(chunks, load_tagger(str(tmp_path / "m"))).orderBy("pos").collect()
    assert [(r.word, r.start, r.end) for r in got] == [("rewh", 0, 4), ("tion", 5, 9), ("x²", 11, 13)]
    assert all(r.tag in dict(LABELS).values() for r in got) and spark.read.json(str(tmp_path / "m/metrics")).count() == 1


def test_batch_scorer_feeds_the_word_tagger(spark):
    chunks = Q.doc_chunks(spark, SF).select("doc_id", "chunk_no", "text")
    cands = score_tokens(chunks, piece_candidate_scorer(4), CANDIDATE_SCHEMA)
    d, x, n = Q.test_dictionary(spark)
    via_model = tag_words(chunks, d, x, candidates=cands, dict_bytes=n).select("doc_id", "chunk_no", "start", "end", "entity")
    direct = tag_words(chunks, d, x, dict_bytes=n).select("doc_id", "chunk_no", "start", "end", "entity")
    assert sorted(map(tuple, via_model.collect())) == sorted(map(tuple, direct.collect()))


def test_corpus_job_plan_has_one_exchange_before_tagging(spark):
    chunks, labels = run_corpus(spark, fixture_specs(SF), TITLE_KEYWORDS, TEST_DICTIONARY, TEST_EXCLUSIONS)
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan
    # the distinct plans a partial aggregate below its hash exchange, and sorts no text
    assert plan.count("HashAggregate") >= 2
    assert "SortAggregate" not in distinct_corpus(union_sources(spark, fixture_specs(SF), TITLE_KEYWORDS), specs=fixture_specs(SF))._jdf.queryExecution().executedPlan().toString()


def test_cleaning_chain_is_evaluated_once(spark):
    plan = Q.doc_chunks(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the inner-dot rule is part of the chain; it must appear in exactly one operator
    assert sum("(?<!" in line for line in plan.split("\n")) == 1


def test_fit_reads_a_bounded_number_of_partitions(spark, monkeypatch):
    """A partition gives a gradient of the model's size a step, so there are no more of them than cores; nothing is cached."""
    from pyspark.ml.classification import LogisticRegression

    from spanforge.operators.training import train_tagger

    seen = []
    fit = LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, d, *a: seen.append((d.rdd.getNumPartitions(), d.storageLevel.useMemory)) or fit(self, d, *a))
    rows = [(str(i), ["go", "x", f"w{i % 7}"], [1, 2, 0]) for i in range(400)]
    d = spark.createDataFrame(rows, "id string, tokens array<string>, ner_tags array<int>").repartition(64)
    model, metrics = train_tagger(d, d, grid=(0.0,), max_iter=5)
    assert seen and all(n <= spark.sparkContext.defaultParallelism and not kept for n, kept in seen)
    assert len(model.stages) == 2 and metrics.first().f1 == 1.0


def test_batch_scorer_makes_columns_not_rows(monkeypatch):
    """The example scorer fills whole columns: no list of row tuples; pieces, offsets and numbers as counted by hand."""
    import numpy as np
    import pandas as pd

    made = []

    class Frame(pd.DataFrame):
        def __init__(self, data=None, *a, **k):
            made.append(type(data))
            super().__init__(data, *a, **k)

    pdf = pd.DataFrame({"doc_id": [7, 7, 8, 9], "chunk_no": np.array([0, 1, 0, 0], np.int32), "text": ["abcdefghi x", None, "", " a_bé2 q"]})
    monkeypatch.setattr(pd, "DataFrame", Frame)
    got = [tuple(r) for r in piece_candidate_scorer(4)(pdf).itertuples(index=False)]
    assert got == [(7, 0, 0, "abcd", "B-SKILL", 0), (7, 0, 1, "##efgh", "B-SKILL", 4), (7, 0, 2, "##i", "O", 8), (7, 0, 3, "x", "O", 10),
                   (9, 0, 0, "a_bé", "B-SKILL", 1), (9, 0, 1, "##2", "O", 5), (9, 0, 2, "q", "O", 7)]
    assert dict in made and list not in made


def test_words_get_the_classes_of_the_fitted_model(spark, tmp_path):
    """A saved tagger's tags, taken a batch at a time from its weights, are those of its stages a row a word; the plan
    holds no row of features.  A model with other stages still goes through them."""
    from pyspark.ml import PipelineModel

    from spanforge.operators import training as T

    rows = [(str(i), ["go", "x", f"w{i % 7}", "ΑΣ", "y"], [1, 2, i % 3, 0, 5]) for i in range(90)]
    d = spark.createDataFrame(rows, "id string, tokens array<string>, ner_tags array<int>")
    model, metrics = train_tagger(d, d, grid=(0.0,), max_iter=5)
    save_tagger(model, metrics, str(tmp_path / "m"))
    model = load_tagger(str(tmp_path / "m"))
    texts = ["Go x, w1 ΑΣ y", None, "", "w3 w4 x² go go x", "y" * 50 + " new İ_1", "go x w2 " * 200]
    chunks = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "doc_id long, chunk_no int, text string")
    fast = tag_text(chunks, model)
    slow = T._tag_rows(chunks, model, ("doc_id", "chunk_no"), None)
    assert fast.columns == slow.columns and [x.dataType for x in fast.schema] == [x.dataType for x in slow.schema]
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect())) and fast.select("tag").distinct().count() > 2
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "lambdafunction" not in plan
    few = [(0, "O"), (1, "B-x")]
    assert {r.tag for r in tag_text(chunks, model, label_pairs=few).collect()} == {"O", "B-x", "UNK"}
    model.stages[1].setThresholds([1.0] * 5 + [1e-6])
    other = PipelineModel([model.stages[0], model.stages[1]])
    assert {r.tag for r in tag_text(chunks.where("doc_id = 0"), other).collect()} == {dict(LABELS)[5]}
