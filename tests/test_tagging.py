import time

from pyspark.sql import functions as F

from spanforge.operators.tagging import merge_candidates, refine_labels, tag_chunks, entity_counts
from spanforge.plans.fixtures import TEST_DICTIONARY, TEST_EXCLUSIONS
from spanforge.sources.dictionary import dictionary, term_list


def _labels(spark, texts, reviewed=False):
    chunks = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, chunk_no int, text string")
    d, n = dictionary(spark, TEST_DICTIONARY)
    x, _ = term_list(spark, TEST_EXCLUSIONS)
    df = tag_chunks(chunks, d, x, n, reviewed=reviewed)
    return sorted((r.chunk_no, r.start, r.end, r.entity, r.origin) for r in df.collect())


def test_phrase_self_overlap_and_words(spark):
    got = _labels(spark, ["rewh rewh rewh"])
    assert got == [(0, 0, 4, "B-PROGRAMMINGLANG", 0), (0, 0, 4, "B-PROGRAMMINGLANG", 1),
                   (0, 5, 9, "B-PROGRAMMINGLANG", 1), (0, 5, 9, "I-PROGRAMMINGLANG", 0),
                   (0, 10, 14, "B-PROGRAMMINGLANG", 1)]


def test_overlapping_phrases_priority_and_exclusion(spark):
    got = _labels(spark, ["anea eriner thanea", "tion ther"])
    phrases = [g for g in got if g[0] == 0]
    assert phrases == [(0, 0, 4, "B-DATABASE", 0), (0, 5, 11, "B-PROGRAMMINGLANG", 0),
                       (0, 5, 11, "I-DATABASE", 0), (0, 12, 18, "I-PROGRAMMINGLANG", 0)]
    assert [g for g in got if g[0] == 1] == [(1, 0, 4, "B-DATABASE", 1)]


def test_reviewed_spans_are_whole_phrases(spark):
    got = _labels(spark, ["anea eriner x hehely"], reviewed=True)
    assert got == [(0, 0, 11, "DATABASE", 0), (0, 14, 20, "TECHNOLOGY", 1)]


def test_case_insensitive_phrase_and_keyless_term(spark):
    chunks = spark.createDataFrame([(1, 0, "Rewh  REWH x ++ --")], "doc_id long, chunk_no int, text string")
    d, n = dictionary(spark, {"tools": ["rewh rewh", "++ --"]})
    got = sorted((r.start, r.end, r.entity) for r in refine_labels(chunks, d, None, dict_bytes=n).collect())
    assert (0, 4, "B-TOOLS") in got and (6, 10, "I-TOOLS") in got


def test_large_dictionary_is_quick_and_joined_without_text(spark):
    t0 = time.time()
    d, n = dictionary(spark, {"tools": [f"term{i}" for i in range(100_000)] + ["tion"], "databases": ["rewh rewh"]})
    assert d.count() == 100_002 and time.time() - t0 < 15
    chunks = spark.createDataFrame([(i, 0, "rewh rewh tion term77 x") for i in range(40)], "doc_id long, chunk_no int, text string")
    small, large = tag_chunks(chunks, d, None, n), tag_chunks(chunks, d, None, None)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) and small.count() == 40 * 4


def test_empty_words_are_dropped_by_the_merge(spark):
    c = spark.createDataFrame([(1, 0, 0, "", "1", 0), (1, 0, 1, "a", "2", 1)], "doc_id long, chunk_no int, seq int, word string, entity string, start int")
    assert [r.word for r in merge_candidates(c).collect()] == ["a"]


def test_merge_candidates_hand_case(spark):
    rows = [(1, 0, 0, "a", "1", 0), (1, 0, 1, "##b", "2", 1), (1, 0, 2, "c", "3", 3), (1, 0, 3, "##d", "0", 4),
            (1, 1, 0, "##x", "1", 0), (1, 1, 1, "y", "2", 4), (1, 1, 2, "z", "2", None)]
    c = spark.createDataFrame(rows, "doc_id long, chunk_no int, seq int, word string, entity string, start int")
    got = sorted((r.chunk_no, r.word, r.entity, r.start, r.end) for r in merge_candidates(c).collect())
    assert got == [(0, "ab", "1", 0, 2), (0, "cd", "3", 3, 5), (1, "y", "2", 4, 5)]


def test_tagging_plan_is_shuffle_free(spark):
    chunks = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.lit(0).alias("chunk_no"), "text")
    d, n = dictionary(spark, TEST_DICTIONARY)
    x, _ = term_list(spark, TEST_EXCLUSIONS)
    plan = tag_chunks(chunks, d, x, n)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    counts = {r.entity: r.n for r in entity_counts(tag_chunks(chunks, d, x, n)).collect()}
    assert all(v > 0 for v in counts.values())


def test_lookup_join_is_compiled_and_words_keep_their_case(spark):
    """No array function stands in the join, so it is compiled and copies no text per token."""
    import re

    d, n = dictionary(spark, TEST_DICTIONARY)
    d = d.unionByName(spark.createDataFrame([("big data", "t", 1, "SKILL", 2), ("go", "t", 1, "SKILL", 1)], d.schema))
    chunks = spark.createDataFrame([(1, 0, "Go GO go big Big  DATA xgo go"), (2, 0, "data only"), (3, 0, None), (3, 0, "")], "doc_id long, chunk_no int, text string")
    got = tag_chunks(chunks, d, None, n, reviewed=True).where("term in ('go', 'big data')")
    rows = sorted((r.doc_id, r.start, r.end, r.text, r.match_no) for r in got.collect())
    assert rows == [(1, 0, 2, "Go", 0), (1, 3, 5, "GO", 0), (1, 6, 8, "go", 0), (1, 13, 22, "Big  DATA", 0), (1, 27, 29, "go", 0)]
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "BroadcastHashJoin" in x]
    assert any(re.search(r"\*\(\d+\) BroadcastHashJoin", x) for x in joins) and not any("forall" in x for x in joins)


def test_chunks_without_keys_are_not_cut_into_tokens(spark):
    """A small lookup is searched as one pattern first; labels are those of the join of all tokens."""
    import random

    terms = {"programming_languages": ["c", "c++", "c#", "go", "big data", "σας", "r"], "databases": ["++", ".", "no sql", "node.js", "é", "x_1"], "tools": ["a b", "..", "\x1c", "i̇"]}
    parts = ["c", "C", "++", "+", "#", " ", "  ", "go", "Go", "BIG", "data", "ΣΑΣ", "'", "r", ".", "no", "sql", "é", "É", "X_1", "_", "a", "b", "\n", "\x1c", "İ"]
    d, n = dictionary(spark, terms)
    x, _ = term_list(spark, ["r"])
    rnd = random.Random(2)
    rows = [(i, 0, None if i % 97 == 0 else "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))) for i in range(1500)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no int, text string")
    small, joined = tag_chunks(chunks, d, x, n), tag_chunks(chunks, d, x, None)
    assert sorted(map(str, small.collect())) == sorted(map(str, joined.collect())) and small.count() > 100
    assert "RLIKE" in small._jdf.queryExecution().optimizedPlan().toString() and "RLIKE" not in joined._jdf.queryExecution().optimizedPlan().toString()
    none, m = dictionary(spark, {})
    assert tag_chunks(chunks, none, None, m).count() == 0


def test_only_tokens_that_are_keys_become_rows(spark):
    """A row behind the tokens carries the chunk's text and tokens, so none is made for a token the lookup lacks."""
    import re

    from spanforge.functions.text import key_pattern
    from spanforge.operators.tagging import dictionary_hits, lookup_table

    d, n = dictionary(spark, {"programming_languages": ["go", "big data"], "databases": ["++"]})
    chunks = spark.createDataFrame([(1, 0, "Go on, GO with big big data++"), (2, 0, "ergo big"), (3, 0, "gé é go"), (4, 0, None)], "doc_id long, chunk_no int, text string")
    hits = dictionary_hits(chunks, lookup_table(d, None), n)
    got = sorted((r.doc_id, r.kind, r.term) for r in hits.collect())
    assert got == [(1, "p", "big data"), (1, "w", "++"), (1, "w", "go"), (1, "w", "go"), (3, "w", "go")]
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Generate explode\(filter\(", plan) and not re.search(r"Generate explode\(lows", plan)
    # the words are tried behind a sign or space, never at each letter
    pattern = key_pattern(["go", "++"])
    assert pattern.startswith(r"\W") and not any(re.search(pattern, " " + t) for t in ("", "ergo", "gone", "+ +", "go_"))
    assert all(re.search(pattern, " " + t) for t in ("go", "a go", "a.go.", "x++y", "go go"))
    assert not re.search(key_pattern([]), " go")
