"""Phrases and keywords by automaton against the regex forms and plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from spanforge.functions.terms import FOLD, squeezed, term_parts
from spanforge.functions.terms import find_phrases
from spanforge.operators.corpus import keyword_filter, keyword_filter_many
from spanforge.operators.tagging import tag_many_phrases, tag_phrases

WORDS = ["a", "b", "ab", "ba", "c++", "node.js", "x1", "_y", "é", "Ünder", "the", "İ", "K", "naïve", "c", ".net", "b-a"]


def texts(n, seed):
    r = random.Random(seed)
    gap = lambda: r.choice([" ", " ", " ", "  ", "\t", "\n ", ", ", "-", ". ", "", " ", "  "])
    case = lambda w: r.choice([w, w.upper(), w.title()])
    return ["".join(case(r.choice(WORDS)) + gap() for _ in range(r.randint(0, 25))) for _ in range(n)] + ["", None]


def test_equal_to_the_regex_tagger(spark):
    r = random.Random(3)
    rows = [(i, i % 3, t) for i, t in enumerate(texts(300, 1)) if t is not None]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no int, text string")
    terms = sorted({" ".join(r.choice(WORDS).lower() for _ in range(r.randint(2, 3))) for _ in range(150)}) + ["a  b", "single"]
    d = spark.createDataFrame([(t, f"L{i % 3}", i % 5) for i, t in enumerate(terms)], "term string, label string, priority int")
    want, got = tag_phrases(chunks, d), tag_many_phrases(chunks, d).select(*tag_phrases(chunks, d).columns)
    assert want.schema.names == got.schema.names and want.count() > 200
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_overlaps_and_null(spark):
    chunks = spark.createDataFrame([(1, 0, "a a a a  a"), (2, 0, None), (3, 0, "b a b a b")], "doc_id long, chunk_no int, text string")
    d = spark.createDataFrame([("a a", "X", 0), ("a b a", "Y", 0), ("b a", "Z", 0)], "term string, label string, priority int")
    got = tag_many_phrases(chunks, d).collect()
    assert sorted((r.doc_id, r.term, r.match_no, r.word_no, r.start, r.end) for r in got) == sorted([
        (1, "a a", 0, 0, 0, 1), (1, "a a", 0, 1, 2, 3), (1, "a a", 1, 0, 4, 5), (1, "a a", 1, 1, 6, 7),
        (3, "a b a", 0, 0, 2, 3), (3, "a b a", 0, 1, 4, 5), (3, "a b a", 0, 2, 6, 7),
        (3, "b a", 0, 0, 0, 1), (3, "b a", 0, 1, 2, 3), (3, "b a", 1, 0, 4, 5), (3, "b a", 1, 1, 6, 7)])
    assert tag_many_phrases(chunks, d.where("term = ''")).count() == 0


def test_a_hundred_thousand_phrases_in_one_pass(spark):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(2000)]
    rows = [(i, 0, " ".join(r.choice(vocab) for _ in range(60))) for i in range(300)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no int, text string")
    terms = {(r.choice(vocab), r.choice(vocab)) for _ in range(101_000)}
    d = spark.createDataFrame([(f"{a} {b}", "S", 0) for a, b in terms], "term string, label string, priority int")
    out = tag_many_phrases(chunks, d)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1
    want = sum((a, b) in terms for _i, _n, t in rows for a, b in zip(t.split(), t.split()[1:]) if a != b)
    assert len(terms) > 95_000 and out.where("word_no = 0 AND split(term, ' ')[0] <> split(term, ' ')[1]").count() == want > 100


def test_keywords_equal_the_alternation(spark):
    r = random.Random(7)
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts(400, 8))], "id long, title string")
    kws = ["node.js", "É", "+ ", "b-A", "\n", "x1A", "the  the", "ünder"]
    want, got = keyword_filter(d, "title", kws), keyword_filter_many(d, "title", kws)
    assert 0 < want.count() < 400 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert keyword_filter_many(d, "title", []).count() == keyword_filter(d, "title", []).count() == 401
    assert keyword_filter_many(d, "title", [""]).count() == 401 and keyword_filter_many(d, "title", ["no such"]).count() == 0
    many = [f"zz{i}" for i in range(10_000)] + ["x1"]
    assert {x.id for x in keyword_filter_many(d, "title", many).collect()} == {x.id for x in keyword_filter(d, "title", ["x1"]).collect()}
    assert r


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_parts_hold_all_terms(spark, limit):
    terms = ["ab", "c", "", "défg", "ab", "hij"]
    parts = term_parts(spark, terms, limit)
    assert [t for _f, _k, p in parts for t in p.value] == terms and [f for f, _k, _p in parts] == [sum(len(p.value) for _f, _k, p in parts[:i]) for i in range(len(parts))]
    chunks = spark.createDataFrame([("x y  z",)], "text string")
    got = chunks.select(F.explode(find_phrases(chunks, "text", [("x y", "P", 0), ("y z", "Q", 1)], limit)).alias("m")).select("m.label", "m.start", "m.end").collect()
    assert sorted(map(tuple, got)) == [("P", 0, 1), ("P", 2, 3), ("Q", 2, 3), ("Q", 5, 6)]


def test_offsets_survive_squeezing():
    for t in texts(200, 11)[:-1]:
        flat, place = squeezed(t)
        place = place or list(range(len(t)))
        assert len(place) == len(flat) and all(t[p] == c or c == " " for p, c in zip(place, flat)) and len(t.translate(FOLD)) == len(t)
