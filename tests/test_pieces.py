"""Longest-match pieces: vocabulary formats, a recursive reference, columns."""

import json
import random
import string

import pytest
from pyspark.sql import functions as F

from spanforge.functions.pieces import END, START, UNIT, Vocabulary, byte_letters, read_vocabulary, subword_lengths, subwords
from spanforge.operators.chunking import chunk_corpus
from spanforge.operators.scoring import align_pieces, merge_pieces
from spanforge.plans.fixtures import VOCABULARY_PATH


def longest(s, pieces):
    if not s:
        return []
    n = max((k for k in range(1, len(s) + 1) if s[:k] in pieces), default=1)
    return [s[:n], *longest(s[n:], pieces)]


def test_cut_equals_the_recursive_longest_match():
    r = random.Random(1)
    for before, after in (("", ""), (START, ""), ("", END)):
        pieces = {"".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(40)}
        pieces |= {before + p + after for p in list(pieces)[::2]} | {before, after}
        v = Vocabulary(pieces, before, after)
        for _ in range(300):
            word = "".join(r.choice("abcd") for _ in range(r.randint(0, 12)))
            want = [p for x in longest(before + word + after, v.pieces) if (p := x.strip(START + END))]
            assert v.cut(word) == [("##" if i else "") + p for i, p in enumerate(want)]
            assert "".join(p.removeprefix("##") for p in v.cut(word)) == word


def test_formats_of_vocabularies(tmp_path):
    (tmp_path / "a.txt").write_text("play\n##ing\n##s\nin\n[UNK]\n")
    assert read_vocabulary(f"{tmp_path}/a.txt").cut("playings") == ["play", "##ing", "##s"]
    letters = {b: c for c, b in byte_letters().items()}
    spell = lambda t: "".join(letters[b] for b in t.encode())
    vocab = [spell(c) for c in string.ascii_lowercase] + [spell("é") + "</w>", "caf", "car</w>", spell("é")[0]]
    (tmp_path / "b.json").write_text(json.dumps({"model": {"vocab": {p: i for i, p in enumerate(vocab)}, "end_of_word_suffix": "</w>"}}))
    v = read_vocabulary(f"{tmp_path}/b.json")
    assert v.cut("café") == ["caf", "##é"] and v.cut("car") == ["car"] and v.cut("cars") == ["c", "##a", "##r", "##s"]
    (tmp_path / "c.json").write_text(json.dumps({"model": {"vocab": {spell(" play"): 0, spell("ing"): 1, spell("play"): 2}}}))
    assert read_vocabulary(f"{tmp_path}/c.json").cut("playing") == ["play", "##ing"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"])
def test_public_vocabularies(name):
    v = read_vocabulary(VOCABULARY_PATH.replace("word_bpe_49k.json", name))
    assert len(v.pieces) > 25_000
    for word in ("the", "understanding", "kubernetes", "naïve", "東京", "c3po", ""):
        got = v.cut(word)
        assert "".join(p.removeprefix("##") for p in got) == word and not any(p.startswith("##") for p in got[:1])
    assert len(v.cut("the")) == 1 and len(v.cut("understanding")) <= 2


def test_columns(spark):
    v = Vocabulary({"spa", "rk", "s", "p", "ark", "it"})
    d = spark.createDataFrame([(0, ["spark", "it", "", "x1"], [1, 2, 3, 4]), (1, [], []), (2, ["it"] * 200, [5] * 200)], "id int, tokens array<string>, tags array<int>")
    got = {r.id: r.p for r in d.select("id", align_pieces(F.col("tokens"), F.col("tags"), 8, cut=subwords(spark, v)).alias("p")).collect()}
    assert [p.piece for p in got[0]] == ["[CLS]", "spa", "##rk", "it", "x", "##1", "[SEP]", "[PAD]"]
    assert [p.label for p in got[0]] == [-100, 1, 1, 2, 4, 4, -100, -100] and [p.word_id for p in got[0]][1:6] == [0, 0, 1, 3, 3]
    assert [p.piece for p in got[1]] == ["[CLS]", "[SEP]"] + ["[PAD]"] * 6 and [p.piece for p in got[2]] == ["[CLS]"] + ["it"] * 6 + ["[SEP]"]
    # merging the pieces of a word gives it back
    pieces = F.transform(F.flatten(subwords(spark, v)(F.col("tokens"))), lambda p: F.struct(p.alias("piece"), F.lit("O").alias("label")))
    back = {r.id: [w.word for w in r.w] for r in d.select("id", merge_pieces(pieces).alias("w")).collect()}
    assert back[0] == ["spark", "it", "x1"] and back[2] == ["it"] * 200
    nothing = spark.createDataFrame([(None,)], "tokens array<string>").select(subwords(spark, v)(F.col("tokens")).alias("p")).first()
    assert nothing.p is None


def test_packing_by_pieces(spark):
    v = Vocabulary({"aa", "bb"})
    text = "aabb aa. b b b. aaaa bb, x. c"
    d = spark.createDataFrame([(1, text), (2, "one")], "doc_id int, text string")
    sizes = [sum(len(v.cut(u)) for u in UNIT.findall(s)) for s in text.replace(". ", ".\n").split("\n")]
    assert sizes == [4, 4, 6, 1]
    got = chunk_corpus(d, 8, measure=subword_lengths(spark, v)).orderBy("doc_id", "chunk_no").collect()
    assert [(r.doc_id, r.text) for r in got] == [(1, "aabb aa. b b b."), (1, "aaaa bb, x. c"), (2, "one")]
