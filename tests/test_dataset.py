import math
import random
import re

from pyspark.sql import functions as F

from spanforge.operators.dataset import bio_rejects, train_val_split, word_level
from spanforge.operators.evaluation import decode_spans, evaluate, evaluate_rows, evaluate_scores, row_spans, tag_names
from spanforge.operators.export import export_records, flatten_export, record_entities
from spanforge.operators.indexing import dense_index
from spanforge.operators.scoring import CANDIDATE_SCHEMA, align_pieces, merge_pieces, piece_candidate_scorer, score_tokens
from spanforge.operators.tagging import merge_candidates
from spanforge.plans import queries as Q
from spanforge.sources.dictionary import LABELS
from spanforge.sources.records import (read_label_export, read_word_level, record_parts, scratch_path, write_in_parts,
                                       write_records, write_split)

ENT = "array<struct<start:int,end:int,label:string>>"


def _records(spark, rows):
    return spark.createDataFrame(rows, f"id string, text string, entities {ENT}")


def test_bio_hand_cases(spark):
    recs = _records(spark, [
        ("a", "use my sql db", [(4, 10, "DATABASE")]),
        ("b", "use my sql db", [(4, 10, "DATABASE"), (7, 10, "PROGRAMMINGLANG")]),
        ("c", "use my sql db", [(5, 10, "DATABASE")]),
    ])
    got = {r.id: r.ner_tags for r in word_level(recs).collect()}
    assert got == {"a": [0, 5, 6, 0], "b": [0, 5, 1, 0], "c": [0, 0, 5, 0]}


def test_bio_rejects(spark):
    recs = _records(spark, [("a", "x", []), ("b", "x y", [(0, 1, "NOPE")]), ("c", "x", [(0, 1, "DATABASE")])])
    assert sorted((r.id, r.reason) for r in bio_rejects(recs).collect()) == [
        ("a", "no annotations"), ("b", "unknown label")]
    assert [r.id for r in word_level(recs).collect()] == ["c"]


def test_split_sizes_any_partitioning(spark):
    df = spark.createDataFrame([(str(i),) for i in range(11)], "id string")
    a = {r.id: r.split for r in train_val_split(df.repartition(3)).collect()}
    b = {r.id: r.split for r in train_val_split(df.coalesce(1)).collect()}
    assert a == b and sum(v == "train" for v in a.values()) == 8


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    rows = dense_index(df, ["k"], "i", partitions=4).collect()
    assert sorted((r.i, r.k) for r in rows) == [(i, i) for i in range(1000)]


def test_parts_of_120_records(spark, tmp_path):
    recs = spark.range(120).select(F.col("id").alias("rec"), F.col("id").cast("string").alias("id"), F.lit(1).alias("doc_id"))
    parts = {r.part_no: r.n for r in record_parts(recs, 50).groupBy("part_no").agg(F.count("*").alias("n")).collect()}
    assert parts == {1: 50, 2: 50, 3: 20}
    out = str(tmp_path / "parts")
    write_in_parts(recs, out, 50)
    back = spark.read.json(out)
    assert sorted(r.part_no for r in back.select("part_no").distinct().collect()) == [1, 2, 3]
    assert sorted(back.columns) == ["id", "part_no"]


def test_export_roundtrip_and_order(spark):
    chunks = spark.createDataFrame([(7, 0, "rewh rewh"), (3, 1, "x"), (3, 0, "tion")],
                                   "doc_id long, chunk_no int, text string")
    labels = spark.createDataFrame(
        [(7, 0, 5, 9, "I-P", "rewh", 0, 1, "rewh rewh", 0, 1), (7, 0, 0, 4, "B-P", "rewh", 1, 1, "rewh", 0, 0),
         (7, 0, 0, 4, "B-P", "rewh", 0, 1, "rewh rewh", 0, 0), (3, 0, 0, 4, "B-D", "tion", 1, 2, "tion", 0, 0)],
        "doc_id long, chunk_no int, start int, end int, entity string, text string, origin int, priority int,"
        " term string, match_no int, word_no int")
    recs = export_records(labels.join(chunks.withColumnRenamed("text", "chunk_text"), ["doc_id", "chunk_no"]))
    path = scratch_path(spark, "rt")
    write_records(recs.select("id", "data", "annotations"), path)
    flat = sorted(tuple(r) for r in flatten_export(read_label_export(spark, path)).drop("text").collect())
    assert flat == [("0", 0, "result-0-0", 0, 4, "tion", "B-D"), ("1", 0, "result-1-0", 0, 4, "rewh", "B-P"),
                    ("1", 1, "result-1-1", 0, 4, "rewh", "B-P"), ("1", 2, "result-1-2", 5, 9, "rewh", "I-P")]
    # phrase label (origin 0) precedes the word label at the same start
    ents = record_entities(recs).where("id = '1'").first().entities
    assert [e.start for e in ents] == [0, 0, 5]


def test_alignment_hand_case(spark):
    df = spark.createDataFrame([(["ab", "c"], [1, 0])], "tokens array<string>, tags array<int>")
    r = df.select(align_pieces(F.col("tokens"), F.col("tags"), n=6, head=1).alias("a")).first().a
    assert [(p.piece, p.word_id, p.label) for p in r] == [
        ("[CLS]", None, -100), ("a", 0, 1), ("##b", 0, 1), ("c", 1, 0), ("[SEP]", None, -100), ("[PAD]", None, -100)]


def test_merge_pieces_hand_cases(spark):
    df = spark.createDataFrame([([("a", "1"), ("##b", "2"), ("c", "3"), ("##d", "0")],),
                                ([("##x", "1"), ("y", "2"), ("[SEP]", "O")],)],
                               "p array<struct<piece:string,label:string>>")
    got = [[(w.word, w.label) for w in r.m] for r in df.select(merge_pieces(F.col("p")).alias("m")).collect()]
    assert got == [[("ab", "1"), ("cd", "3")], [("x", None), ("y", "2")]]


def test_lenient_span_decode(spark):
    tags = ["B-A", "I-A", "I-B", "O", "I-A", "B-A", "B-A", "O"]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(tags)], "id string, pos int, tag string")
    got = sorted((r.type, r.start, r.end) for r in decode_spans(df).collect())
    assert got == [("A", 0, 1), ("A", 4, 4), ("A", 5, 5), ("A", 6, 6), ("B", 2, 2)]


def test_scores_without_predictions_and_hand_case(spark):
    schema = "id string, pos int, gold int, pred int"
    none = spark.createDataFrame([("s", 0, 1, 0), ("s", 1, 2, 0), ("s", 2, -100, 0)], schema)
    r = evaluate(none).first()
    assert (r.precision, r.recall, r.f1, r.n_gold, r.tp) == (0.0, 0.0, 0.0, 1, 0)
    assert abs(r.accuracy - 0.0) < 1e-12
    # gold: B-P I-P O B-D ; pred: B-P O O B-D -> gold spans {P 0-1, D 3-3}, pred {P 0-0, D 3-3}
    df = spark.createDataFrame([("s", 0, 1, 1), ("s", 1, 2, 0), ("s", 2, 0, 0), ("s", 3, 5, 5)], schema)
    r = evaluate(df).first()
    assert (r.tp, r.n_pred, r.n_gold) == (1, 2, 2) and abs(r.f1 - 0.5) < 1e-12 and abs(r.accuracy - 0.75) < 1e-12


def test_bio_of_large_records(spark):
    """Properties that the tags of any record have, and one case worked out by hand at length."""
    rnd = random.Random(5)
    names = dict(LABELS)
    rows = []
    for r in range(12):
        words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 400))]
        text = " ".join(words)
        ents = [(s := rnd.randint(0, len(text)), min(len(text), s + rnd.randint(0, 12)), rnd.choice(["DATABASE", "TECHNOLOGY"])) for _ in range(rnd.randint(1, 150))]
        rows.append((str(r), text, ents))
    rows.append(("hand", " ".join(["w"] * 5000), [(0, 9999, "DATABASE"), (2, 5, "TECHNOLOGY")]))
    got = {r.id: r for r in word_level(spark.createDataFrame(rows, f"id string, text string, entities {ENT}")).collect()}
    assert got["hand"].ner_tags == [5, 3, 4] + [6] * 4997
    for rid, text, ents in rows:
        at, spans = 0, []
        for w in got[rid].tokens:
            spans.append((at, at + len(w)))
            at += len(w) + 1
        assert " ".join(got[rid].tokens) == text
        for tag, (a, b) in zip(got[rid].ner_tags, spans):
            over = [e for e in ents if a >= e[0] and b <= e[1]]
            if not over:
                assert tag == 0
            else:  # the last entity over a token wins; B only on the first token that lies in it
                s, _e, label = over[-1]
                first = min(x for x, y in spans if x >= s and y <= over[-1][1])
                assert names[tag] == ("B-" if first == a else "I-") + label


def test_merge_pieces_of_long_records(spark):
    rnd = random.Random(4)
    recs = [([(rnd.choice(["a", "##b", "##c", "d", "[SEP]"]), rnd.choice(["O", "B-X", None])) for _ in range(rnd.randint(0, 900))],) for _ in range(10)]
    df = spark.createDataFrame(recs, "p array<struct<piece:string,label:string>>")
    for (pieces,), r in zip(recs, df.select(merge_pieces(F.col("p")).alias("m")).collect()):
        # a word per piece without ##, and one for a leading run; special tokens alone go
        glued = "".join(" " * (not p.startswith("##")) + p.removeprefix("##") for p, _l in pieces)
        assert [w.word for w in r.m] == [w for w in glued.split(" ") if w and w != "[SEP]"]
        heads = [lab for i, (p, lab) in enumerate(pieces) if not p.startswith("##")
                 and not (p == "[SEP]" and (i + 1 == len(pieces) or not pieces[i + 1][0].startswith("##")))]
        lead = [None] if pieces and pieces[0][0].startswith("##") else []
        assert [w.label for w in r.m] == lead + heads


def test_long_word_and_foreign_rows_survive_pieces(spark):
    word = "".join(chr(97 + i % 26) for i in range(5000))
    chunks = spark.createDataFrame([(1, 0, f"{word} tail"), (2, 0, "ünï नमस्ते x²"), (3, 0, None)], "doc_id long, chunk_no int, text string")
    native = Q.candidate_pieces(chunks)
    scored = score_tokens(chunks, piece_candidate_scorer(4), CANDIDATE_SCHEMA)
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, scored.collect()))
    got = sorted((r.doc_id, r.word, r.start, r.end) for r in merge_candidates(native).collect())
    assert got[:2] == sorted([(1, word, 0, 5000), (1, "tail", 5001, 5005)])
    assert [w for _d, w, _s, _e in got if _d == 2] == sorted(re.findall(r"\w+", "ünï नमस्ते x²"))


def test_piece_scores_with_mask(spark):
    # gold: B-P I-P on two pieces, a masked special before and a pad after; classes 0..8
    def at(c):
        return [1.0 if i == c else 0.0 for i in range(9)]
    rows = spark.createDataFrame([([-100, 1, 2, 0, -100], [at(5), at(1), at(2), at(0), at(7)]),
                                  ([-100, 5, 0, -100, -100], [at(0), at(0), at(3), at(1), at(1)])], "labels array<int>, scores array<array<double>>")
    r = evaluate_scores(rows).first()
    assert (r.tp, r.n_pred, r.n_gold, r.n_tokens) == (1, 2, 2, 5) and abs(r.accuracy - 0.6) < 1e-12 and abs(r.f1 - 0.5) < 1e-12


def test_row_spans_equal_long_spans(spark):
    rnd = random.Random(8)
    seqs = [[rnd.randint(0, 8) for _ in range(rnd.randint(0, 30))] for _ in range(200)]
    rows = spark.createDataFrame([(str(i), s) for i, s in enumerate(seqs)], "id string, ids array<int>")
    in_row = sorted((r.id, x.type, x.start, x.end) for r in rows.select("id", row_spans(F.col("ids")).alias("s")).collect() for x in r.s)
    long = tag_names(rows.select("id", F.posexplode("ids").alias("pos", "t")), "t", "tag")
    assert in_row == sorted((r.id, r.type, r.start, r.end) for r in decode_spans(long).collect())


def test_evaluation_plan_is_one_aggregate(spark):
    rows = spark.createDataFrame([([1, 2], [1, 0])], "gold array<int>, pred array<int>")
    plan = evaluate_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SortMergeJoin" not in plan and plan.count("Exchange SinglePartition") == 1


def test_split_files_round_trip(spark, tmp_path):
    wl = spark.createDataFrame([(str(i), ["a", "b"], [0, 1]) for i in range(10)], "id string, tokens array<string>, ner_tags array<int>")
    write_split(train_val_split(wl, "id"), str(tmp_path / "s"))
    parts = [sorted(r.id for r in read_word_level(spark, str(tmp_path / "s"), split=x).collect()) for x in ("train", "validation")]
    assert [len(p) for p in parts] == [8, 2] and sorted(sum(parts, [])) == [str(i) for i in range(10)]


def test_scores_and_loss_come_from_one_pass(spark):
    rows = spark.createDataFrame([([1, -100, 0], [[0.0, 2.0], [9.0, 9.0], [1.0, 1.0]]), ([-100], [[5.0, 5.0]]), (None, None)], "labels array<int>, scores array<array<double>>")
    out = evaluate_scores(rows, loss=True)
    r, p = out.first(), evaluate_scores(rows).first()
    assert out.columns[-1] == "loss" and tuple(r)[:-1] == tuple(p)
    assert abs(r.loss - (math.log(1 + math.exp(2)) - 2 + math.log(2)) / 2) < 1e-12
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("Exchange SinglePartition") == 1


def test_merge_joins_each_word_from_its_slice(spark):
    """No fold carries an open word; null pieces, empty words and records of ``##`` pieces only merge as by the fold."""
    def fold(pieces):
        words, cur, lab = [], "", None
        for p, label in pieces:
            if p is not None and p.startswith("##"):
                cur = None if cur is None else cur + p[2:]
                continue
            words, cur, lab = words + [(cur, lab)], p, label
        return [(w, x) for w, x in words + [(cur, lab)] if w and w not in ("[PAD]", "[CLS]", "[SEP]")]

    rnd = random.Random(6)
    recs = [[(rnd.choice(["a", "##b", "", "##", "[CLS]", "##[SEP]", "[PAD]", None, "é##"]), rnd.choice(["x", None, "y"])) for _ in range(k)] for k in (0, 1, 2, 3, 5, 9, 300) * 30]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(recs)] + [(len(recs), None)], "i int, p array<struct<piece:string,label:string>>")
    out = df.select("i", merge_pieces(F.col("p")).alias("m"))
    for r in out.collect():
        assert (r.m is None) if r.i == len(recs) else [tuple(w) for w in r.m] == fold(recs[r.i])
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
