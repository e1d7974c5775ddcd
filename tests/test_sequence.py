"""The sequence tagger: paths and sums against enumeration, training, early stopping, saving."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.operators import sequence
from spanforge.operators.evaluation import score_loss
from spanforge.operators.sequence import (SequenceModel, bio_rules, forward_backward, load_sequence_tagger, predict_sequence,
                                          save_sequence_tagger, sequence_rows, tag_sequences, train_sequence_tagger, viterbi, viterbi_path)
from spanforge.sources.dictionary import LABELS

NAMES = [t for _i, t in LABELS]


def path_score(p, s, start, move):
    return start[p[0]] + sum(s[i][t] for i, t in enumerate(p)) + sum(move[a][b] for a, b in zip(p, p[1:]))


def test_paths_and_sums_equal_enumeration():
    r = np.random.default_rng(0)
    for n, k in ((1, 3), (2, 4), (4, 3), (5, 2)):
        s, start, move = r.normal(size=(n, k)), r.normal(size=k), r.normal(size=(k, k))
        paths = list(itertools.product(range(k), repeat=n))
        score = np.array([path_score(p, s, start, move) for p in paths])
        assert tuple(viterbi(s, start, move)) == paths[int(score.argmax())]
        padded = np.zeros((2, n + 2, k))
        padded[0, :n], padded[1] = s, r.normal(size=(n + 2, k))
        whole, tags, _moves = forward_backward(padded, np.array([n, n + 2]), start, move)
        assert np.isclose(whole[0], np.log(np.exp(score).sum()))
        p = np.exp(score - whole[0])
        want = np.zeros((n, k))
        for path, x in zip(paths, p):
            want[np.arange(n), path] += x
        assert np.allclose(tags[0, :n], want) and not tags[0, n:].any()
        _w, _t, moves = forward_backward(s[None], np.array([n]), start, move)
        both = np.zeros((k, k))
        for path, x in zip(paths, p):
            for a, b in zip(path, path[1:]):
                both[a, b] += x
        assert np.allclose(moves, both)


def test_rules_hold_on_every_path(spark):
    start, move = bio_rules(NAMES)
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=(n, 9)).tolist()) for i, n in enumerate([0, 1, 2, 30, 200])] + [(9, None)]
    d = spark.createDataFrame(rows, "id int, s array<array<double>>")
    got = {x.id: x.p for x in d.select("id", viterbi_path(F.col("s"), start, move).alias("p")).collect()}
    assert got[0] == [] and got[9] is None
    for i, s in rows[1:5]:
        assert len(got[i]) == len(s)
        for a, b in zip([0, *got[i]], got[i]):
            assert not NAMES[b].startswith("I-") or NAMES[a][1:] in (NAMES[b][1:],) and NAMES[a] != "O"


def records(spark, n, seed):
    """Words whose tag depends on the word before: only a sequence of tags tells ``x`` after ``go``."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        tokens, tags = [], []
        while len(tokens) < 12:
            k = r.integers(0, 4)
            if k == 0:
                tokens += ["go", "x", "x"]
                tags += [1, 2, 2]
            elif k == 1:
                tokens += ["my", "x"]
                tags += [5, 6]
            else:
                tokens += [f"w{r.integers(0, 20)}"]
                tags += [0]
        rows.append((f"{seed}-{i}", tokens, tags))
    return spark.createDataFrame(rows, "id string, tokens array<string>, ner_tags array<int>")


def test_training_stops_early_and_keeps_the_best_epoch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sequence, "SHARD_RECORDS", 60)  # several shards
    train, valid = records(spark, 160, 1), records(spark, 40, 2)
    model, metrics = train_sequence_tagger(train, valid, epochs=10, patience=2)
    got = metrics.orderBy("epoch").collect()
    best = max(got, key=lambda r: (r.f1, -r.epoch))
    assert len(got) < 10 and best.f1 > 0.99 and got[-1].epoch == best.epoch + 2
    assert got[-1].loss < got[0].loss and all(r.n_tokens == got[0].n_tokens for r in got)
    pred = predict_sequence(sequence_rows(valid), model)
    rows = pred.collect()
    assert all(0 < r.confidence <= 1 for r in rows) and sum(r.gold == r.pred for r in rows) > 0.99 * len(rows)
    save_sequence_tagger(model, str(tmp_path), spark, metrics)
    again = load_sequence_tagger(spark, str(tmp_path))
    assert predict_sequence(sequence_rows(valid), again).select("id", "pos", "pred").exceptAll(pred.select("id", "pos", "pred")).isEmpty()
    assert spark.read.json(f"{tmp_path}/metrics").count() == len(got)
    chunks = spark.createDataFrame([(1, 0, "Go x x, w3 my x"), (2, 0, ""), (3, 0, None)], "doc_id long, chunk_no int, text string")
    words = tag_sequences(chunks, again).orderBy("doc_id", "pos").collect()
    assert [(w.word, w.start, w.end) for w in words] == [("Go", 0, 2), ("x", 3, 4), ("x", 5, 6), ("w3", 8, 10), ("my", 11, 13), ("x", 14, 15)]
    assert [NAMES.index(w.tag) for w in words] == [1, 2, 2, 0, 5, 6]


def test_empty_training_and_unknown_words(spark):
    none = records(spark, 1, 5).limit(0)
    model, metrics = train_sequence_tagger(none, none)
    assert metrics.count() == 0
    rows = predict_sequence(sequence_rows(records(spark, 2, 6)), model).collect()
    assert {r.pred for r in rows} == {0}
    assert SequenceModel(NAMES).tag([]) [:2] == ([], [])


@pytest.mark.parametrize("shift", [0.0, 5000.0])
def test_loss_is_stable(spark, shift):
    r = np.random.default_rng(2)
    s, g = r.normal(size=(6, 4)), [0, -100, 3, 1, 2, -100]
    d = spark.createDataFrame([((s + shift).tolist(), g), ([[1.0] * 4], [-100])], "scores array<array<double>>, labels array<int>")
    want = np.mean([np.log(np.exp(s[i]).sum()) - s[i][t] for i, t in enumerate(g) if t >= 0])
    assert abs(score_loss(d).first().loss - want) < 1e-6
    assert score_loss(d.limit(0)).first().loss is None


def test_batches_tag_like_single_records(spark, monkeypatch):
    """Records of any length, empty and null ones too, tagged together: paths, probabilities and losses of each alone,
    and as many passes as there are batches, not records."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    ids = np.arange(0, 200, 3)
    model = SequenceModel(NAMES, 1000, ids, r.normal(size=(len(ids), 9)), r.normal(size=9), r.normal(size=(9, 9)))
    feats = [[r.integers(0, 200, r.integers(0, 5)).tolist() for _ in range(n)] for n in r.integers(0, 40, 60)] + [None, []]
    start, move = model.start + model.rules[0], model.move + model.rules[1]
    calls = []
    monkeypatch.setattr(sequence, "forward_backward", lambda *a, **k: calls.append(1) or forward_backward(*a, **k))
    got = model.tag_batch(pa.array(feats, pa.list_(pa.list_(pa.int64()))).slice(2))
    assert len(calls) == 1
    monkeypatch.setattr(sequence, "TOGETHER", 100)
    assert len(got) == 60 and len(model.tag_batch(pa.array(feats, pa.list_(pa.list_(pa.int64()))))) == 62
    for f, x in zip(feats[2:], got):
        if not f:
            assert x is None
            continue
        s = model.scores(f)
        path = viterbi(s, start, move)
        whole, p, _m = forward_backward(s[None], np.array([len(s)]), start, move)
        assert x[0].tolist() == path and np.allclose(x[1], p[0][np.arange(len(s)), path]) and np.allclose(x[2], s)
        assert np.isclose(model.loss(x[2], path, x[3]), whole[0] - path_score(path, s, start, move))


def test_paths_of_a_batch_are_found_together(monkeypatch):
    """Records of a batch share the steps of the search, ``PATHS_AT_ONCE`` at a time; null and empty records stay."""
    import pyarrow as pa

    from spanforge.operators import sequence as S

    calls = []
    together = S.viterbi_paths
    monkeypatch.setattr(S, "viterbi_paths", lambda scores, *a: calls.append(len(scores)) or together(scores, *a))
    rnd = np.random.default_rng(3)
    start, move = S.bio_rules(["O", "B-x", "I-x"])
    rows = [None if k % 50 == 7 else rnd.integers(0, 4, (k % 13, 3)).astype(float).tolist() for k in range(600)]
    array = pa.array([[[9.0, 9.0, 9.0]], *rows], pa.list_(pa.list_(pa.float64()))).slice(1)
    got = S._path_arrays(array, start, move).to_pylist()
    assert got == [None if r is None else S.viterbi(np.array(r).reshape(len(r), 3), start, move) for r in rows]
    assert len(calls) == 3 and max(calls) == S.PATHS_AT_ONCE
    assert S._path_arrays(array.slice(0, 0), start, move).to_pylist() == []


TEXTS = ["Go x x, w3 my x", "", None, "ΑΣ Σ İx x² éa", "one", "  . ,", "x" * 40 + " 漢字 y_1 go x", "go x " * 300]


def test_words_are_tagged_like_their_feature_rows(spark):
    """Words, offsets, tags and probabilities are those of the SQL features of each text, tagged alone."""
    from spanforge.functions.spans import token_spans

    d = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(TEXTS)], "doc_id long, chunk_no int, text string").coalesce(1)
    r = np.random.default_rng(4)
    rows = d.select("doc_id", token_spans("text").alias("s")).select(F.col("doc_id").alias("id"), F.transform("s", lambda t: t["text"]).alias("tokens"), F.transform("s", lambda _t: F.lit(0)).alias("ner_tags"), "s")
    feats = {int(x.id): x.feats for x in sequence_rows(rows, 1 << 40).collect()}
    spans = {x.id: x.s for x in rows.collect()}
    ids = np.unique(np.array([x for f in feats.values() for g in f for x in g[:3] + g[5:]], np.int64))
    model = SequenceModel(NAMES, 1 << 40, ids, r.normal(size=(len(ids), 9)), r.normal(size=9), r.normal(size=(9, 9)))
    got = {}
    for w in tag_sequences(d, model).orderBy("doc_id", "pos").collect():
        got.setdefault(w.doc_id, []).append(w)
    assert set(got) == {i for i, f in feats.items() if f}
    for i, words in got.items():
        tags, sure, _s = model.tag(feats[i])
        assert [(w.chunk_no, w.pos, w.word, w.start, w.end) for w in words] == [(i % 3, k, t.text, t.start, t.end) for k, t in enumerate(spans[i])]
        assert [NAMES.index(w.tag) for w in words] == tags and np.allclose([w.confidence for w in words], sure)


def test_features_are_hashed_once_a_batch(monkeypatch):
    """A word that stands often in a batch is hashed once for each kind of feature, not at each place."""
    import pyarrow as pa

    from spanforge.functions import hashed

    cut, starts, _ends, tokens = hashed.token_arrays(pa.array(["go x"] * 1000 + TEXTS))
    features = hashed.context_features(tokens, cut)
    assert all(len(at) == len(starts) > 2600 for _names, at in features)
    assert sum(len(names) for names, _at in features) < 150
    seen = []
    monkeypatch.setattr(sequence, "xxhash64", lambda names: seen.append(len(names)) or hashed.xxhash64(names))
    model = SequenceModel(NAMES, 1000, np.arange(1000), np.ones((1000, 9)))
    assert (model.place_scores(features) == 7).all() and sum(seen) < 150
    assert [list(p) for p in hashed.parts(pa.array(["ab", None, "c"]))] == [[0, 3]]
    monkeypatch.setattr(hashed, "TEXT_AT_ONCE", 2)
    assert list(hashed.parts(pa.array(["abc", None, "c", "d", "e"]).slice(0))) == [(0, 1), (1, 4), (4, 5)]


def test_hashes_are_those_of_spark(spark):
    import pyarrow as pa
    from pyspark.ml.feature import HashingTF

    from spanforge.functions import hashed

    names = [c * n for n in range(70) for c in ("q", "é")] + ["pw=<s>|", "漢😀"]
    d = spark.createDataFrame([(i, x, [x]) for i, x in enumerate(names)], "i int, s string, a array<string>")
    rows = HashingTF(inputCol="a", outputCol="x", numFeatures=1 << 18).transform(d).select("x", F.xxhash64("s").alias("h")).orderBy("i").collect()
    assert hashed.xxhash64(pa.array(names)).tolist() == [r.h for r in rows]
    assert (hashed.murmur3(pa.array(names)).astype(np.int64) % (1 << 18)).tolist() == [int(r.x.indices[0]) for r in rows]


@pytest.mark.parametrize("wide", [1.0, 30.0, 1000.0])
def test_sums_of_products_equal_sums_of_logarithms(wide):
    """Records of any length, with forbidden moves; scores too far apart are summed in logarithms."""
    r = np.random.default_rng(7)
    start, move = bio_rules(NAMES)
    size = np.array([3, 1, 12, 7, 12])
    s = r.normal(size=(5, 12, 9)) * wide
    start, move = start + r.normal(size=9), move + r.normal(size=(9, 9))
    assert (sequence._product_sums(s, size, start, move, True) is None) == (wide == 1000)
    want, got = sequence._log_sums(s, size, start, move, True), forward_backward(s, size, start, move)
    for a, b in zip(want, got):
        assert np.allclose(a, b)
    for n, x, path in zip(size, s, sequence.viterbi_paths(s, size, start, move)):
        assert path[:n].tolist() == viterbi(x[:n], start, move) and not path[n:].any()
    assert not sequence._near(1.0, np.zeros(2), np.array([[0.0, -1e4], [-1e4, 0.0]]))  # labels that never meet


def test_a_shard_pass_steps_through_arrays(spark):
    """Batches of 16 records by id, each weight by its own squares: as written out record by record.  Records of any
    number of features, without tags left out; one row a feature for all labels."""
    import pyarrow as pa

    r = np.random.default_rng(8)
    rows = []
    for i in r.permutation(40).tolist():
        n = int(r.integers(0, 9))
        rows.append({"id": f"{i:02d}", "feats": [r.integers(0, 60, r.integers(0, 5)).tolist() for _ in range(n)], "gold": r.integers(0, 9, n).tolist()})
    rows[3]["gold"] = None
    kind = pa.schema([("id", pa.string()), ("feats", pa.list_(pa.list_(pa.int64()))), ("gold", pa.list_(pa.int32()))])

    class Shared:
        ids = np.arange(0, 60, 2)
        value = SequenceModel(NAMES, 60, ids, r.normal(size=(30, 9)), r.normal(size=9), r.normal(size=(9, 9)), r.random((30 + 10, 9)))

    m = Shared.value
    w, sq = {}, {}
    names, values = m.parameter_names(), m.parameters()
    for x, a, b in zip(names.tolist(), values, m.squares):
        w[x], sq[x] = a.copy(), b.copy()
    for x in range(60):
        w.setdefault(x, np.zeros(9)), sq.setdefault(x, np.zeros(9))
    old = {x: (w[x].copy(), sq[x].copy()) for x in w}
    used = sorted((x for x in rows if x["gold"]), key=lambda x: x["id"])
    for lo in range(0, len(used), 16):
        slope = {}
        add = lambda x, v: slope.setdefault(x, np.zeros(9)).__iadd__(v)
        for x in used[lo:lo + 16]:
            s = np.array([sum((w[f] for f in fs), np.zeros(9)) for fs in x["feats"]])
            move = np.array([w[-2 - i] for i in range(9)])
            _all, tags, moves = sequence._log_sums(s[None], np.array([len(s)]), w[-1] + m.rules[0], move + m.rules[1], True)
            step = np.eye(9)[x["gold"]] - tags[0]
            for fs, v in zip(x["feats"], step):
                for f in fs:
                    add(f, v)
            add(-1, step[0])
            for a, b in zip(x["gold"], x["gold"][1:]):
                moves[a, b] -= 1
            for i in range(9):
                add(-2 - i, -moves[i])
        for x, v in slope.items():
            sq[x] += v**2
            w[x] += 0.3 * v / np.sqrt(sq[x] + sequence.FIRST_SQUARE)
    got = sequence._shard_pass(Shared, 0.3)(pa.Table.from_pylist(rows, kind)).to_pylist()
    assert len({x["feature"] for x in got}) == len(got) and {x["feature"] for x in got} == {x for x in w if (sq[x] != old[x][1]).any()}
    for x in got:
        f, n = x["feature"], len(used)
        assert np.allclose([x[f"change{j}"] for j in range(9)], n * (w[f] - old[f][0])) and np.allclose([x[f"growth{j}"] for j in range(9)], n * (sq[f] - old[f][1]))


def test_feature_numbers_equal_the_sql_features(spark):
    """Whole batches of records, also without words or with a null among them, have the numbers of the SQL features."""
    from spanforge.operators.training import feature_rows

    rows = [("a", ["Go", "x", "ΑΣ", ""], [1, 2, 0, 0]), ("b", ["x", None, "y", None], [0, 0, 0, 0]), ("c", [], []), ("d", None, None), (None, ["x" * 40], [3])]
    d = spark.createDataFrame(rows, "id string, tokens array<string>, ner_tags array<int>").coalesce(1)
    sql = F.transform(feature_rows(), lambda f: F.transform(f["features"], lambda x: F.pmod(F.xxhash64(x), F.lit(1000))))
    want = [tuple(x) for x in d.select("id", sql.alias("f"), "ner_tags").collect()]
    assert [tuple(x) for x in sequence_rows(d, 1000).collect()] == want
