"""Operators against brute force, on small tables with hostile rows."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import decontam, fm_dedup, jaccard_metric, langid_ecoc, lm_xent, pii_gbt, poisson_mix, warc_merge
from spanforge.llm.ann_forest import nearest
from spanforge.llm.common import shared_path, written
from spanforge.llm.graph import components
from spanforge.llm.license_scan import ORACLE, TEMPLATES, scan_licenses, templates_of

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(4)
VOCAB = ["".join(rng.choice(["an", "the", "or", "in", "ti", "on", "re", "ha", "st"]) for _ in range(rng.randint(1, 3))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(text, every, seed):
    r, words = random.Random(seed), text.split(" ")
    for i in range(seed % every, len(words), every):
        words[i] = f"x{r.randint(0, 10**6)}"
    return " ".join(words)


def documents():
    base = prose(300, 1)
    rows = [(0, base), (1, base), (2, base.upper()), (3, edited(base, 60, 3)), (4, edited(base, 25, 4)), (5, None), (6, ""), (7, " \t\n"), (8, "one"),
            (9, "one"), (10, "one two"), (11, "ONE two"), (12, "É ß one"), (13, prose(6000, 13)), (14, edited(prose(6000, 13), 900, 1)),
            (15, prose(80, 15) + " " + " ".join(base.split()[50:90]) + " " + prose(40, 16)), (16, "a b c d"), (17, "a  b c\td"), (18, "a b c d")]
    # a large group of near copies, some near each other only through others
    rows += [(100 + i, edited(base, 40 + i % 80, i)) for i in range(150)]
    rows += [(300 + i, prose(60, 300 + i) + " " + prose(30, 7) + " " + prose(20, 900 + i)) for i in range(60)]
    return [(i, t, None, None if i % 7 == 0 else f"s{min(i % 7, 3)}", None if t is None else len(t)) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).withColumns({"n": F.lit(1), "id": F.lit("x"), "p": F.lit(0), "words": F.lit("w"), "pii_text": F.lit("z"), "copy_no": F.lit(9)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs():
    return [(r[0], r[1]) for r in documents()]


# ---- 1 decontamination -------------------------------------------------------------

def test_alignment_equals_the_recurrence():
    r = np.random.default_rng(0)
    for _ in range(200):
        doc, item = r.integers(0, 5, r.integers(1, 30)), r.integers(0, 5, r.integers(1, 12))
        score, a, b = decontam.align(doc, item)
        assert score == brute.local_score(list(doc), list(item))
        if score:  # the reported range holds an alignment of that score
            assert brute.local_score(list(doc[a:b + 1]), list(item)) == score


def test_leaks_are_found_and_clean_documents_left(spark):
    items = [(k, prose(20 + 3 * k, 5000 + k)) for k in range(12)] + [(50, None), (51, ""), (52, "two words"), (60, prose(20, 5000))]
    rows = [(k, prose(200, k)) for k in range(40)]
    rows += [(100 + k, prose(50, 600 + k) + " " + items[k][1].upper().replace(" ", ", ") + "\n" + prose(50, 700 + k)) for k in range(12)]
    rows += [(200 + k, prose(50, 800 + k) + " " + edited(items[k][1], 7, k) + " " + prose(9, 900 + k)) for k in range(12)]
    rows += [(400 + k, prose(30, 400 + k) + " " + items[3][1]) for k in range(100)] + [(999, None), (998, ""), (100, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(5)).withColumn("dc_hits", F.lit(0))
    got = decontam.find_leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    words = lambda t: [w.lower() for w in __import__("re").findall(r"\w+", t or "")]
    for r in got:
        want = {i: s for i, t in items if t and words(t) and (s := brute.local_score(words(r.text), words(t)) / (2 * len(words(t)))) >= decontam.THRESHOLD}
        assert {h.item_id: round(h.score, 9) for h in r.dc_hits} == {i: round(s, 9) for i, s in want.items()}
    assert all(r.dc_hits for r in got if 100 <= r.doc_id < 500 and r.text) and not any(r.dc_hits for r in got if r.doc_id < 40)


@pytest.mark.parametrize("every", [4, 5])
def test_one_edited_copy_in_many_documents_is_found(spark, every):
    item = prose(38, 5100)
    copy = edited(item, every, every - 1)
    rows = [(k, prose(30, 5200 + k) + " " + copy + " " + prose(30, 5300 + k)) for k in range(50)] + [(100 + k, item) for k in range(5)] + [(200, prose(90, 5400))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.dc_hits for r in decontam.find_leaks(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert not got.pop(200)
    for i, t in rows[:-1]:
        assert [round(h.score, 9) for h in got[i]] == [round(brute.local_score(t.split(), item.split()) / 76, 9)]


def test_a_copy_with_one_seed_is_found(spark):
    item = "a1 a2 a3 a4 a5 a6 a7 a8 a9"
    d = spark.createDataFrame([(1, "z a1 a2 a3 x a5 a6 x a8 a9 z")], "doc_id long, text string")
    got = decontam.find_leaks(d, spark.createDataFrame([(1, item)], "item_id long, text string")).first().dc_hits
    assert [(h.score, h.start_word, h.end_word) for h in got] == [(12 / 18, 1, 9)]


def test_insertions_and_deletions_of_every_length_are_found(spark):
    items = {n: prose(n, 5500 + n).split() for n in (38, 59)}
    rows = []
    for n, w in items.items():
        h = n // 2
        for k in range(1, 2 * n):
            rows.append(prose(9, k).split() + w[:h] + prose(k, 5600 + k).split() + w[h:] + prose(9, k).split())
        for k in range(1, n - 5):
            rows.append(prose(60, k).split() + w[:(n - k) // 2] + w[(n - k) // 2 + k:] + prose(60, k + 1).split())
            rows.append(w[:n // 3] + prose(k, k).split() + w[n // 3:2 * n // 3] + prose(k // 2, k).split() + w[2 * n // 3 + k // 8:])
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = 0
    for r in decontam.find_leaks(d, bench).collect():
        want = {n: s for n, w in items.items() if (s := brute.local_score(rows[r.doc_id], w) / (2 * n)) >= decontam.THRESHOLD}
        assert {h.item_id: round(h.score, 9) for h in r.dc_hits} == {n: round(s, 9) for n, s in want.items()}
        for h in r.dc_hits:
            assert round(brute.local_score(rows[r.doc_id][h.start_word:h.end_word + 1], items[h.item_id]) / (2 * h.item_id), 9) == round(h.score, 9)
        found += bool(want)
    assert 100 < found < len(rows)


def test_no_alignment_at_the_threshold_is_missed(spark):
    """Items of every length, each third word replaced, words put in every gap or second gap,
    scores just at and just below the threshold; against the full recurrence on every pair."""
    r, rows, items = random.Random(9), [], {}
    for n in [*range(1, 61), 100, 180, 200]:
        w = items[n] = [f"i{n}x{j}" for j in range(n)]
        rows += [[w[j] if j % 3 != c else "zz" for j in range(n)] for c in range(3)]
        rows += [[x for j, v in enumerate(w) for x in ([v, f"q{j}"] if j % s == 0 else [v])] for s in (1, 2)]
        least = -(-decontam.NUM * 2 * n // decontam.DEN)
        for lost in (0, 1):  # the first words alone, at the least score and one word less
            rows.append(["y"] * 3 + w[:-(-least // 2) - lost] + ["y"] * 3)
        for _ in range(2):
            rows.append([x for v in w for x in r.choice([[v], [v], [v], [v, "k"], ["k"], []])])
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {x.doc_id: {h.item_id: round(h.score, 9) for h in x.dc_hits} for x in decontam.find_leaks(
        d, spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")).collect()}
    found = 0
    for i, t in enumerate(rows):
        held = {int(x[1:].split("x")[0]) for x in t if x[0] == "i"}
        want = {n: s for n in held if decontam.enough(s := brute.local_score(t, items[n]), n)}
        assert got[i] == {n: round(s / (2 * n), 9) for n, s in want.items()}, t
        found += len(want)
    assert found > 150


def test_seeds_are_the_rarest_that_suffice():
    w = np.arange(1, 41).astype(np.uint64)
    items = decontam.Items([1], [w])
    found = np.where(np.isin(items.keys, w), 10, 1)  # words are common, pairs are not
    df = {int(k): int(n) for k, n in zip(items.keys, found)}
    items.choose(found)
    assert set(items.size) == {2} and len(items.hash) == decontam.loss(40) + 1
    items = decontam.Items([1], [w])
    items.choose(np.array([0 if k in (3, 9) else 1 if k in df and k <= 40 else 50 for k in items.keys.tolist()]))
    assert set(items.size) == {1} and {3, 9} <= set(items.hash.tolist()) and len(items.hash) == decontam.loss(40) // 2 + 1


def test_decontamination_of_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(empty, bench).count() == 0
    d = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert decontam.find_leaks(d, bench).first().dc_hits == []


# ---- 2 archives --------------------------------------------------------------------

def test_loser_tree_merges_any_runs():
    r = random.Random(2)
    for k in range(9):
        runs = [sorted((r.randint(0, 9), i, j) for j in range(r.randint(0, 6))) for i in range(k)]
        assert list(warc_merge.LoserTree(runs)) == sorted(sum(runs, []))


def test_archives_round_trip_in_global_order(spark):
    big = "<p>" + "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(1, "http://www.a.org/x", big), (2, "http://a.org/x", big), (3, "https://b.org/Y?q=1#f", big + "!"), (4, None, None), (5, "no url", ""),
            (6, "http://a.org/x", "small"), (7, "http://a.org/x", "small"), (9, "http://c.org\r\n/z", big), (9, "http://c.org/z", big), (None, "http://d.org", "x")]
    rows += [(100 + i, f"http://h{i % 5}.org/{i % 3}", f"<b>{i % 11}</b>" * 300) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(5)
    got = warc_merge.archive_and_merge(pages).collect()
    assert len(got) == len(rows)
    import hashlib
    largest = {}
    for i, _u, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            largest[b] = max(i, largest.get(b, i))
    want = sorted((str(i), len(b := (h or "").encode()), hashlib.sha1(b).hexdigest(), *(("revisit", largest[b]) if largest.get(b, i) != i else ("response", None))) for i, _u, h in rows)
    assert sorted((str(r.id), r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in got) == sorted(want, key=str) or \
        sorted(map(str, ((str(r.id), r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in got))) == sorted(map(str, want))
    order = [(r.urlkey, r.ts or "", r.id or 0) for r in sorted(got, key=lambda r: (r.range_no, r.pos))]
    assert order == sorted(order)
    assert next(r.urlkey for r in got if r.id == 1) == "org,a)/x"


def test_large_payloads_are_streamed(spark):
    """Records of megabytes, with line ends of all kinds inside, come back one at a time."""
    r = random.Random(2)
    rows = [(i, f"http://h{i}.org", "".join(r.choice(["\r", "\n", "\r\n\r\n", "x" * 50000, "é", "WARC/1.1\r\n"]) for _ in range(60))) for i in range(30)]
    rows += [(100, "http://l.org", "y" * 5_000_000), (101, "http://m.org", "\n" * 3000), (102, "http://n.org", "\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = shared_path(spark, "warc-test")
    ts = F.when(F.col("page_id") < 9, F.lit("2020-02-03T04:05:06Z")).when(F.col("page_id") == 9, F.lit("today"))
    caps = warc_merge.captures(pages, "page_id", "url", "html", ts)
    warc_merge.write_archives(caps, path)
    got = sorted(warc_merge.read_archives(spark, path).collect(), key=lambda x: x.seq)
    assert {x.id: x.payload_bytes for x in got} == {i: len(h.encode()) for i, _u, h in rows} and len(got) == len(rows)
    assert {x.id: x.ts for x in got if x.id < 11} == {i: "20200203040506" if i < 9 else "today" if i == 9 else None for i in range(11)}
    at = 0
    for x in got:  # records lie end to end
        assert x.offset == at
        at += x.length


@pytest.mark.parametrize("bad", [b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"WARC/1.0\r\nContent-Length: 1\r\n\r\nabc\r\n\r\n", b"other\r\n", b"WARC/1.0\r\nWARC-Type: x\r\n"])
def test_broken_archives_are_refused(bad):
    with pytest.raises(ValueError):
        list(warc_merge.parse_warc(bad.split(b"\n")[:-1]))


def test_archives_of_an_empty_table(spark):
    assert warc_merge.archive_and_merge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- 3 language ID -----------------------------------------------------------------

def test_codewords_differ_and_decoding_corrects_a_bit():
    for k in (2, 3, 4, 6, 9, 20):
        code = langid_ecoc.codewords(k)
        gaps = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(gaps) >= 1 and (k < 4 or min(gaps) >= 3)
        if k >= 4:
            model = langid_ecoc.Model(list(range(k)), code, None, np.ones(code.shape))
            for i in range(k):
                f = code[i].astype(float).copy()
                f[i % len(f)] *= -1
                model.weights = np.vstack([np.zeros((1, code.shape[1])), f[None]])
                assert model.decode(np.zeros((1, 1))).argmax() == i


def test_language_of_held_out_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit(1), "text2": F.lit("")})
    run = lambda x: langid_ecoc.predict(x.select("doc_id", "text", langid_ecoc.held_out().alias("h"), "lang"),
                                        langid_ecoc.train(x, learn=~langid_ecoc.held_out()), keep=("doc_id", "h", "lang")).collect()
    got = run(d)
    held = [r for r in got if r.h]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held) > 10
    assert all(0 <= r.score <= 1 for r in got)
    # labels of held-out documents are not used
    flipped = run(d.withColumn("lang", F.when(langid_ecoc.held_out(), F.lit("xx")).otherwise(F.col("lang"))))
    assert {(r.doc_id, r.lang_pred) for r in got} == {(r.doc_id, r.lang_pred) for r in flipped}


def test_language_of_odd_rows(spark, empty):
    rows = [(i, prose(30, i), "en") for i in range(20)] + [(50, None, "en"), (51, "", "en"), (52, "123 -- ::", "en"), (None, "the an or", None), (53, "x" * 200000, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid_ecoc.predict(d, langid_ecoc.train(d)).collect()}
    assert {got[i].lang_pred for i in (50, 51, 52)} == {"und"} and got[50].score == 0 and got[None].lang_pred == "en" and got[53].score == 1
    two = d.withColumn("lang", F.when(F.col("doc_id") < 10, "a").when(F.col("doc_id") < 20, "b"))
    assert {r.lang_pred for r in langid_ecoc.predict(two, langid_ecoc.train(two)).collect()} <= {"a", "b", "und"}
    none = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid_ecoc.predict(none, langid_ecoc.train(none)).collect()} == {"und"}
    assert langid_ecoc.predict(empty, langid_ecoc.train(empty)).count() == 0


def test_three_hundred_languages(spark):
    """Every label is learnt, also the rarest; a kept column named like an added one is replaced."""
    def text(k, seed):
        r = random.Random(seed)
        return " ".join(f"{chr(0x4E00 + k)}{chr(0x5E00 + 7 * k)}{r.choice('abc')}" for _ in range(30))

    rows = [(i, text(i % 300, i), f"l{i % 300}", None, 1) for i in range(1500)] + [(9000 + i, text(5, i), "l5", None, 1) for i in range(600)]
    d = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x"))
    model = langid_ecoc.train(d)
    assert len(model.languages) == 300
    got = langid_ecoc.predict(d, model, keep=("doc_id", "lang", "score")).collect()
    assert sum(r.lang_pred == r.lang for r in got) > 0.9 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_decoding_equals_the_losses_of_each_codeword():
    r = np.random.default_rng(3)
    code = langid_ecoc.codewords(9)
    model = langid_ecoc.Model(list(range(9)), code, r.normal(size=(6, code.shape[1])), r.random(code.shape))
    x = r.normal(size=(20, 5))
    f = x @ model.weights[:-1] + model.weights[-1]
    cost = np.array([[sum(model.trust[k, b] * np.log1p(np.exp(-code[k, b] * row[b])) for b in range(code.shape[1])) for k in range(9)] for row in f])
    assert (model.decode(x).argmax(1) == cost.argmin(1)).all()


# ---- 4 nearest neighbours ----------------------------------------------------------

def test_recall_and_exact_scores(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest(v, F.col("vec_id") % 100 == 0).collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in v.collect()}
    ids = np.array(sorted(x))
    m = np.array([x[i] for i in ids])
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((m - x[q]) ** 2).sum(1))
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - np.sqrt(((x[q] - x[r.vec_id]) ** 2).sum())) < 1e-12 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hit += len(set(best) & {r.vec_id for r in mine})
        total += 10
    assert hit / total >= 0.9


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (200, [0.0, 0.0]), (None, [1.0, 1.0]), (8, [3.0]), (9, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in nearest(v, F.col("vec_id") % 100 == 0).collect())
    s = round(2 ** 0.5, 6)
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, s), (100, 1, 0, s), (100, 2, 1, s), (100, 3, 2, s)]
    assert nearest(v.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


# ---- 5 language-model scoring --------------------------------------------------------

def plain_words(text):
    return re.findall("[\u3000-\u9fff]|[0-9a-z\x80-\u2fff\ua000-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_losses(rows, marked, order=lm_xent.ORDER):
    """Both losses of every row with its own n-grams taken off, from counts in dictionaries."""
    def count(texts):
        out = {}
        for w in texts:
            for n in range(1, order + 1):
                for i in range(len(w) - n + 1):
                    out[tuple(w[i:i + n])] = out.get(tuple(w[i:i + n]), 0) + 1
        return out

    split = [(i, plain_words(t)) for i, t in rows]
    every, target = count([w for _i, w in split]), count([w for i, w in split if i in marked])
    vocabulary = len({x for _i, w in split for x in w}) + 1
    total, total_target = (sum(v for k, v in c.items() if len(k) == 1) for c in (every, target))
    out = []
    for i, w in split:
        own = count([w])

        def loss(counts, total, off, scale):
            c = lambda k: (counts.get(k, 0) - own.get(k, 0) * off) * scale
            sum_ = 0.0
            for j in range(len(w)):
                p = (c((w[j],)) + 1) / ((total - len(w) * off) * scale + vocabulary)
                for n in range(2, min(order, j + 1) + 1):
                    p = (c(tuple(w[j - n + 1:j + 1])) + lm_xent.PRIOR * p) / (c(tuple(w[j - n + 1:j])) + lm_xent.PRIOR)
                sum_ -= np.log(p)
            return sum_ / len(w) if w else None
        out.append((i, len(w), loss(target, total_target, i in marked, 1), loss(every, total, 1, total_target / total if total_target else 1)))
    return out


def same_losses(got, want):
    mine = [(r.doc_id, r.n_tokens, r.loss_target, r.loss_background) for r in got]
    key = lambda r: (str(r[0]), r[1], round(r[2] or 0, 6), round(r[3] or 0, 6))
    assert len(mine) == len(want)
    for w, m in zip(sorted(want, key=key), sorted(mine, key=key)):
        assert w[:2] == m[:2] and all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(w[2:], m[2:])), (w, m)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_losses_equal_a_plain_model(spark, monkeypatch, order):
    monkeypatch.setattr(lm_xent, "SHARE", 1)
    rows = [(0, "the cat sat"), (1, "a cat ran, the dog sat"), (2, "zz top"), (3, None), (4, ""), (5, "é"), (1, "again"), (6, " .,"), (0, "The CAT sat"),
            (None, "the cat ran"), (None, "the cat ran"), (7, "漢字 かな x漢y"), (2, "x漢y 漢"), (8, "the cat sat " * 50)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"quality": F.lit(1), "b": F.lit(0), "mark": F.lit(2), "n": F.lit("n")})
    labels = spark.createDataFrame([(0, 1), (0, 0), (2, 0), (1, None), (9, 1), (None, 1), (7, 1)], "doc_id long, quality int")
    same_losses(lm_xent.cross_entropy_difference(d, labels, F.col("quality") == 1, order=order).collect(), plain_losses(rows, {0, 7}, order))


def test_every_run_of_words_has_its_own_count(spark, monkeypatch):
    # counts must not depend on the blocks, nor on an id whose texts fill several of them
    monkeypatch.setattr(lm_xent, "SHARE", 1)
    monkeypatch.setattr(lm_xent, "MERGE", 3000)
    r = random.Random(5)
    rows = [(i, " ".join(f"{r.choice(VOCAB)}{r.randint(0, 30)}" for _ in range(600))) for i in range(60)]
    rows += [(0, f"{k} " + prose(300, k)) for k in range(40)] + [(900, "abcdefgh " * 20), (901, "abcdefgi " * 20), (None, "abcd " * 9)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (0, 1, 2, 900)], "doc_id long, quality int")
    want = plain_losses(rows, {0, 1, 2, 900})
    for size in (1 << 25, 1 << 15):  # one block, and many
        monkeypatch.setattr(lm_xent, "BLOCK", size)
        same_losses(lm_xent.cross_entropy_difference(d, labels, F.col("quality") == 1).collect(), want)


def test_target_documents_score_like_others_of_their_kind(spark):
    """Two kinds of text over one vocabulary; half of the one kind is the target."""
    def chain(seed, step):
        r, at, out = random.Random(seed), seed % 200, []
        for _ in range(120):
            out.append(VOCAB[at])
            at = (at * step + r.randint(0, 5)) % 200
        return " ".join(out)

    rows = [(i, chain(i, 7 if i % 2 else 3)) for i in range(600)]
    labels = spark.createDataFrame([(i, 1) for i in range(1, 600, 4)], "doc_id long, quality int")
    got = lm_xent.cross_entropy_difference(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.col("quality") == 1).collect()
    kind = lambda keep: np.array([r.xent_diff for r in got if keep(r.doc_id)])
    marked, held, other = kind(lambda i: i % 4 == 1), kind(lambda i: i % 4 == 3), kind(lambda i: i % 2 == 0)
    assert abs(marked.mean() - held.mean()) < 0.5 * min(marked.std(), held.std())
    assert max(marked.max(), held.max()) < other.min()


def test_scoring_without_target_or_rows(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert lm_xent.cross_entropy_difference(empty, none, F.col("quality") == 1).count() == 0
    d = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_xent.cross_entropy_difference(d, none, F.col("quality") == 1).collect()}
    assert got[1].loss_target == got[2].loss_target >= 0 and got[1].xent_diff >= 0 and got[3].xent_diff is None and got[3].n_tokens == 0


# ---- 6 licenses --------------------------------------------------------------------

def test_licences_are_told_apart(spark):
    texts = {"This work is licensed under CC BY 4.0": "cc-by", "This work is licensed under CC BY-NC 4.0": "cc-by,cc-by-nc", "released under the GPL license": "",
             "released " + prose(120, 1) + " under " + prose(120, 2) + " the " + prose(120, 3) + " mit " + prose(100, 4) + " license": "",
             prose(250, 5) + " released under the MIT license " + prose(250, 6): "mit",
             "this work is licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",  # gpl: base phrase
             "this work is licensed under the GNU General Public License, version 3": "gpl",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
             "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by", "worK released under the mit license": "mit"}
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in scan_licenses(d).collect()} == dict(enumerate(texts.values()))


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("own", "You MAY share, (never) sell", ["never"]), (None, "x", None), ("none", " ., ", None), ("free", "take it all", None)],
                                  "label string, text string, marks array<string>")
    templates = templates_of(table)
    assert templates == [("free", "take it all", ()), ("own", "you may share never sell", ("never",))]
    d = spark.createDataFrame([(1, "you may share never"), (2, "you may share sell"), (3, "Take\nit all"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(d, templates=templates).collect()}
    assert got == {1: ("own", 0.8), 2: ("", 0.0), 3: ("free", 1.0), 4: ("", 0.0)}
    assert {r.labels for r in scan_licenses(d, templates=[]).collect()} == {""}

def test_license_scan_equals_sql(spark, empty):
    rows = [(1, "x cc by cc by CC-BY!\nLicensed under CC BY-NC 4.0."), (2, None), (3, ""), (4, " ... "), (5, "All rights\nreserved all RIGHTS reserved"),
            (6, "gnu General\nPublic License all rights reserved cc by"), (7, "cc by"), (7, "cc by"), (None, "Released under the MIT License"), (8, "released under mit license terms"),
            (9, "under license the mit released extra words\nnothing"), (10, "Licensed under the Apache License, Version 2.0. " + prose(3000, 1)),
            (11, "the license version " * 50), (12, "İ K cc by ß cc by"), (13, "général public license\ncc byé")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"label": F.lit("l"), "token": F.lit("t"), "ls_id": F.lit(3)})
    mine = scan_licenses(d)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(ORACLE)
    key = lambda r: str(tuple(round(x, 9) if isinstance(x, float) else x for x in r))
    assert sorted(map(key, map(tuple, mine.select(*want.columns).collect()))) == sorted(map(key, want.fetchall()))
    assert scan_licenses(empty).count() == 0


def test_notices_that_wrap_over_lines_are_found(spark):
    r, rows, want = random.Random(6), [], {}
    for k, (label, text, _marks) in enumerate(TEMPLATES):
        for c in range(3):
            words = text.split()
            cuts = set(r.sample(range(1, len(words)), min(len(words) - 1, 2 + c)))
            notice = "".join(("\n  * " if i in cuts else " ") + w for i, w in enumerate(words))
            rows.append((10 * k + c, prose(80, k) + notice + "\n" + prose(400, c)))
            want[10 * k + c] = label
    rows += [(900, "Licensed under the Apache\nLicense, Version 2.0."), (901, "licensed\n" + prose(60, 1) + "\nunder the apache\n" + prose(60, 2) + "\nlicense version 2 0"),
             (902, "Licensed under the Apache\n" + " ".join(["x"] * 3) + "\nLicense, Version 2.0."), (903, "\n")]
    got = {x.doc_id: x for x in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, label in want.items():
        assert label in got[i].labels.split(",") and got[i].score == 1
    assert got[900].labels == "apache" and got[900].score == 1
    assert got[901].labels == got[903].labels == "" and got[901].score == 0 and got[902].labels == ""


# ---- 7 Jaccard join ----------------------------------------------------------------

@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_components_equal_brute_force(docs, k, num, den):
    want = brute.jaccard_components(pairs(), k, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_metric.similar_components(docs, k=k, num=num, den=den).collect()}
    assert got == want and len({c for _n, c in want.values()}) < len(want) - 60


def test_components_over_many_blocks(docs, monkeypatch):
    monkeypatch.setattr(jaccard_metric, "BLOCK_SHINGLES", 512 * 10)
    monkeypatch.setattr(jaccard_metric, "SAMPLE", 1)
    want = brute.jaccard_components(pairs(), 3, 90, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_metric.similar_components(docs, k=3, num=90, den=100).collect()}
    assert got == want


def test_recursive_region_join_loses_no_link():
    r = np.random.default_rng(3)
    for trial in range(6):
        centres = [r.choice(2000, 60, replace=False) for _ in range(6)]
        sets = []
        for _ in range(220):
            c = centres[r.integers(6)].copy()
            c[:r.integers(0, 14)] = r.integers(5000, 90000, 60)[:r.integers(0, 14)].sum()
            sets.append(np.unique(c).astype(np.uint64))
        ids = list(range(len(sets)))
        links = jaccard_metric.Links(len(sets))
        for a in ids:
            for b in range(a):
                inter = len(np.intersect1d(sets[a], sets[b]))
                if 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
                    links.join(a, b)
        mine = jaccard_metric.Links(len(sets))
        for a, b in jaccard_metric.region_edges(ids, sets, 85, 100):
            mine.join(a, b)
        assert [links.root(i) for i in ids] == [mine.root(i) for i in ids]


def test_small_groups_go_through_regions(spark):
    """Groups of the test table have boundary documents that windows replicate."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    found = written(jaccard_metric.similar_components(table).where("n_shingles > 0"), "found")
    large = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 2")
    texts, groups = {}, {}
    for r in table.join(found.join(large, "component_id"), "doc_id").collect():
        texts[r.doc_id] = r.text
        groups.setdefault(r.component_id, []).append(r.doc_id)
    regions = replicated = 0
    for docs_of in groups.values():
        raw = [texts[d].encode() for d in docs_of]
        row, g = jaccard_metric.shingle_rows(np.cumsum([0] + [len(t) for t in raw]), np.frombuffer(b"".join(raw), np.uint8), 5)
        sets = list({x.tobytes(): x for x in (g[row == i] for i in range(len(raw)))}.values())
        if len(sets) <= jaccard_metric.LEAF:
            continue
        members = np.array(sorted(range(len(sets)), key=lambda i: len(sets[i])))
        cores = 0
        for core, window in jaccard_metric.voronoi_regions(sets, members, 80, 100):
            regions, cores, replicated = regions + 1, cores + len(core), replicated + len(set(window) - set(core))
        assert cores == len(sets)
    assert regions > 1 and replicated > 0


@pytest.mark.parametrize("n", [3, 4, 7, 13, 40])
def test_regions_of_small_groups_lose_no_link(n):
    r = np.random.default_rng(n)
    for _trial in range(20):
        base = r.choice(5000, 50, replace=False)
        sets = []
        for _ in range(n):
            c = base.copy()
            k = r.integers(0, 12)
            c[r.choice(50, k, replace=False)] = r.integers(5000, 90000, k)
            sets.append(np.unique(c[:50 - r.integers(0, 6)]).astype(np.uint64))
        want, mine = jaccard_metric.Links(n), jaccard_metric.Links(n)
        for a in range(n):
            for b in range(a):
                inter = len(np.intersect1d(sets[a], sets[b]))
                if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
                    want.join(a, b)
        for a, b in jaccard_metric.region_edges(list(range(n)), sets, 80, 100):
            mine.join(a, b)
        assert [want.root(i) for i in range(n)] == [mine.root(i) for i in range(n)]


def test_components_of_odd_rows(spark, empty):
    d = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (4, "A b  c d"), (5, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in jaccard_metric.similar_components(d, k=3, num=90).collect())
    assert got == [("3", "3"), ("3", "3"), ("4", "3"), ("5", "5"), ("None", "None")]
    assert jaccard_metric.similar_components(empty).count() == 0


def test_components_of_one_id_with_several_texts(spark):
    small, large = prose(102, 61), prose(10002, 62)
    d = spark.createDataFrame([(5, small), (5, large), (9, edited(small, 95, 1)), (4, edited(large, 5000, 2)), (7, prose(50, 63)), (8, prose(50, 64)), (8, prose(50, 63))], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_metric.similar_components(d, k=3, num=90).collect())
    size = lambda t: len(brute.shingles(t, 3))
    assert got == sorted([(5, size(small), 4), (5, size(large), 4), (9, size(edited(small, 95, 1)), 4), (4, size(edited(large, 5000, 2)), 4), (7, 48, 7), (8, 48, 7), (8, 48, 7)])


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(50, 99)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[i] == 50 for i in [*range(50, 99), 100])


# ---- 8 repeated passages -----------------------------------------------------------

@pytest.mark.parametrize("sample", [64, 1])
def test_repeats_equal_brute_force(docs, monkeypatch, sample):
    monkeypatch.setattr(fm_dedup, "SAMPLE", sample)  # 1: most shared anchors count as frequent
    want = brute.repeats(pairs())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in fm_dedup.remove_repeats(docs).collect()}
    assert got == want


def test_backward_search_counts_and_matching_statistics():
    r = np.random.default_rng(1)
    text = r.integers(1, 6, 400)
    text[::50] = 0
    index = fm_dedup.FMIndex(text)
    first = np.array([i for i in range(380) if 0 not in text[i:i + 13]])
    lo, hi, match = index.ranges(text, first, 13)
    for f, a, b, m in zip(first, lo, hi, match):
        assert m == 13
        assert sorted(index.sa[a:b]) == [i for i in range(388) if (text[i:i + 13] == text[f:f + 13]).all()]
    other = np.array([1, 2, 3, 4, 5, 1, 1, 1, 2, 2, 9 % 6, 3, 4])
    _lo, _hi, match = index.ranges(other, np.array([0]), 13)
    longest = max(n for n in range(14) if n == 0 or any((text[i:i + n] == other[13 - n:]).all() for i in range(400 - n + 1)))
    assert match[0] == longest


def test_matching_statistics_against_smaller_documents():
    r = np.random.default_rng(5)
    base = r.integers(1, 40, 400).astype(np.uint32)
    words = [base[i:i + r.integers(13, 60)].copy() for i in r.integers(0, 340, 60)]
    for w in words[::2]:
        w[r.integers(0, len(w))] = 99
    ids = r.integers(0, 40, len(words))
    seen = set()
    for seg, (w, stats) in enumerate(zip(words, fm_dedup.matching_statistics(words, ids))):
        runs = {x[i:i + n].tobytes() for x, d in zip(words, ids) if d < ids[seg] for n in range(1, 14) for i in range(len(x) - n + 1)}
        for f, m in enumerate(stats):
            assert m == max(n for n in range(14) if n == 0 or w[f + 13 - n:f + 13].tobytes() in runs)
        seen |= set(stats.tolist())
    assert {0, 13} <= seen and len(seen) > 8


def test_equal_windows_have_equal_routes_and_frequent_phrases_many():
    phrase = " ".join(VOCAB[:4])
    texts = [prose(20, 700 + i) + " " + phrase + " " + prose(20, 800 + i % 50) for i in range(100)]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(t) for t in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    row, h, _cut = fm_dedup._row_words(offs, data)
    _at, g = fm_dedup.gram_hashes(row, h, fm_dedup.ANCHOR)
    routes, by_anchor = {}, {}
    for frequent in (np.unique(g >> np.uint64(1)), np.zeros(0, np.uint64)):
        routes.clear()
        code, _cut, _row, first, last, low, route = fm_dedup._runs(offs, data, frequent)
        for f, la, a, r in zip(first, last, low, route):
            by_anchor.setdefault(a, set()).add(r)
            for i in range(f, la + 1):
                assert routes.setdefault(code[i:i + 13].tobytes(), r) == r
        assert sum(last - first + 1) == sum(len(t.split()) - 12 for t in texts)
    assert max(map(len, by_anchor.values())) > 20  # one phrase, many routes (it is not the anchor of all its windows)


def test_range_minima():
    x = np.random.default_rng(2).integers(0, 100, 77)
    lo, hi = np.array([(i, j) for i in range(77) for j in range(i + 1, 78)]).T
    assert (fm_dedup.RangeMinima(x).least(lo, hi) == [x[i:j].min() for i, j in zip(lo, hi)]).all()


def test_repeats_of_one_id_with_several_texts(spark):
    a, b, c = prose(40, 71), prose(60, 72), prose(50, 73)
    rows = [(1, a), (2, a), (2, b), (3, c + " " + b[:len(b) // 2]), (3, prose(30, 74) + " " + a)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in fm_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    half = len((b[:len(b) // 2]).split()) - (not b[len(b) // 2 - 1:len(b) // 2 + 1].count(" "))
    assert got == sorted([(1, 40, 0), (2, 40, 40), (2, 60, 0), (3, len(rows[3][1].split()), half), (3, 70, 40)])


def test_repeats_of_odd_rows(spark, empty):
    t = prose(40, 3)
    d = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t), (3, None), (4, prose(12, 3))], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in fm_dedup.remove_repeats(d, keep_text=True).collect())
    assert got == [("1", 40, 0), ("1", 40, 0), ("2", 40, 40), ("3", 0, 0), ("4", 12, 0), ("None", 40, 0)]
    assert fm_dedup.remove_repeats(empty).count() == 0


# ---- 9 mixing ----------------------------------------------------------------------

def test_replication_equals_sql_and_meets_the_rates(spark, docs, empty):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", documents())
    want = con.sql(poisson_mix.ORACLE)
    got = poisson_mix.replicate(plain)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
    assert poisson_mix.replicate(docs).count() == got.count()
    assert poisson_mix.replicate(empty).count() == 0
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 == 0, "rare").otherwise("big").alias("source"))
    n = {r.source: r["count"] for r in poisson_mix.replicate(many, weights={"rare": 0.5, "big": 0.5, "no": 0}).groupBy("source").count().collect()}
    assert abs(n["rare"] - 10000) < 400 and abs(n["big"] - 10000) < 400
    counts = poisson_mix.replicate(many, weights={"rare": 1.0}).groupBy("doc_id").count()
    assert {r.doc_id % 10 for r in counts.select("doc_id").collect()} == {0}
    spread = counts.agg(F.var_pop("count"), F.avg("count")).first()
    assert abs(spread[0] / spread[1] - 1) < 0.15  # variance equals mean


# ---- 10 personal data --------------------------------------------------------------

def odd_strings(n):
    r = random.Random(9)
    parts = ["a@b.c", "a.b+c@d-e.f.g", "@", "x@y", ".", "1.2.3.4", "255.255.255.256", "00001.0.0.0007", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111",
             "+1 (017) 555-7713", "+49 30", "+", "123456789012", "é😀", " ", "  ", "-", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "word", "%d@e.f", "\n", "9", "0"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_base_spans_equal_the_patterns(spark, empty):
    texts = odd_strings(800) + [None, "", "1" * 30000, "a" * 30000 + "@b.c", ("x@y.z " * 700), "+1" + " " * 5000 + "2", "1.2.3.4" * 300]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"pii_text": F.lit("q"), "pii_email": F.lit(0)}).repartition(4)
    rows = pii_gbt.find_private(d, train=False)
    rows = rows.withColumn("clean", pii_gbt.redacted(F.col("pii_text"), F.col("pii_spans"))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, spans = brute.private(texts[r.doc_id])
        assert [len(r[f"pii_{k}"]) for k in pii_gbt.KINDS] == counts
        assert [(s.start, s.no, s.end) for s in r.pii_base] == spans
        out, at = "", 0
        merged = []
        for s, k, e in spans:
            if merged and s < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], e)
            else:
                merged.append([s, k, e])
        for s, k, e in merged:
            out, at = out + (texts[r.doc_id] or "")[at:s] + f"<{pii_gbt.KINDS[k].upper()}>", e
        assert r.clean == out + (texts[r.doc_id] or "")[at:]
    assert pii_gbt.find_private(empty).count() == 0


def test_boosted_candidates_add_spans_only(spark):
    texts = [f"{prose(20, i)} token = \"{random.Random(i).getrandbits(160):040x}\" {prose(9, i)} {random.Random(i).randint(10**15, 10**16)} a{i}@m.org +1 (0{i % 89 + 10}) 555-{1000 + i}" for i in range(250)]
    texts += [f"{prose(10, i)} {'ab' * 12} {i}-{i} order 12 34 56 78 {prose(5, i)} me@home" for i in range(250)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    judge = pii_gbt.train_judge(d)
    assert judge is not None
    got = {r.doc_id: r for r in pii_gbt.find_private(d, judge=judge).collect()}
    secrets = 0
    for i, t in enumerate(texts):
        counts, spans = brute.private(t)
        mine = [(s.start, s.no, s.end) for s in got[i].pii_spans]
        assert [s for s in mine if s[1] < 4] == spans
        more = [s for s in mine if s[1] >= 4]
        assert not any(a < e and s < b for s, _k, e in spans for a, _n, b in more)
        secrets += any(t[a:b].isalnum() and len(t[a:b]) == 40 for a, _n, b in more)
        if i >= 250:
            assert not more
    assert secrets >= 200


def test_the_vocabulary_is_counted_whole(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(7)) + " common") for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    same_losses(lm_xent.cross_entropy_difference(d, labels, F.col("quality") == 1).collect(), plain_losses(rows, set(range(5))))
