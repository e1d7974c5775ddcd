import random
import re

from pyspark.sql import functions as F

from spanforge.functions import argmax, clean_text, find_spans, invert_map, literal_map, pack, pad, token_spans, word_tokens
from spanforge.functions.text import WORD_TOKEN_PATTERN

STOP = ["the", "is", "this", "it's"]

CLEAN_CASES = [
    ("foo<br>bar", "foobar", "foobar"),
    ("Node.js, C++ & C#", "nodejs c c", "nodejs c c"),
    ("a...b end.", "a.b end.", "a.b end."),
    ("x,y", "xy", "xy"),
    ("The end. The.", "the end. the.", "end. the."),
    ("<p\nq>z</p>", "p q z", "p q z"),
    ("naïve – café", "na ve caf", "na ve caf"),
    ("   ", "", ""),
    ("v1.2.3", "v123", "v123"),
    ("e.g. this", "eg. this", "eg."),
    ('say "the" it\'s', 'say "the" it\'s', 'say "the"'),
    (None, "", ""),
]


def test_clean_hand_cases(spark):
    df = spark.createDataFrame([(c[0],) for c in CLEAN_CASES], "t string")
    rows = df.select(clean_text("t", []).alias("a"), clean_text("t", STOP).alias("b")).collect()
    for (src, cleaned, kept), r in zip(CLEAN_CASES, rows):
        assert (r.a, r.b) == (cleaned, kept), src


def test_cleaning_properties_on_random_text(spark):
    rnd = random.Random(7)
    alphabet = "ab .,.'\"<>\n\t-é9Z"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_text("t", []).alias("c"), clean_text("t", STOP).alias("k"))
    for r in df.select("t", "c", "k", clean_text("c", []).alias("again")).collect():
        assert re.fullmatch(r"[a-z0-9.'\" ]*", r.c), r.t                      # alphabet, no comma, lower case
        assert r.c == " ".join(r.c.split(" ")).strip() and "  " not in r.c, r.t  # squeezed
        # a dot is followed by white space or the end, or stood right after a letter and a dot
        assert all(m.end() == len(r.c) or r.c[m.end()] == " " or re.search(r"\w$", r.c[:m.start()]) for m in re.finditer(r"\.", r.c)), r.t
        assert [w for w in r.c.split(" ") if w and w not in STOP] == [w for w in r.k.split(" ") if w], r.t
        if "<" not in r.t and "." not in r.t and "," not in r.t:
            assert r.again == r.c and re.findall("[a-z0-9]+", r.t.lower()) == re.findall("[a-z0-9]+", r.c), r.t


def test_find_spans_equals_finditer(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab c.\n😀²नä_٣½") for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(token_spans("t").alias("s"), find_spans("t", r"a+b").alias("s2")).collect()
    for t, r in zip(texts, got):
        assert [(x.text, x.start, x.end) for x in r.s] == [(m.group(0), *m.span()) for m in re.finditer(r"\b\w+\b", t)]
        assert [(x.text, x.start, x.end) for x in r.s2] == [(m.group(0), *m.span()) for m in re.finditer(r"a+b", t)]


def test_token_spans_substring_property(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(clean_text("text").alias("t"))
    bad = df.select(F.explode(token_spans("t")).alias("s"), "t").where(
        F.expr("substring(t, s.start + 1, s.end - s.start) != s.text")).count()
    assert bad == 0


def test_pack_hand_cases(spark):
    cases = [([3, 3, 3, 9, 1], [[3, 3], [3], [9], [1]]), ([9], [[], [9]]), ([], []), ([3, 4], [[3, 4]])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "l array<int>")
    got = df.select(pack(F.transform("l", lambda x: x.cast("string")), F.col("l"), 7, False).alias("p")).collect()
    for (_, want), r in zip(cases, got):
        assert r.p == [" ".join(str(x) for x in c) for c in want]
    dropped = df.select(pack(F.transform("l", lambda x: x.cast("string")), F.col("l"), 7, True).alias("p")).collect()
    assert dropped[1].p == ["9"]


def test_pack_concatenation_property(spark):
    from spanforge.functions import chunk_text, split_sentences
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(clean_text("text").alias("t"))
    df = df.where("t != ''").select("t", chunk_text(F.col("t")).alias("c"), split_sentences("t").alias("s"))
    bad = df.where(F.array_join("c", " ") != F.array_join("s", " ")).count()
    assert bad == 0


def test_argmax_pad_invert(spark):
    r = spark.range(1).select(
        argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("a"),
        pad(F.array(F.lit(1), F.lit(2)), 4).alias("p"),
        F.element_at(invert_map(literal_map([(0, "O"), (1, "B-X")])), F.lit("B-X")).alias("i")).first()
    assert (r.a, r.p, r.i) == (1, [1, 2, -100, -100], 1)


def test_spans_of_long_rows(spark):
    rnd = random.Random(11)
    texts = [" ".join("".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6)))
                      for _ in range(rnd.randint(60, 3000))) + rnd.choice(["", ".", " x"]) for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(token_spans("t").alias("s"), find_spans("t", WORD_TOKEN_PATTERN).alias("n")).collect()
    for t, r in zip(texts, got):
        want = [(m.group(0), *m.span()) for m in re.finditer(r"\b\w+\b", t)]
        assert [(x.text, x.start, x.end) for x in r.s] == want
        assert [(x.text, x.start, x.end) for x in r.n] == want


def test_tokens_are_python_words(spark):
    texts = ["x²", "नमस्ते a", "½_٣ é́", "", None, "a😀b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", word_tokens("t").alias("w"), token_spans("t").alias("s")).collect():
        want = re.findall(r"\b\w+\b", r.t or "")
        assert [x.text for x in r.s] == want and (r.t is None or list(r.w) == want)


def test_pack_long_documents_cross_blocks(spark):
    rnd = random.Random(9)
    docs = [[rnd.randint(1, 12) for _ in range(rnd.randint(0, 1200))] for _ in range(15)]
    df = spark.createDataFrame([(d,) for d in docs], "l array<int>")
    got = df.select(pack(F.transform("l", lambda x: x.cast("string")), F.col("l"), 30, False).alias("p")).collect()
    for d, r in zip(docs, got):
        chunks = [[int(x) for x in c.split(" ")] for c in r.p]
        assert [x for c in chunks for x in c] == d              # nothing lost, order kept
        assert all(sum(c) <= 30 for c in chunks)                # no unit here exceeds the bound
        assert all(sum(a) + b[0] > 30 for a, b in zip(chunks, chunks[1:]))  # the next sentence did not fit


def test_basic_characters_are_one_table(spark):
    """F2's class names its characters one by one (a class of ranges is several times as slow in Java)
    and keeps what the ranges keep."""
    import re

    from spanforge.functions.text import NON_BASIC_PATTERN, keep_basic_chars

    assert "-" not in NON_BASIC_PATTERN
    texts = ["".join(map(chr, range(a, a + 256))) for a in range(0, 0xD800, 256)] + ["", "é\U0001F600é", "a-b\n\tc"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.x for r in d.select(keep_basic_chars("t").alias("x")).collect()] == [re.sub(r"[^a-zA-Z0-9.,'\" ]+", " ", t) for t in texts]


def test_packing_folds_lengths_only(spark):
    """The fold carries numbers; sentences are joined once from their slices, across blocks and empty ones too."""
    import random

    from spanforge.functions.arrays import PACK_BLOCK, pack

    def plain(sents, sizes, most):
        out, cur, size = [], [], 0
        for s, n in zip(sents, sizes):
            if size + n > most:
                out, cur, size = out + [" ".join(cur)], [], 0
            cur, size = cur + [s], size + n
        return out + ([" ".join(cur)] if cur else [])

    rnd = random.Random(3)
    rows = [([], []), ([""], [0]), (["a"], [99]), *(([rnd.choice(["", "x", "y z"]) for _ in range(k)], [rnd.choice([0, 1, 3, 9, 60]) for _ in range(k)]) for k in (1, 5, PACK_BLOCK, PACK_BLOCK + 1, 3 * PACK_BLOCK + 7))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)] + [(len(rows), None, None)], "i int, s array<string>, n array<int>")
    out = df.select("i", pack(F.col("s"), F.col("n"), 10, False).alias("p"), pack(F.col("s"), F.col("n"), 10).alias("q"))
    for r, (s, n) in zip(out.orderBy("i").collect(), rows):
        assert r.p == plain(s, n, 10) and r.q == [x for x in plain(s, n, 10) if x]
    assert out.where(f"i = {len(rows)}").first().p is None
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "cur, " not in plan  # no open chunk's text in the state


def test_reordered_patterns_equal_the_plain_ones(spark):
    """Patterns that test the cheap part first replace, split and squeeze as the plain ones."""
    import random

    from spanforge.functions import text as T

    assert not T.INNER_DOT_PATTERN.startswith("(?<") and not T.SENTENCE_BREAK_PATTERN.startswith("(?<")
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab. \t\n,..é") for _ in range(rnd.randint(0, 14))) for _ in range(800)]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    bad = df.select(
        T.drop_inner_dots("t").alias("a"), F.regexp_replace("t", r"(?<!\w\.)\.(?!\s|$)", "").alias("b"),
        T.squeeze("t").alias("c"), F.trim(F.regexp_replace("t", r"\s+", " ")).alias("d"),
        T.split_sentences("t").alias("e"), F.split("t", r"(?<=\.)\s+").alias("f"),
        T.drop_commas("t").alias("g"), F.translate("t", ",", "").alias("h")).where("a <> b OR c <> d OR e <> f OR g <> h")
    assert bad.count() == 0


def test_spans_of_a_batch_hold_few_rows_as_strings(monkeypatch):
    """A worker turns a bounded number of rows into Python strings at a time; the spans are those of the whole batch."""
    import pyarrow as pa

    from spanforge.functions import spans as S

    texts = [f"go {i}  é_{i}, x." * (i % 5) for i in range(2000)] + [None, ""]
    whole, seen = S.batch_token_spans([t or "" for t in texts]), []
    plain = S.batch_token_spans
    monkeypatch.setattr(S, "batch_token_spans", lambda rows: seen.append(len(rows)) or plain(rows))
    got = S._span_arrays(pa.array(texts))
    assert max(seen) <= 1000 and sum(seen) == len(texts) == len(got)
    flat = got.flatten()
    assert flat.field("text").to_pylist() == whole[3] and flat.field("start").to_pylist() == whole[1].tolist()
    assert [len(x) for x in got.to_pylist()] == (whole[0][1:] - whole[0][:-1]).tolist() and len(S._span_arrays(pa.array([], pa.string()))) == 0


def test_cleaning_and_lengths_make_one_pass_less(spark):
    """Stop words and runs of spaces go in one pass, and units are counted without an array of them; both give the results of the separate steps."""
    import random

    from spanforge.functions import text as T

    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["a", "the", "it's", ".", " ", "  ", "\t", "\n", "\x0b", ",", "é", "\U0001F600", "<b>", "'", "_"]) for _ in range(rnd.randint(0, 14))) for _ in range(800)]
    df = spark.createDataFrame([(x,) for x in texts] + [(None,)], "t string")
    for stop in (None, [], ["a"]):
        steps = F.coalesce("t", F.lit(""))
        for f in (T.strip_tags, T.keep_basic_chars, T.drop_commas, T.drop_inner_dots, F.lower, T.squeeze):
            steps = f(steps)
        assert df.where(~T.clean_text("t", stop).eqNullSafe(T.remove_stopwords(steps, stop))).count() == 0
    units = F.size(F.regexp_extract_all("t", F.lit(r"\w+|[^\w\s]"), 0))
    assert df.where("t IS NOT NULL").where(T.text_length("t") != units).count() == 0
    plan = df.select(T.clean_text("t").alias("c"), T.text_length("t").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and r"[\t\n\x0B\f\r]" not in plan
