"""Language identification with error-correcting output codes.

Each language has a codeword of bits.  One binary classifier per bit (logistic regression on
hashed byte n-grams of the lower-cased text) predicts that bit; loss-weighted decoding then
picks the language whose codeword costs least, where each bit counts by how well its
classifier separates the language on held-back rows.  A small gap between the two nearest
codewords flags a document as ambiguous.

Learning uses a bounded sample (``SAMPLE_ROWS`` labelled rows in all, spread over the
languages by a hash of the key, and every label has at least one); prediction reads every whole text.

Defined cases: a null text, or one without letters, is ``und`` with score 0; a row without
label is never learnt from but predicted; with no labelled row every text is ``und``; with
one language all texts get it with score 1; null keys and repeated rows are rows like any
other.  Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, set_aside, text_blocks

FEATURES = 4096       # hashed n-gram buckets
GRAM_SIZES = (2, 3, 4)  # bytes
SAMPLE_ROWS = 2048    # labelled rows learnt from, at most (or one a label, if there are more labels)
AMBIGUOUS_BELOW = 0.2  # gap of the scores of the two nearest codewords


def block_features(offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of a block and the row bounds of the result.

    Runs of spaces, digits and punctuation count as one space, so words end alike."""
    raw = LOWER[data]
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other byte after a letter stays, as a space
    raw = np.where(letter, raw, np.uint8(32))[keep].astype(np.uint32)
    before = np.concatenate(([0], np.cumsum(keep)))
    bounds = before[offs]
    # the row of each kept byte, so that no n-gram spans two texts
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    out, rows = [], []
    code = raw.copy()
    for n in range(2, max(GRAM_SIZES) + 1):
        if len(raw) < n:
            break
        code = (code[:-1] << np.uint32(8)) | raw[n - 1:]
        if n in GRAM_SIZES:
            ok = row[:len(code)] == row[n - 1:]
            h = (code + np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(2654435761)
            h ^= h >> np.uint32(15)
            h *= np.uint32(2246822519)
            out.append((h >> np.uint32(32 - FEATURES.bit_length() + 1))[ok])
            rows.append(row[:len(code)][ok])
    return out, rows


def row_vectors(texts: pa.Array):
    """Yield ``(row number, n-gram counts)``; a text without n-grams gives zeros."""
    for lo, offs, data in text_blocks(texts):
        feats, rows = block_features(offs, data)
        n = len(offs) - 1
        cuts = [np.searchsorted(r, np.arange(n + 1)) for r in rows]
        for i in range(n):
            counts = np.zeros(FEATURES, np.int64)
            for f, c in zip(feats, cuts):
                counts += np.bincount(f[c[i]:c[i + 1]], minlength=FEATURES)
            yield lo + i, counts


def _scaled(counts):
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(k: int) -> np.ndarray:
    """``k`` codewords of -1/+1 bits.  Up to 6 languages: all distinct splits (the exhaustive
    code).  Beyond: the best of 64 seeded random codes of about 10 log2 k bits by least distance."""
    if k <= 6:
        cols = [[1 if i == 0 or not (v >> (i - 1)) & 1 else -1 for i in range(k)] for v in range(1, 2 ** (k - 1))]
        return np.array(cols, np.int8).reshape(len(cols), k).T
    rng, best, reach = np.random.default_rng(5), None, -1
    bits = int(np.ceil(10 * np.log2(k)))
    for _ in range(64):
        m = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        m = m[:, np.abs(m.sum(0)) < k]
        alike = m.astype(np.float32) @ m.T.astype(np.float32)
        np.fill_diagonal(alike, -m.shape[1])
        gap = m.shape[1] - float(alike.max())  # twice the least distance
        if gap > reach:
            best, reach = m, gap
    return best


def fit_bits(x1: np.ndarray, y: np.ndarray, steps: int = 120, decay: float = 1e-4) -> np.ndarray:
    """Weights (features + bias, bits) of logistic regressions, classes weighed evenly; the last
    column of ``x1`` is 1."""
    w = np.zeros((x1.shape[1], y.shape[1]), np.float32)
    pos = (y > 0).mean(0).clip(1e-3, 1 - 1e-3)
    weight = np.where(y > 0, 0.5 / pos, 0.5 / (1 - pos)).astype(np.float32) / len(x1)
    last = w
    for t in range(steps):
        look = w + (t / (t + 3)) * (w - last)
        last = w
        grad = -x1.T @ (weight * y / (1 + np.exp(np.clip(y * (x1 @ look), -30, 30)))) + decay * look
        w = look - 6.0 * grad
    return w


class Model:
    """Codewords, bit classifiers and the weight of each bit for each language."""

    def __init__(self, languages, code=None, weights=None, trust=None):
        self.languages, self.code, self.weights, self.trust = languages, code, weights, trust

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Probabilities per language from the weighted logistic losses of its codeword."""
        f = x @ self.weights[:-1] + self.weights[-1]
        loss = {sign: np.log1p(np.exp(np.clip(-sign * f, -30, 30))) for sign in (1, -1)}
        cost = sum(x @ (self.trust * (self.code == sign)).T for sign, x in loss.items())
        p = np.exp(-(cost - cost.min(1, keepdims=True)) * np.log2(len(self.languages) + 1))
        return p / p.sum(1, keepdims=True)


def sample_rows(rows: DataFrame, key: Column) -> DataFrame:
    """At most ``SAMPLE_ROWS`` rows of ``(lang, text)``, evenly over the languages, at least one each.

    Labels are counted first; a hash of the key then keeps a share of each language's rows,
    and only those few are ranked, so a language with most of the rows costs no hot task."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang")
    langs = [(r.lang, r.n) for r in counts.collect()]
    each = max(1, SAMPLE_ROWS // max(1, len(langs)))
    share = F.create_map(*[F.lit(v) for lang, n in langs for v in (lang, min(1.0, 1.5 * each / n + 8 / n))]) if langs else None
    if share is None:
        return rows.where(F.lit(False)).select("lang", "text")
    picked = rows.withColumn("h", F.pmod(F.xxhash64(key, F.lit(3)), F.lit(1 << 30)) / float(1 << 30)).where(
        F.col("h") < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)))
    w = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    return picked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= each).select("lang", "text")


def _sample_vectors(batches):
    for batch in batches:
        idx, val = [], []
        for _i, counts in row_vectors(batch.column("text")):
            at = np.flatnonzero(counts)
            idx.append(at.astype(np.int16).tobytes())
            val.append(_scaled(counts)[at].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], ["lang", "idx", "val"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          learn: Column | None = None) -> Model:
    """Fit the model on the rows where ``learn`` holds and the label is not null."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & (learn if learn is not None else F.lit(True))).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("key"))
    got = sample_rows(rows, F.col("key")).mapInArrow(_sample_vectors, "lang string, idx binary, val binary").toArrow().to_pylist()
    got = sorted(got, key=lambda r: (r["lang"], r["idx"], r["val"]))
    langs = sorted({r["lang"] for r in got})
    if len(langs) < 2:
        return Model(langs)
    x = np.zeros((len(got), FEATURES + 1), np.float32)  # at most SAMPLE_ROWS rows, 33 MB
    x[:, -1] = 1
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["idx"], np.int16)] = np.frombuffer(r["val"], np.float32)
    lang = np.array([langs.index(r["lang"]) for r in got])
    code = codewords(len(langs))
    y = code[lang].astype(np.float32)
    back = np.arange(len(got)) % 4 == 3  # held back to weigh the bits
    fitted = fit_bits(x[~back], y[~back])
    hit = (x[back] @ fitted) * y[back] > 0
    trust = np.array([(hit[lang[back] == k].sum(0) + 1) / ((lang[back] == k).sum() + 2) for k in range(len(langs))])
    trust = trust / trust.sum(1, keepdims=True) * code.shape[1]
    return Model(langs, code, fit_bits(x, y), trust.astype(np.float32))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``, ``second`` (the next language) and ``ambiguous``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # about 10 log2(languages) bits x 4096 weights
    docs, names = set_aside(docs, ())
    text_col, added = names[text_col], ("lang_pred", "score", "second", "ambiguous")
    keep = {c: names[c] for c in keep if c not in added}
    kept = list(keep.values())

    def run(batches):
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            lettered = np.asarray(batch.column("lid_lettered"))
            best, score, second, unsure = [None] * n, np.zeros(n), [None] * n, np.zeros(n, bool)
            best[:] = ["und"] * n
            if len(m.languages) == 1:
                best = [m.languages[0] if a else "und" for a in lettered]
                score = lettered.astype(float)
            elif m.languages:
                rows, xs = [], []

                def flush():
                    if not rows:
                        return
                    p = m.decode(np.stack(xs))
                    order = np.argsort(-p, axis=1, kind="stable")
                    for i, pr, o in zip(rows, p, order):
                        best[i], second[i] = m.languages[o[0]], m.languages[o[1]]
                        score[i], unsure[i] = pr[o[0]], pr[o[0]] - pr[o[1]] < AMBIGUOUS_BELOW
                    rows.clear()
                    xs.clear()

                for i, counts in row_vectors(batch.column("lid_text")):
                    if lettered[i]:
                        rows.append(i)
                        xs.append(_scaled(counts))
                        if len(rows) == 256:
                            flush()
                flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(best, pa.string()), pa.array(score, pa.float64()),
                                                   pa.array(second, pa.string()), pa.array(unsure, pa.bool_())],
                [*kept, "lang_pred", "score", "second", "ambiguous"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    schema = StructType(docs.select(*kept).schema.fields + [
        StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("second", StringType()), StructField("ambiguous", BooleanType())])
    text = F.col(text_col).cast("string")
    feed = docs.select(*kept, text.alias("lid_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lid_lettered"))
    return feed.mapInArrow(run, schema).select(*[F.col(v).alias(k) for k, v in keep.items()], *added)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
