"""Cross-entropy difference of two matched n-gram language models.

The target model is counted on the documents marked as target, the background model on all
documents.  Both are word n-gram models of the same order and smoothing over one vocabulary (the
words of all documents), and the background's counts are scaled to the target's number of words,
so the models are matched in size without leaving any document out of the counts.  A document is
scored as if it were in neither model: its own n-grams are taken off the counts of the background
and, if it is marked, of the target, so a marked document scores like an unmarked one of its kind.
Every document gets both per-word losses and their difference (below 0: closer to the target).

Words are runs of letters and digits, A-Z folded; ideographs and kana are words of their own.
N-grams are told apart by 64-bit hashes.  Every run of 1 to ``order`` words has an exact count over
all documents; the tables grow with the corpus and are never gathered or broadcast.  Documents are
dealt to blocks of about ``BLOCK`` bytes.  A block counts its n-grams and sends each once, to the
bucket that owns its range of hashes; the bucket adds up what the blocks counted and returns the
sums, in the order asked; a block then scores its documents with the counts of just the n-grams
it holds.  Buckets are a fixed multiple of the blocks, so either has a bounded size at any corpus size.  An
id with more than ``BLOCK`` bytes of text is dealt to several blocks, by text.

Defined cases: a null or empty text, or one without a word, has 0 tokens and null losses; a document
without a label, or with a null one, is background only; several labels of one document count as
one (target if any is); each of several equal rows is scored with the others in the counts; with no
target document the target model is the uniform prior and the background is not scaled; an empty
table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WORD, block_words, gram_hashes, text_blocks, written

ORDER = 2
PRIOR = 6.0  # pseudo-count given to the lower order
BLOCK = 1 << 24
MERGE = 1 << 20  # counted n-grams held by a block before equal ones are added up
SHARE = 1  # every word is counted for the vocabulary's size (tests set it)
IDEOGRAPH = np.zeros(256, bool)
IDEOGRAPH[0xE3:0xEA] = True  # lead bytes of U+3000 to U+9FFF


def words(offs: np.ndarray, data: np.ndarray):
    """``(row, hash)`` of the words of a text block."""
    row, _start, _end, h = block_words(offs, data, NOT_WORD, lower=True, alone=IDEOGRAPH)
    return row, h


def _sizes(batches):
    """Bytes and words of each row; the last row of a text block lists the block's distinct words."""
    for batch in batches:
        n, distinct = np.zeros(batch.num_rows, np.int64), [[]] * batch.num_rows
        for lo, offs, data in text_blocks(batch.column("text")):
            row, h = words(offs, data)
            n[lo:lo + len(offs) - 1] += np.bincount(row, minlength=len(offs) - 1)
            distinct[lo + len(offs) - 2] = np.unique(gram_hashes(row, h, 1)[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("b"), pa.array(n), pa.array(distinct, pa.list_(pa.int64()))], ["id", "b", "n", "words"])


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes, as many as the largest needs; their number is the first byte."""
    planes = (int(x.max()).bit_length() + 7) // 8 or 1
    return bytes([planes]) + np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T[:planes]).tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    planes = np.frombuffer(x, np.uint8, offset=1).reshape(x[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :x[0]] = planes.T
    return out.view(np.uint64).ravel()


def _width(buckets: int) -> int:
    """How many hashes a bucket owns."""
    return (2**64 - 1) // buckets + 1


def _added(parts):
    """Sorted distinct n-grams of ``parts`` (n-grams, counts in all, in target) and their sums."""
    gram, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return gram, *(np.bincount(inv, np.concatenate([p[k] for p in parts]), len(gram)).astype(np.int64) for k in (1, 2))


def _marked(docs: pa.Table, marks) -> np.ndarray:
    return np.isin(docs["id"].fill_null(0).to_numpy(), marks) & ~np.asarray(docs["id"].is_null())


def _held(docs: pa.Table, target: np.ndarray, order: int):
    """The distinct n-grams of a block, sorted, and how often they occur, in all and in target."""
    none = np.zeros(0, np.int64)
    parts, held = [(none.astype(np.uint64), none, none)], 0
    for lo, offs, data in text_blocks(docs["text"]):
        row, h = words(offs, data)
        for k in range(1, order + 1):
            at, gram = gram_hashes(row, h, k)
            key, inv = np.unique(gram, return_inverse=True)
            parts.append((key, np.bincount(inv, minlength=len(key)), np.bincount(inv, target[lo + row[at]], len(key))))
            held += len(key)
        if held > MERGE:
            parts, held = [_added(parts)], 0
    return _added(parts)


def _counted(buckets, order):
    """One row per bucket of a block: its n-grams and how often they occur, in all and in target."""
    width = _width(buckets)

    def run(block, docs, marks):
        gram, n, t = _held(docs, _marked(docs, marks["mark"].to_numpy()), order)
        bucket = (gram // np.uint64(width)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows = []
        for a, b in zip(cut, [*cut[1:], len(gram)]):
            step = np.diff(gram[a:b], prepend=np.uint64(int(bucket[a]) * width))
            rows.append((int(bucket[a]), block[0].as_py(), _packed(step), _packed(n[a:b]), _packed(t[a:b])))
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "block", "step", "n", "t"])
    return run


def _summed(buckets):
    """Of one bucket, for each block that asked: the counts of the whole corpus, in the order asked."""
    def run(rows: pa.Table) -> pa.Table:
        asked = [np.cumsum(_unpacked(x), dtype=np.uint64) + np.uint64(k * _width(buckets))
                 for k, x in zip(rows["bucket"].to_pylist(), rows["step"].to_pylist())]
        gram, n, t = _added([(g, _unpacked(n), _unpacked(t)) for g, n, t in zip(asked, rows["n"].to_pylist(), rows["t"].to_pylist())])
        at = [np.searchsorted(gram, g) for g in asked]
        counts = (pa.array([_packed(c[x]) for x in at], pa.binary()) for c in (n, t))
        return pa.table([rows["block"], rows["bucket"], *counts], ["block", "bucket", "n", "t"])
    return run


def losses(counts: list, place: list, row: np.ndarray, totals: np.ndarray, vocabulary: int) -> np.ndarray:
    """Minus log probability of each word under one model, orders mixed by Dirichlet priors.

    ``counts`` has, for each order, the counts of the n-grams that begin at the words ``place``;
    ``totals`` the model's words for each row.  The shortest order is smoothed by one count a word."""
    p = (counts[0] + 1) / (totals[row] + vocabulary)
    context = counts[0]
    for k in range(2, len(counts) + 1):
        at, seen = place[k - 1], counts[k - 1]
        p[at + k - 1] = (seen + PRIOR * p[at + k - 1]) / (context[at] + PRIOR)
        context = np.zeros(len(row))
        context[at] = seen
    return -np.log(p)


def _scored(total, total_target, vocabulary, order, id_col):
    scale = total_target / total if total_target else 1.0

    def run(docs, table):
        rows = len(docs)
        marked = _marked(docs, table["mark"].drop_null().to_numpy())
        table = table.filter(table["bucket"].is_valid()).sort_by("bucket")
        size, lt, lb = (np.zeros(rows) for _ in range(3))
        gram = _held(docs, marked, order)[0]  # as the block asked for them
        in_all, in_target = (np.concatenate([np.zeros(0), *(_unpacked(x) for x in table[c].to_pylist())]).astype(np.float64) for c in ("n", "t"))
        if len(gram) != len(in_all):
            raise ValueError(f"a block of {len(gram)} n-grams got {len(in_all)} counts")
        for lo, offs, data in text_blocks(docs["text"]):
            row, h = words(offs, data)
            if not len(h):
                continue
            place, background, target = [], [], []
            part = slice(lo, lo + len(offs) - 1)
            for k in range(1, order + 1):
                at, own_gram = gram_hashes(row, h, k)
                distinct, inv = np.unique(own_gram, return_inverse=True)
                _pair, back, times = np.unique(row[at] * len(distinct) + inv, return_inverse=True, return_counts=True)
                own, found = times[back], np.searchsorted(gram, distinct)[inv]
                place.append(at)
                background.append((in_all[found] - own) * scale)
                target.append(in_target[found] - own * marked[part][row[at]])
            n = np.bincount(row, minlength=len(offs) - 1)
            size[part] = n
            lb[part] = np.bincount(row, losses(background, place, row, (total - n) * scale, vocabulary), len(offs) - 1)
            lt[part] = np.bincount(row, losses(target, place, row, total_target - n * marked[part], vocabulary), len(offs) - 1)
        none, n = size == 0, np.maximum(size, 1)
        return pa.table([docs["id"], pa.array(size.astype(np.int64)), pa.array(lt / n, mask=none), pa.array(lb / n, mask=none), pa.array((lt - lb) / n, mask=none)],
                        [id_col, "n_tokens", "loss_target", "loss_background", "xent_diff"])
    return run


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, target: Column, id_col: str = "doc_id",
                             text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``id_col, n_tokens, loss_target, loss_background, xent_diff`` for every row: counts both
    models (target: documents with a label row where ``target`` holds) and scores all."""
    marked = labels.where(target).select(F.col(id_col).cast("long").alias("mark")).where("mark IS NOT NULL").distinct()
    marked = written(marked, "lm-target")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sizes = rows.select("id", F.octet_length("text").cast("long").alias("b"), "text").mapInArrow(_sizes, "id long, b long, n long, words array<long>")
    sizes = written(sizes, "lm-sizes")
    total = lambda c, when=F.lit(True): F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    totals = sizes.select("id", "b", "n").join(marked.hint("merge"), F.col("id") == F.col("mark"), "left").agg(
        total("b").alias("b"), total("n").alias("n"), total("n", F.col("mark").isNotNull()).alias("t")).first()
    vocabulary = sizes.select(F.explode("words").alias("word")).distinct().count() + 1  # one for a word never seen
    blocks = int(totals.b // BLOCK) + 1
    buckets = 4 * blocks  # small ones: all that a bucket got is unpacked at once
    # an id has more bytes than a block at most once a block, so this table is bounded by their number
    heavy = written(sizes.where("id IS NOT NULL").groupBy(F.col("id").alias("heavy")).agg(F.ceil(F.sum("b") / BLOCK).alias("parts")).where("parts > 1"), "lm-heavy")
    deal = lambda c, part: F.pmod(F.pmod(F.xxhash64(c), F.lit(blocks)) + part, F.lit(blocks)).cast("long")
    # a document and its mark meet in one block; rows without an id are dealt by their text
    spread = F.pmod(F.xxhash64("text"), F.coalesce("parts", F.lit(1)))
    rows = rows.join(F.broadcast(heavy), F.col("id") == F.col("heavy"), "left").select(
        F.when(F.col("id").isNotNull(), deal("id", spread)).otherwise(deal("text", F.lit(0))).alias("block"), "id", "text")
    marks = marked.join(F.broadcast(heavy), F.col("mark") == F.col("heavy"), "left").select(
        "mark", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part")).select(deal("mark", F.col("part")).alias("block"), "mark").distinct()
    # both uses of the dealt text are in one plan, so that it is shuffled once
    text = rows.groupBy("block")
    counted = text.cogroup(marks.groupBy("block")).applyInArrow(_counted(buckets, order), "bucket long, block long, step binary, n binary, t binary")
    table = counted.groupBy("bucket").applyInArrow(_summed(buckets), "block long, bucket long, n binary, t binary")
    table = table.withColumn("mark", F.lit(None).cast("long")).unionByName(marks, allowMissingColumns=True)
    return text.cogroup(table.groupBy("block")).applyInArrow(
        _scored(totals.n, totals.t, vocabulary, order, id_col), f"{id_col} long, n_tokens long, loss_target double, loss_background double, xent_diff double")
