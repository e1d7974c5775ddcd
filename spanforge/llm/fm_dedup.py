"""Repeated-passage removal with compressed FM-indexes.

A window is a run of ``WINDOW`` words.  A word goes when a window that covers it also starts in
a document with a smaller id.  Documents are cut where this can matter: the least of the
4-word hashes in a window is its anchor (frequent ones, seen in several sampled documents, come
last in that order), so equal windows have equal anchors.  The windows of one anchor follow each
other; their words form a segment.  Segments whose anchor occurs in one document only are never
moved.  The others are dealt to shards by anchor; each shard builds an FM-index (suffix order
to ``DEPTH`` words, Burrows-Wheeler words in a wavelet matrix of packed bits) over its distinct
segments, and the documents' segments are streamed against it.  Backward search computes the
matching statistic of each position against the documents with smaller ids, up to the window
length: words are prepended while the suffix-array range still holds a suffix of such a document
(range minima over the owners of the suffixes).  Positions whose statistic reaches the window
length are reported.

A window gets a frequent anchor only if all its 4-word runs are frequent, as inside a passage that
very many documents share.  Frequent anchors are shared for certain and skip the grouping by
anchor.  Their segments are the same words in all these documents, and equal segments are
reduced to the smallest id before the shuffle, so a passage held by a third of the corpus leaves
few rows.  They are dealt by the anchor and the ``NEAR`` words next to it that all their windows
hold, so that a phrase in very many different texts is spread over shards.  Exact copies need no search: all their
windows start in the first copy.

Defined cases: a null or empty text has no words and the hash of the empty string; a document
shorter than a window keeps all; a null id is never smaller than another and loses nothing;
fully repeated rows are judged alike, each in its own row; texts under one id are documents of their own.  Only the named
columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import block_words, gram_hashes, mix64, text_blocks, written

WINDOW = 13
ANCHOR = 4
DEPTH = 16  # suffix order, a power of two of at least WINDOW + 1
NEAR = (WINDOW - ANCHOR) // 2 + 1  # words beside a frequent anchor that take part in the route
SHARD_WORDS = 300_000
SAMPLE = 64
FREQUENT = 1 << 19  # anchors, 4 MB


LAST = np.uint64(1 << 63)  # set in the anchors that are frequent


def anchors(row: np.ndarray, h: np.ndarray, frequent: np.ndarray):
    """Anchor of every window: ``(index of the window's first word, index of its anchor, hash)``."""
    n = len(h)
    if n < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    g = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    at, hashes = gram_hashes(row, h, ANCHOR)
    hashes >>= np.uint64(1)
    g[at] = np.where(_member(frequent, hashes), hashes | LAST, hashes)
    first = np.flatnonzero(row[:n - WINDOW + 1] == row[WINDOW - 1:])
    span = WINDOW - ANCHOR + 1
    low, where = g[first].copy(), first.copy()
    for j in range(1, span):
        less = g[first + j] < low
        low[less] = g[first + j][less]
        where[less] = (first + j)[less]
    return first, where, low


def _row_words(offs, data):
    row, s, e, h = block_words(offs, data)
    return row, h, np.searchsorted(row, np.arange(len(offs)))


def _member(sorted_values, x):
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _sampled(batches):
    for batch in batches:
        for _lo, offs, data in text_blocks(batch.column(0)):
            row, h, _cut = _row_words(offs, data)
            at, g = gram_hashes(row, h, ANCHOR)
            order = np.lexsort((g, row[at]))
            r, g = row[at][order], g[order] >> np.uint64(1)
            new = np.ones(len(g), bool)  # one row per document and run
            new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(g[new].view(np.int64))], ["a"])


def frequent_anchors(rows: DataFrame) -> np.ndarray:
    some = rows.where(F.pmod(F.xxhash64("fm_id", F.lit(13)), F.lit(SAMPLE)) == 0).groupBy("fm_id").agg(F.min("fm_text").alias("t")).select("t")
    n = some.mapInArrow(_sampled, "a long").groupBy("a").agg(F.count("*").alias("n")).where("n >= 3")
    return np.sort(np.asarray(n.orderBy(F.desc("n"), "a").limit(FREQUENT).toArrow()["a"]).astype(np.int64).view(np.uint64))


def _runs(offs, data, freq):
    """Runs of windows with one anchor: ``(words' codes, rows' bounds, row, first, last, anchor, route)``.

    Windows of a frequent anchor with ``NEAR`` or more words before it are one run, routed by these
    words and the anchor; those with fewer are another, routed by the anchor and the words after it."""
    row, h, cut = _row_words(offs, data)
    first, where, low = anchors(row, h, freq)
    heavy, before = low >= LAST, where - first >= NEAR
    new = np.ones(len(first), bool)
    new[1:] = (where[1:] != where[:-1]) | (first[1:] != first[:-1] + 1) | (heavy[1:] & (before[1:] != before[:-1]))
    at = np.flatnonzero(new)
    last = first[np.append(at[1:], len(first)) - 1] if len(first) else first
    wide = np.zeros(len(h), np.uint64)
    start, g = gram_hashes(row, h, ANCHOR + NEAR)
    wide[start] = g
    route = low[at].copy()
    far = heavy[at]
    route[far] = wide[(where - NEAR * before)[at][far]]
    return (h >> np.uint64(32)).astype(np.uint32), cut, row[first[at]], first[at], last, low[at], route


def _anchor_rows(shared):
    """``(anchor, key of id and text)`` of the anchors that are not frequent."""
    def run(batches):
        freq = shared.value
        for batch in batches:
            keys = np.asarray(batch.column("fm_key"))
            for lo, offs, data in text_blocks(batch.column("fm_text")):
                _code, _cut, row, _first, _last, low, _route = _runs(offs, data, freq)
                light = low < LAST
                yield pa.RecordBatch.from_arrays([pa.array(low[light].view(np.int64)), pa.array(keys[lo + row[light]].astype(np.int64))], ["a", "key"])
    return run


def _mark(row, anchor):
    return mix64(anchor ^ mix64(row.astype(np.uint64)))


def _segments(shared):
    """Segments of each document with a shared or frequent anchor."""
    def run(batches):
        freq = shared.value
        for batch in batches:
            ids, keys, spots = np.asarray(batch.column("fm_id")), np.asarray(batch.column("fm_key")), batch.column("spots").fill_null([])
            for lo, offs, data in text_blocks(batch.column("fm_text")):
                code, cut, row, first, last, low, route = _runs(offs, data, freq)
                mine = spots.slice(lo, len(offs) - 1)
                known = np.repeat(np.arange(len(mine)), mine.value_lengths().to_numpy())
                # a mark that agrees by accident only adds a segment
                marks = np.sort(_mark(known, mine.flatten().to_numpy().view(np.uint64)))
                keep = (low >= LAST) | _member(marks, _mark(row, low))
                row, first, size, route = row[keep], first[keep], last[keep] - first[keep] + WINDOW, route[keep]
                end = np.cumsum(size)
                words = code[np.arange(int(end[-1]) if len(end) else 0) - np.repeat(end - size - first, size)]
                bounds = np.concatenate(([0], 4 * end)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route.view(np.int64)), pa.array(ids[lo + row].astype(np.int64)), pa.array(keys[lo + row].astype(np.int64)), pa.array((first - cut[row]).astype(np.int32)),
                     pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(words.tobytes())])],
                    ["route", "id", "key", "start", "words"])
    return run


class WaveletMatrix:
    """Ranks over a sequence of small integers, one packed bit vector per bit."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels, n = [], len(seq)
        for b in range(bits - 1, -1, -1):
            bit = ((seq >> b) & 1).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(-n % 64 + 64, bool)]), bitorder="little").view(np.uint64)
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(packed)))).astype(np.int64)
            self.levels.append((b, packed, ones, int(n - bit.sum())))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` ends when followed down the branch of ``symbol``."""
        for b, packed, ones, zeros in self.levels:
            word = i >> 6
            mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            one = ones[word] + np.bitwise_count(packed[word] & mask)
            i = np.where((symbol >> b) & 1, zeros + one, i - one)
        return i


class FMIndex:
    """Backward search over a text of integers (0 separates); suffixes ordered to ``DEPTH``."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while step < DEPTH:
            nxt = np.zeros(n, np.int64)
            nxt[:n - step] = rank[step:]
            _, rank = np.unique(rank * (int(rank.max()) + 1) + nxt, return_inverse=True)
            rank = rank + 1
            step *= 2
        self.sa = np.argsort(rank, kind="stable")
        top = int(text.max())
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.tree = WaveletMatrix(text[self.sa - 1], max(1, top.bit_length()))
        symbols = np.arange(top + 1)
        self.base = self.tree.place(symbols, np.zeros(top + 1, np.int64))
        self.n = n

    def step(self, symbol, lo, hi):
        """Suffix range of ``symbol`` followed by what the range matched so far."""
        shift = self.before[symbol] - self.base[symbol]
        return self.tree.place(symbol, lo) + shift, self.tree.place(symbol, hi) + shift

    def ranges(self, text: np.ndarray, first: np.ndarray, length: int, holds=None):
        """Suffix ranges and matching statistics (up to ``length``) ending ``length`` words
        after each ``first``: words are prepended while the range stays nonempty and
        ``holds(places in first, lo, hi)`` is true of it."""
        lo, hi = np.zeros(len(first), np.int64), np.full(len(first), self.n, np.int64)
        match = np.zeros(len(first), np.int64)
        at = np.arange(len(first))
        for t in range(length - 1, -1, -1):
            a, b = self.step(text[first[at] + t], lo[at], hi[at])
            alive = a < b
            at, a, b = at[alive], a[alive], b[alive]
            if holds is not None:
                alive = holds(at, a, b)
                at, a, b = at[alive], a[alive], b[alive]
            lo[at], hi[at] = a, b
            match[at] += 1
        return lo, hi, match


class RangeMinima:
    """Minima of any nonempty range of an array, from minima of runs of each power of two."""

    def __init__(self, x: np.ndarray):
        self.runs = [x]
        while 2 << (len(self.runs) - 1) <= len(x):
            half, r = 1 << (len(self.runs) - 1), self.runs[-1]
            self.runs.append(np.minimum(r[:-half], r[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.runs[0].dtype)
        for v in np.unique(level):
            at = np.flatnonzero(level == v)
            out[at] = np.minimum(self.runs[v][lo[at]], self.runs[v][hi[at] - (1 << int(v))])
        return out


def matching_statistics(words: list[np.ndarray], ids: np.ndarray) -> list[np.ndarray]:
    """For each segment, of each of its windows the number of last words (up to ``WINDOW``) that
    stand in a row in a segment with a smaller id."""
    size = np.array([len(w) for w in words])
    _, local = np.unique(np.concatenate(words), return_inverse=True)
    stride = size + 1
    begin = np.cumsum(stride) - stride
    text = np.zeros(int(stride.sum()), np.int64)
    owner = np.repeat(np.arange(len(words)), stride)
    text[np.arange(len(text)) - begin[owner] < size[owner]] = local + 1
    index = FMIndex(text)
    age = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    owners = RangeMinima(age[owner[index.sa]])
    windows = np.maximum(size - WINDOW + 1, 0)
    seg = np.repeat(np.arange(len(words)), windows)
    first = begin[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
    own = age[seg]
    _lo, _hi, match = index.ranges(text, first, WINDOW, lambda at, lo, hi: owners.least(lo, hi) < own[at])
    return np.split(match, np.cumsum(windows)[:-1])


def _shard(table: pa.Table) -> pa.Table:
    """Places of the repeated windows of each segment; segments of one document that hold none go."""
    words = [np.frombuffer(x.as_py(), np.uint32) for x in table["words"]]
    found = [np.flatnonzero(m == WINDOW) for m in matching_statistics(words, table["least"].to_numpy())]
    out = table.select(["route", "same", "least"]).append_column("found", pa.array(found, pa.list_(pa.int32())))
    return out.filter(pa.array(np.array([len(f) > 0 for f in found]) | (table["docs"].to_numpy() > 1)))


def _cut(keep_text):
    def run(batches):
        for batch in batches:
            out = []
            for text, copy, starts in zip(batch.column("fm_text"), batch.column("fm_copy"), batch.column("fm_starts")):
                words = text.as_py().encode("utf-8").split()  # ASCII white space, as in the pattern
                n, gone = len(words), 0
                if copy.as_py() and n >= WINDOW:
                    words, gone = [], n
                elif (at := starts.as_py()):
                    drop = np.zeros(n + 1, np.int64)
                    at = np.unique(at)
                    drop[at] += 1
                    np.subtract.at(drop, at + WINDOW, 1)
                    drop = np.cumsum(drop)[:n] > 0
                    gone = int(drop.sum())
                    words = [w for w, d in zip(words, drop) if not d]
                kept = b" ".join(words)
                out.append((n, gone, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8") if keep_text else None))
            yield pa.RecordBatch.from_arrays([batch.column("fm_id")] + [pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["fm_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256, kept`` per row (``kept``: the text left, if asked)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("fm_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("fm_text"))
    # inside, a document is an id with one text, so that nothing found in one text is cut from another
    rows = rows.withColumn("fm_key", F.when(F.col("fm_id").isNotNull(), F.xxhash64("fm_id", F.md5("fm_text"))))
    known = rows.where("fm_id IS NOT NULL")
    shared = spark.sparkContext.broadcast(frequent_anchors(known))

    # exact copies of a text with a smaller id
    hashed = known.select("fm_id", "fm_key", F.md5("fm_text").alias("h"))
    firsts = hashed.groupBy("h").agg(F.min("fm_id").alias("low"), F.max("fm_id").alias("high")).where("low < high").select("h", "low")
    # written: the join then has an exchange on both sides, and a hot text's can be split
    copies = written(hashed.join(written(firsts, "firsts"), "h").where("fm_id > low").select("fm_key").distinct(), "copies")

    # anchors that occur in several documents
    spots = known.select("fm_key", "fm_text").mapInArrow(_anchor_rows(shared), "a long, key long")
    w = W.partitionBy("a")
    both = spots.withColumns({"low": F.min("key").over(w), "high": F.max("key").over(w)}).where("low < high")
    spots = both.groupBy("key").agg(F.collect_set("a").alias("spots"))
    # merge joins at every size: the text is dealt by id once, whatever the other side's size
    feed = known.join(spots.withColumnRenamed("key", "fm_key").hint("merge"), "fm_key", "left").join(copies.hint("merge"), "fm_key", "left_anti")
    segments = feed.mapInArrow(_segments(shared), "route long, id long, key long, start int, words binary")
    segments = written(segments.withColumn("same", F.xxhash64("words")), "segments")

    total = segments.agg(F.sum(F.length("words") / 4).alias("w")).first().w or 0
    shards = int(total // SHARD_WORDS) + 1
    texts = segments.groupBy("route", "same", "words").agg(F.min("id").alias("least"), F.count("*").alias("docs"))
    found = texts.groupBy(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard")).applyInArrow(_shard, "route long, same long, least long, found array<int>")
    # route and a hash of the words stand for the words; within one anchor that is 64 bits more.
    # What the segment's first document holds, all later ones repeat whole
    at = F.when(F.col("id") > F.col("least"), F.expr(f"sequence(start, start + size - {WINDOW})")).otherwise(F.expr("transform(found, j -> start + j)"))
    hits = segments.select("route", "same", "id", "key", "start", F.expr("int(length(words) / 4)").alias("size")).join(found, ["route", "same"])
    hits = hits.select("key", at.alias("at")).where("size(at) > 0")
    starts = hits.groupBy("key").agg(F.flatten(F.collect_list("at")).alias("fm_starts"))
    feed = rows.join(starts.withColumnRenamed("key", "fm_key").hint("merge"), "fm_key", "left").join(copies.withColumn("fm_copy", F.lit(True)).hint("merge"), "fm_key", "left")
    feed = feed.select("fm_id", "fm_text", F.coalesce("fm_copy", F.lit(False)).alias("fm_copy"), "fm_starts")
    out = feed.mapInArrow(_cut(keep_text), "fm_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumnRenamed("fm_id", id_col)
