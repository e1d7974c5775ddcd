"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An alignment counts when it keeps ``NUM / DEN`` of a perfect copy's score, so it can lose no more
than ``loss(n)`` of an item of ``n`` words.  That bounds the seeds it can miss: a single word is lost
for 2 at least (at an end; 3 inside), a pair of neighbouring words for 1 (a word put between
them).  Of single words ``loss // 2 + 1`` and of pairs ``loss + 1`` seeds, **whichever** they are, hold at
least one that the alignment keeps.  So the rarest of that many are looked up: words or pairs,
whichever the documents hold less often in all, counted over all documents first.  (Pairs of items
of up to 10 words cannot be told to survive; these use words.  Longer runs never can: one word
put in every second gap breaks them all at little cost.)

Where a seed matches, the words of the item that the passage holds at all bound the score; if the
bound reaches the threshold, the passage is aligned with the item word by word; the best local
score over the score of a perfect copy is the row's ``score``.  Edited or paraphrased copies lose
little by it.  The passage reaches as far around a seed as an alignment at the threshold can have
gaps, so what is found equals the full recurrence over the whole text.

Test items are taken in blocks of ``BLOCK_WORDS`` words, so what is broadcast and counted has a fixed
bound; documents are only read (once to count seeds, once to align), never shuffled.

Defined cases: a null or empty text holds nothing; items without words, or null, are found
nowhere; repeated items are each reported; a document without hits has an empty list; an empty
benchmark or table gives no hits.  A column named ``dc_hits`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import NOT_WORD, block_words, gram_hashes, set_aside, text_blocks

BLOCK_WORDS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1
NUM, DEN = 55, 100  # of a perfect copy's score
THRESHOLD = NUM / DEN
HITS = "array<struct<item_id:bigint,score:double,start_word:bigint,end_word:bigint>>"


def loss(n: int) -> int:
    """What an alignment of an item of ``n`` words may lose at the threshold; gaps cost 1 a word,
    so it is also the words that may be put in or left out in all."""
    return MATCH * n * (DEN - NUM) // DEN


def enough(score: int, n: int) -> bool:
    return score * DEN >= NUM * MATCH * n


class Items:
    """The test items of one block and their seeds, sorted by hash: at first all words and pairs,
    after ``choose`` the rarest that suffice."""

    def __init__(self, ids, words):
        self.ids = ids
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        self.words = [np.searchsorted(self.vocabulary, w) for w in words]  # as numbers of the vocabulary
        self.seen = np.zeros(len(self.vocabulary) + 1, bool)
        h, item, pos, size = [], [], [], []
        for k, w in enumerate(words):
            for n in (1, 2):
                at, g = seeds(np.zeros(len(w), np.int64), w, n)
                h.append(g)
                item.append(np.full(len(at), k))
                pos.append(at)
                size.append(np.full(len(at), n))
        h, item, pos, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (h, item, pos, size))
        self._keep(h.astype(np.uint64), item, pos, size)

    def _keep(self, h, item, pos, size):
        order = np.lexsort((pos, item, h))
        self.hash, self.item, self.pos, self.size = h[order], item[order], pos[order], size[order]
        self.keys = np.unique(self.hash)

    def numbered(self, h: np.ndarray) -> np.ndarray:
        """Words of a text as numbers of the vocabulary; other words get a number of their own."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, len(self.vocabulary))

    def held(self, words: np.ndarray, k: int) -> int:
        """How many words of item ``k`` a passage holds at all."""
        self.seen[words] = True
        self.seen[-1] = False
        n = int(np.count_nonzero(self.seen[self.words[k]]))
        self.seen[words] = False
        return n

    def choose(self, found: np.ndarray):
        """Keep the rarest seeds that suffice; ``found``: documents per key."""
        df = found[np.searchsorted(self.keys, self.hash)]
        take = []
        order = np.lexsort((self.pos, df, self.size, self.item))
        cut = np.searchsorted(self.item[order], np.arange(len(self.words) + 1))
        for k, w in enumerate(self.words):
            own = order[cut[k]:cut[k + 1]]
            ones, pairs = own[self.size[own] == 1][:loss(len(w)) // 2 + 1], own[self.size[own] == 2]
            if len(pairs) > loss(len(w)):
                pairs = pairs[:loss(len(w)) + 1]
                ones = min(ones, pairs, key=lambda x: df[x].sum())
            take.append(ones)
        take = np.concatenate(take) if take else np.zeros(0, np.int64)
        self._keep(self.hash[take], self.item[take], self.pos[take], self.size[take])
        return self


def seeds(row: np.ndarray, h: np.ndarray, n: int):
    """Hashes of the words or pairs of neighbouring words: ``(index of the first word, hash)``."""
    at, g = gram_hashes(row, h, n) if n > 1 else (np.arange(len(h)), h)
    return at, g


def align(doc: np.ndarray, item: np.ndarray):
    """Best local alignment: ``(score, first, last word)`` in ``doc``.

    One row per item word; gaps along the document resolve as a running maximum."""
    n = len(doc)
    step = -GAP * np.arange(n + 1)
    prev, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        diag = prev[:-1] + np.where(doc == w, MATCH, MISMATCH)
        up = prev[1:] + GAP
        cur = np.zeros(n + 1, np.int64)
        cur[1:] = np.maximum(0, np.maximum(diag, up))
        first = np.arange(n + 1)
        first[1:] = np.where(cur[1:] == 0, first[1:], np.where(diag >= up, start[:-1], start[1:]))
        lift = cur + step
        top = np.maximum.accumulate(lift)
        came = np.maximum.accumulate(np.where(lift == top, np.arange(n + 1), 0))
        moved = top - step
        first = np.where(moved > cur, first[came], first)
        prev, start = np.maximum(cur, moved), first
        j = int(prev.argmax())
        if prev[j] > best[0]:
            best = (int(prev[j]), int(start[j]), j - 1)
    return best


def _words(offs, data):
    row, _s, _e, h = block_words(offs, data, NOT_WORD, lower=True)
    return row, h


def load_items(benchmark: DataFrame, id_col: str, text_col: str):
    """Blocks of test items, each of about ``BLOCK_WORDS`` words, one at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    total = rows.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0
    blocks = int(total // BLOCK_WORDS) + 1
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        arr = pa.array([r.t for r in got], pa.string())
        words = [None] * len(got)
        for lo, offs, data in text_blocks(arr):
            row, h = _words(offs, data)
            for k, w in enumerate(np.split(h, np.searchsorted(row, np.arange(1, len(offs) - 1)))):
                words[lo + k] = w
        yield Items([r.i for r in got], words)


def _matches(items: Items, row: np.ndarray, h: np.ndarray):
    """``(word, seed)`` of every seed in a block of words, by word."""
    at, g = (np.concatenate(x) for x in zip(*[seeds(row, h, n) for n in (1, 2)]))
    if not len(items.keys) or not len(g):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hit = items.keys[np.minimum(np.searchsorted(items.keys, g), len(items.keys) - 1)] == g
    at, g = at[hit], g[hit]
    order = np.argsort(at, kind="stable")
    return at[order], g[order]


def _count(shared):
    def run(batches):
        items = shared.value
        found = np.zeros(len(items.keys), np.int64)
        for batch in batches:
            for _lo, offs, data in text_blocks(batch.column(0)):
                row, h = _words(offs, data)
                at, g = _matches(items, row, h)
                key = np.searchsorted(items.keys, g)
                once = np.unique(row[at] * np.int64(len(items.keys) or 1) + key)
                found += np.bincount(once % len(items.keys), minlength=len(found)) if len(once) else 0
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], ["seed", "n"])
    return run


def count_seeds(texts: DataFrame, items: Items) -> np.ndarray:
    """Documents that hold each key of ``items``; one row a seed and task is added up."""
    shared = texts.sparkSession.sparkContext.broadcast(items)
    rows = texts.mapInArrow(_count(shared), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    found = np.zeros(len(items.keys), np.int64)
    found[rows.column("seed").to_numpy()] = rows.column("n").to_numpy()
    return found


def document_hits(words: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, items: Items):
    """Hits of one document (words as numbers) from its seed matches: ``at`` word positions,
    ``lo:hi`` seed rows."""
    size = hi - lo
    rows = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    item, diag = items.item[rows], np.repeat(at, size) - items.pos[rows]
    order = np.lexsort((diag, item))
    item, diag = item[order], diag[order]
    far = np.array([loss(len(items.words[k])) for k in item[:-1].tolist()], np.int64)
    cut = np.flatnonzero((np.diff(item) != 0) | (np.diff(diag) > far)) + 1
    best = {}
    for a, b in zip([0, *cut], [*cut, len(item)]):
        k = int(item[a])
        w = items.words[k]
        # an alignment through a seed leaves its diagonal by no more than the reach
        g = loss(len(w))
        s, e = max(0, int(diag[a]) - g), min(len(words), int(diag[b - 1]) + len(w) + g)
        if not enough(MATCH * items.held(words[s:e], k), len(w)):  # no alignment can reach it
            continue
        score, x, y = align(words[s:e], w)
        if enough(score, len(w)) and score / (MATCH * len(w)) > best.get(k, (0,))[0]:
            best[k] = (score / (MATCH * len(w)), s + x, s + y)
    return [{"item_id": items.ids[k], "score": v[0], "start_word": v[1], "end_word": v[2]} for k, v in sorted(best.items())]


def _search(shared, columns):
    def run(batches):
        items = shared.value
        for batch in batches:
            hits = [[] for _ in range(batch.num_rows)]
            for lo, offs, data in text_blocks(batch.column("dc_text")):
                row, h = _words(offs, data)
                at, g = _matches(items, row, h)
                if not len(at):
                    continue
                h = items.numbered(h)
                left, right = np.searchsorted(items.hash, g), np.searchsorted(items.hash, g, "right")
                cut = np.searchsorted(row, np.arange(len(offs)))
                own = np.searchsorted(at, cut)
                for i in np.flatnonzero(np.diff(own)):
                    s = slice(own[i], own[i + 1])
                    hits[lo + i] = document_hits(h[cut[i]:cut[i + 1]], at[s] - cut[i], left[s], right[s], items)
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(hits, kind)], [*columns, "dc_hits"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``dc_hits``: the test items found in each text, with score and word range."""
    sc = docs.sparkSession.sparkContext
    docs, kept = set_aside(docs, ("dc_hits",))
    text_col = kept[text_col]
    columns = list(kept.values())
    out = docs.select(*columns, F.array().cast(HITS).alias("dc_hits"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    for items in load_items(benchmark, item_id_col, item_text_col):
        if not len(items.keys):
            continue
        items.choose(count_seeds(docs.select(text.alias("dc_text")), items))
        fields = docs.select(*columns).schema.fields + [StructField("dc_hits", out.schema["dc_hits"].dataType)]
        found = out.select(*columns, "dc_hits", text.alias("dc_text"))
        found = found.withColumnRenamed("dc_hits", "dc_before")
        schema = StructType(fields[:-1] + [StructField("dc_before", out.schema["dc_hits"].dataType), fields[-1]])
        found = found.mapInArrow(_search(sc.broadcast(items), [*columns, "dc_before"]), schema)
        out = found.select(*columns, F.concat("dc_before", "dc_hits").alias("dc_hits"))
    return out.select(*[F.col(v).alias(k) for k, v in kept.items()], "dc_hits")
