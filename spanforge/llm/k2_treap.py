"""Ranked lexical search over K2-treaps of the term-document grid.

Every document's terms are counted once; documents are dealt to shards of about
``SHARD_POSTINGS`` postings.  A shard is a square grid with a row for each of its terms (frequent
ones first) and a column for each of its documents (by id); a point holds the term's impact in
the document.  The grid is kept as a quadtree without pointers: four child bits a cell, and each
cell's **largest impact** as its difference from that of the cell above (none for an only child), in byte
planes.  A point is
a cell of the last level, so the tree is the index; it is written as one row a shard, for the whole
vocabulary, and serves any later items.

A search descends from the root on the paths of all rows of an item together.  What is put in
order is a range of documents with the cell of each term over it; its bound is the sum of the
terms' weights times their cells' largest impacts.  The ranges with the best bounds (up to
``AT_ONCE`` of a level) are halved next, until no bound reaches the kth score.  A range of one
document has the exact score as its bound.  The shards' results are merged per item.

An impact is ``(10**9 * tf) div (1000 * tf + 12 * m)`` with ``m = 75 + (25 * n * N) div L``; weights
``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` are applied by the search, so that the index holds nothing
that depends on the items.  Terms are told apart by 64-bit hashes.

Items are taken in blocks of ``BLOCK_TERMS`` terms, which bounds what is broadcast; a block is
released before the next one is made.

Defined cases: a null or empty text, or one of breaks only, is no document of the counts and never
found; an item without terms, or without any term of a document, has no rows; each row of
equal ids is a document of its own; null ids come last among equal scores; items of equal ids are
ranked each on its own; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_WORD, block_words, text_blocks, written

SHARD_POSTINGS = 1 << 18
BLOCK_TERMS = 500_000
AT_ONCE = 256
PLANES = 3  # bytes of a stored difference; impacts are at most 10**6
COUNTED = "n long, terms array<bigint>, tfs array<int>"
INDEX = "shard string, ids array<bigint>, terms array<bigint>, dfs array<int>, sizes array<int>, top long, masks binary, drops binary"
POP4 = np.array([bin(i).count("1") for i in range(16)], np.int64)


# ---- counting ----------------------------------------------------------------------

def _count_terms(key):
    def run(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            cut, terms, tfs = [np.zeros(1, np.int64)], [], []
            for lo, offs, data in text_blocks(batch.column("text")):
                row, _s, _e, h = block_words(offs, data, NOT_WORD, lower=True)
                size = len(offs) - 1
                n[lo:lo + size] = np.bincount(row, minlength=size)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
                terms.append(h[first].view(np.int64))
                tfs.append(np.diff(np.r_[first, len(h)]))
                cut.append(cut[-1][-1] + np.cumsum(np.bincount(row[first], minlength=size)))
            offsets = pa.array(np.concatenate(cut), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], t)) for x, t in ((terms, pa.int64()), (tfs, pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n), *lists], [key, "n", "terms", "tfs"])
    return run


def count_terms(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs`` of each row with at least one term: whole texts, A-Z lower-cased."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_count_terms("id"), f"id long, {COUNTED}").where("n > 0")


# ---- the index ---------------------------------------------------------------------

def spread_bits(x: np.ndarray) -> np.ndarray:
    """Each bit of ``x`` (below 2**31) moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


def build_tree(row: np.ndarray, col: np.ndarray, value: np.ndarray):
    """``(sizes, top, masks, drops)`` of the points: cells a level below the root, the largest
    value, child bits (two cells a byte) and differences (byte planes), top level first."""
    height = max(1, int(max(row.max(), col.max())).bit_length())
    code = (spread_bits(row) << np.uint64(1)) | spread_bits(col)
    order = np.argsort(code, kind="stable")
    code, value = code[order], value[order].astype(np.int64)
    masks, drops, sizes = [], [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        first = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        high = np.maximum.reduceat(value, first)
        masks.append(np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.int64)), first).astype(np.uint8))
        kids = np.diff(np.r_[first, len(value)])
        drops.append((np.repeat(high, kids) - value)[np.repeat(kids > 1, kids)])  # an only child's is 0
        sizes.append(len(value))
        code, value = above[first], high
    mask = np.concatenate(masks[::-1])
    mask = np.r_[mask, np.zeros(len(mask) % 2, np.uint8)]
    drop = np.concatenate(drops[::-1]).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :PLANES]
    return sizes[::-1], int(value[0]), (mask[::2] | (mask[1::2] << 4)).tobytes(), drop.T.tobytes()


class Tree:
    """The decoded levels: child bits and first child of each cell, largest values."""

    def __init__(self, sizes, top, masks, drops):
        packed = np.frombuffer(masks, np.uint8)
        mask = np.empty(2 * len(packed), np.uint8)
        mask[::2], mask[1::2] = packed & 15, packed >> 4
        planes = np.frombuffer(drops, np.uint8).reshape(PLANES, -1)
        drop = sum(planes[i].astype(np.int32) << (8 * i) for i in range(PLANES))
        self.height, self.masks, self.first, self.value = len(sizes), [], [], [np.array([top], np.int32)]
        above, at = 1, 0
        for k, n in enumerate(sizes):
            m = mask[sum(sizes[:k - 1]) + 1:][:above] if k else mask[:1]
            kids = POP4[m]
            self.masks.append(m)
            self.first.append((np.cumsum(kids) - kids).astype(np.int32))
            value, forks = np.repeat(self.value[-1], kids), np.repeat(kids > 1, kids)
            stored = int(forks.sum())
            value[forks] -= drop[at:at + stored]
            self.value.append(value)
            above, at = n, at + stored

    def halve(self, level: int, docs: np.ndarray, cells: np.ndarray, bit: np.ndarray, weight: np.ndarray):
        """The ranges below ``docs``: ``(docs, cells, bounds)``; ``cells`` is -1 where a term has none."""
        out = []
        for half in (0, 1):
            quarter = 2 * bit + half
            mask = self.masks[level][cells].astype(np.int64)
            here = (cells >= 0) & ((mask >> quarter) & 1 > 0)
            child = np.where(here, self.first[level][cells] + POP4[mask & ((1 << quarter) - 1)], -1)
            bound = np.where(here, self.value[level + 1][child], 0).astype(np.int64) @ weight
            out.append((2 * docs + half, child, bound))
        return [np.concatenate(x) for x in zip(*out)]

    def search(self, rows: np.ndarray, weight: np.ndarray, k: int):
        """``(documents, scores)`` of the ``k`` best with a score above 0, ties to the earlier document."""
        root = np.zeros((1, len(rows)), np.int64)
        pool = {0: (np.zeros(1, np.int64), root, np.array([int(weight.sum()) * int(self.value[0][0])]))}
        docs, scores, kth = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        while pool:
            level = max(pool, key=lambda x: (pool[x][2].max(), x))
            d, c, b = pool.pop(level)
            live = b >= kth
            if not live.all():
                d, c, b = d[live], c[live], b[live]
            if len(d) > AT_ONCE:
                order = np.argpartition(-b, AT_ONCE)
                rest, now = order[AT_ONCE:], order[:AT_ONCE]
                pool[level] = d[rest], c[rest], b[rest]
                d, c = d[now], c[now]
            if not len(d):
                continue
            d, c, b = self.halve(level, d, c, (rows >> (self.height - 1 - level)) & 1, weight)
            live = b >= kth
            d, c, b = d[live], c[live], b[live]
            if not len(d):
                continue
            if level + 1 < self.height:
                if level + 1 in pool:
                    d, c, b = (np.concatenate(x) for x in zip(pool[level + 1], (d, c, b)))
                pool[level + 1] = d, c, b
            else:
                docs, scores = np.concatenate([docs, d]), np.concatenate([scores, b])
                order = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[order], scores[order]
                if len(docs) == k:
                    kth = int(scores[-1])
        return docs, scores


def _index_shard(parts, documents, length):
    """The index row of some counted documents (Arrow tables)."""
    part = pa.concat_tables(parts).combine_chunks()
    part = part.take(pc.sort_indices(part, [("id", "ascending")], null_placement="at_end"))
    lists = part.column("terms").combine_chunks()
    size = np.diff(np.asarray(lists.offsets))
    term, row = np.unique(np.asarray(lists.flatten()), return_inverse=True)
    df = np.bincount(row)
    order = np.argsort(-df, kind="stable")  # frequent terms share cells with frequent ones
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    tf = np.asarray(part.column("tfs").combine_chunks().flatten()).astype(np.int64)
    n = np.asarray(part.column("n"))
    m = np.repeat(75 + (25 * n * documents) // length, size)
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
    sizes, top, masks, drops = build_tree(place[row], np.repeat(np.arange(len(size)), size), impact)
    return [part.column("id").to_pylist(), term[order].tolist(), df[order].tolist(), sizes, top, masks, drops]


def _build(documents, length):
    def run(batches):
        from pyspark import TaskContext

        parts, held, made = [], 0, 0

        def row():
            made_row = [f"{TaskContext.get().partitionId()}-{made}", *_index_shard(parts, documents, length)]
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made_row, kinds)], ["shard", "ids", "terms", "dfs", "sizes", "top", "masks", "drops"])

        for batch in batches:
            ends = np.asarray(batch.column("terms").offsets)
            lo = 0
            while lo < batch.num_rows:
                room = SHARD_POSTINGS - held
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + room, "right")) - 1)
                hi = min(hi, batch.num_rows)
                parts.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
                held += int(ends[hi] - ends[lo])
                lo = hi
                if held >= SHARD_POSTINGS or lo < batch.num_rows:
                    yield row()
                    parts, held, made = [], 0, made + 1
        if parts:
            yield row()
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """``(index, N)``: the written index, a row a shard, and the number of documents with terms."""
    counted = written(count_terms(docs, id_col, text_col), "treap-counted")
    total = counted.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    parts = max(int(total.postings // SHARD_POSTINGS) + 1, docs.sparkSession.sparkContext.defaultParallelism)
    return written(counted.coalesce(parts).mapInArrow(_build(total.docs, max(total.length, 1)), INDEX), "treap-index"), total.docs


# ---- the search --------------------------------------------------------------------

def weighed_items(index: DataFrame, documents: int, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, terms, weights`` of the items that hold a term of the index: a weight is
    the term's own times its repeats in the item."""
    counted = written(count_terms(items, id_col, text_col).withColumn("item", F.monotonically_increasing_id()), "treap-items")
    terms = counted.select("item", F.col("id").alias("item_id"), F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("item", "item_id", "t.*")
    held = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select("t.*")
    df = held.join(terms.select("terms").distinct(), "terms", "left_semi").groupBy("terms").agg(F.sum("dfs").alias("df"))
    w = F.floor(F.log((2 * F.lit(documents) + 2).cast("double") / (2 * F.col("df") + 1)) * 1000)
    rows = terms.join(df, "terms").select("item", "item_id", F.struct("terms", (w * F.col("tfs")).cast("long").alias("w")).alias("t"))
    rows = rows.groupBy("item", "item_id").agg(F.collect_list("t").alias("t"))
    return written(rows.select("item", "item_id", F.col("t.terms").alias("terms"), F.col("t.w").alias("weights")), "treap-weighed")


def _search(shared, k):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]  # noqa: B023, E731
                tree = Tree(get("sizes").values.to_numpy().tolist(), get("top").as_py(), get("masks").as_py(), get("drops").as_py())
                terms, ids = get("terms").values.to_numpy(), get("ids").values
                order = np.argsort(terms)
                known = terms[order]
                out = {"item": [], "item_id": [], "doc_id": [], "score": []}
                for item, item_id, want, weights in shared.value:
                    at = np.minimum(np.searchsorted(known, want), len(known) - 1)
                    here = (known[at] == want) & (weights > 0)
                    if here.any():
                        docs, scores = tree.search(order[at[here]], weights[here], k)
                        out["item"] += [item] * len(docs)
                        out["item_id"] += [item_id] * len(docs)
                        out["doc_id"] += ids.take(pa.array(docs)).to_pylist()
                        out["score"] += scores.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))
    return run


def search(index: DataFrame, documents: int, items: DataFrame, k: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = index.sparkSession
    rows = weighed_items(index, documents, items, id_col, text_col)
    blocks = int((rows.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS) + 1
    found = None
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast([(r.item, r.item_id, np.array(r.terms, np.int64), np.array(r.weights, np.int64)) for r in part])
        here = index.mapInArrow(_search(shared, k), "item long, item_id long, doc_id long, score long")
        here = written(here, "treap-found")
        shared.unpersist()
        found = here if found is None else found.unionByName(here)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    index, documents = build_index(docs)
    return search(index, documents, items, k)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
    c AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS length FROM d WHERE len(ts) > 0),
    p AS (SELECT r, doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY r, doc_id, n, t),
    i AS (SELECT k, item_id, t, count(*) AS times FROM (SELECT k, item_id, unnest(ts) AS t FROM (
            SELECT row_number() OVER () AS k, item_id, {_TERMS} AS ts FROM benchmark WHERE text IS NOT NULL)) GROUP BY k, item_id, t),
    w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c WHERE t IN (SELECT t FROM i) GROUP BY t),
    s AS (SELECT k, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
          FROM i JOIN w USING (t) JOIN p USING (t), c GROUP BY k, item_id, r, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) <= 20"""
