"""Exact similarity join of n-gram sets in the Jaccard metric space.

The distance is 1 - |x & y| / |x | y|, a metric.  Almost all documents are at distance 1 from
almost all others, so a fixed set of pivots would not divide the space.  Pivots are therefore
elected where documents lie close: of the documents that share one of the first shingles of
their sets (in one global order, frequent shingles last; two sets within the radius always
share one) the smallest id is pivot, and the others join its region.  A document thus lies in
the few regions whose pivots it is near to.  Regions are cut into blocks of neighbouring set
sizes; only block pairs whose sizes the radius allows are joined.  A first look uses counts: how
many of a set's shingles fall in each hash class, its overlap with that many pivot sets that
divide all shingles.  There is about one class (one byte) per ``PER_CLASS`` shingles.  Their L1
distance never exceeds |x ^ y|, so pairs beyond the bound are out, and only documents with a
possible partner have their sets moved, once, to the group they are connected with.  Inside a
group of three or more, pivots create Voronoi regions, documents within the triangle-inequality window
``d(y, q) <= d(y, home) + 2 radius`` are replicated, and regions are joined recursively, down to
exact comparison.

Equal sets are first reduced to one representative; links come back as forests (never all pairs
of a group), and components are found on these.

Defined cases: a document with fewer words than ``k`` has its whole word sequence as its only
shingle; without words or text the set is empty and links with nothing; rows with a null id get
a null component; rows with equal ids are one node.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import block_words, gram_hashes, mix64, text_blocks, written
from .graph import components

# Shingles of one block of a region (a document counts as 512 at least); a job holds two blocks.
BLOCK_SHINGLES = 1 << 19
PER_CLASS = 16
MIN_CLASSES, MAX_CLASSES = 64, 4096
LEAF = 2         # documents joined without pivots
WIDE = 48        # windows up to this size are not divided again
PIVOTS = 8       # pivots of one step of the recursion, at most; two at least
SPREAD = 4       # documents to a pivot in smaller groups
# The order's frequent shingles: counted in one of SAMPLE documents.  The order decides only
# how much work there is; any order gives the same links.
SAMPLE = 64
FREQUENT = 1 << 19


def shingle_rows(offs: np.ndarray, data: np.ndarray, k: int):
    """Distinct shingles of every row of a block, sorted by row and hash: ``(row, hash)``."""
    row, _s, _e, h = block_words(offs, data, lower=True)
    n_words = np.bincount(row, minlength=len(offs) - 1)
    at, g = gram_hashes(row, h, k)
    rows, hashes = [row[at]], [g]
    for m in range(1, k):  # short rows: the whole sequence is the only shingle
        at, g = gram_hashes(row, h, m)
        r = row[at]
        short = n_words[r] == m
        rows.append(r[short])
        hashes.append(mix64(g[short] + np.uint64(m)))
    row, g = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
    return row[new], g[new]


def _sampled(k):
    def run(batches):
        for batch in batches:
            for _lo, offs, data in text_blocks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_rows(offs, data, k)[1].view(np.int64))], ["s"])
    return run


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles in several sampled documents, rarest first; at most ``FREQUENT`` (4 MB)."""
    text = docs.where(F.pmod(F.xxhash64("jm_id", F.lit(11)), F.lit(SAMPLE)) == 0).select(F.col("jm_text"))
    n = text.mapInArrow(_sampled(k), "s long").groupBy("s").agg(F.count("*").alias("n")).where("n >= 3")
    top = n.orderBy(F.desc("n"), "s").limit(FREQUENT).toArrow()
    return np.asarray(top["s"]).astype(np.int64).view(np.uint64)[::-1]


def n_classes(n: np.ndarray) -> np.ndarray:
    """Hash classes of a set of ``n`` shingles: a power of two near ``n / PER_CLASS``."""
    bits = np.ceil(np.log2(np.maximum(n, 1) / PER_CLASS)).astype(np.int64)
    return np.clip(np.int64(1) << np.maximum(bits, 0), MIN_CLASSES, MAX_CLASSES)


def _profiles(k, num, den, shared):
    def run(batches):
        freq = shared.value
        by_hash = np.argsort(freq)
        known = freq[by_hash]
        for batch in batches:
            ids = batch.column("jm_id")
            for lo, offs, data in text_blocks(batch.column("jm_text")):
                rows = len(offs) - 1
                row, g = shingle_rows(offs, data, k)
                n = np.bincount(row, minlength=rows)
                sig = np.zeros((rows, 2), np.uint64)
                used = np.flatnonzero(n)
                first = (np.cumsum(n) - n)[used]
                if len(used):
                    sig[used, 0] = np.add.reduceat(mix64(g), first)
                    sig[used, 1] = np.add.reduceat(mix64(g ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                width = n_classes(n)
                edge = np.concatenate(([0], np.cumsum(width)))
                cls = (g >> np.uint64(32)).astype(np.int64) & (width[row] - 1)
                counts = np.minimum(np.bincount(edge[row] + cls, minlength=edge[-1]), 255).astype(np.uint8)
                late = np.zeros(len(g), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    late = np.where(known[at] == g, by_hash[at] + 1, 0)
                    order = np.lexsort((g, late, row))
                    row, g = row[order], g[order]
                length = np.where(n > 0, n - -(-n * num // den) + 1, 0)
                place = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
                prefix = g[place < length[row]].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, rows), batch.column("jm_doc").slice(lo, rows), pa.array(n.astype(np.int64)),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), rows, [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32)), pa.array(prefix)),
                     pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(counts.tobytes())])],
                    ["id", "doc", "n", "sig", "prefix", "classes"])
    return run


def _sets(k):
    """One row per job of each document, with its sorted set as bytes."""
    def run(batches):
        for batch in batches:
            jobs, ids = batch.column("jobs"), batch.column("jm_id")
            for lo, offs, data in text_blocks(batch.column("jm_text")):
                row, g = shingle_rows(offs, data, k)
                cut = np.searchsorted(row, np.arange(len(offs)))
                out = []
                for i in range(len(offs) - 1):
                    raw = g[cut[i]:cut[i + 1]].tobytes()
                    out += [(*j.values(), ids[lo + i].as_py(), raw) for j in jobs[lo + i].as_py()]
                for at in range(0, len(out), 512):
                    cols = list(zip(*out[at:at + 512]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                                                     [*JOB, "id", "s"])
    return run


class Links:
    """Union-find over the documents of one job."""

    def __init__(self, n):
        self.parent = list(range(n))

    def root(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _close(inter, na, nb, num, den):
    return den * inter >= num * (na + nb - inter)


def _direct(sets, left, right, num, den, links):
    """Exact comparison of every document of ``left`` with every one of ``right``."""
    pool = np.union1d(left, right)
    cat = np.concatenate([sets[i] for i in pool])
    owner = np.repeat(np.arange(len(pool)), [len(sets[i]) for i in pool])
    words, inv, df = np.unique(cat, return_inverse=True, return_counts=True)
    col = np.cumsum(df > 1) - 1
    keep = df[inv] > 1  # a shingle of one document is in no intersection
    owner, inv = owner[keep], col[inv[keep]]
    width = int((df > 1).sum())
    at_r = np.searchsorted(pool, right)
    size = np.array([len(sets[i]) for i in pool])
    for lo in range(0, len(left), 256):
        at_l = np.searchsorted(pool, left[lo:lo + 256])
        inter = np.zeros((len(at_l), len(at_r)), np.float32)
        for c in range(0, width, 4096):
            m = np.zeros((len(pool), min(4096, width - c)), np.float32)
            sel = (inv >= c) & (inv < c + 4096)
            m[owner[sel], inv[sel] - c] = 1
            inter += m[at_l] @ m[at_r].T
        inter = np.rint(inter).astype(np.int64)
        hit = _close(inter, size[at_l][:, None], size[at_r][None, :], num, den)
        for x, y in zip(*np.nonzero(hit)):
            links.join(int(left[lo + x]), int(right[y]))


def voronoi_regions(sets, members, num, den):
    """Regions of ``members`` (indices into ``sets``, sorted by set size): ``(core, window)``.

    A core holds the documents nearest to one pivot; its window holds every document that may
    link to one of them, the core itself and the replicated boundary documents of other cores."""
    radius = 1 - num / den
    count = min(PIVOTS, max(2, len(members) // SPREAD))
    size = np.array([len(sets[i]) for i in members])
    cat = np.concatenate([sets[i] for i in members])
    owner = np.repeat(np.arange(len(members)), size)
    pivots = members[np.linspace(0, len(members) - 1, count).astype(int)]
    dist = np.ones((len(members), count))
    for q, p in enumerate(pivots):
        s = sets[p]
        at = np.minimum(np.searchsorted(s, cat), len(s) - 1)
        inter = np.bincount(owner[s[at] == cat], minlength=len(members))
        dist[:, q] = 1 - inter / (size + len(s) - inter)
    home, near = dist.argmin(1), dist.min(1)
    for q in range(count):
        core = home == q
        if not core.any():
            continue
        window = dist[:, q] <= near + 2 * radius + 1e-9
        # sizes outside the region's range allow no link either
        window &= (size * den >= size[core].min() * num) & (size * num <= size[core].max() * den)
        yield members[core], members[window]


def join_region(sets, members, num, den, links):
    """Recursive pivot join of ``members``: a wide window that is well below them is divided
    again, otherwise the core is compared with its window."""
    if len(members) <= LEAF:
        _direct(sets, np.sort(members), np.sort(members), num, den, links)
        return
    for core, window in voronoi_regions(sets, members, num, den):
        if WIDE < len(window) <= 0.7 * len(members):
            join_region(sets, window, num, den, links)
        else:
            _direct(sets, np.sort(core), np.sort(window), num, den, links)


def region_edges(ids, sets, num, den):
    """Forest of the links among one job's documents: ``(id, smaller id of its tree)``."""
    if len(ids) == 2:
        inter = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(ids[0], ids[1])] if ids[0] != ids[1] and _close(inter, len(sets[0]), len(sets[1]), num, den) else []
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    links = Links(len(ids))
    join_region(sets, np.array(order), num, den, links)
    return [(ids[i], ids[r]) for i in range(len(ids)) if (r := links.root(i)) != i and ids[i] != ids[r]]


def possible_groups(ids, sizes, counts, num, den):
    """Groups of one job's documents that may link by the bound on the class counts: ``(root, id)``.

    ``counts`` is one array per document; a longer one is folded to the length of a shorter."""
    order = np.lexsort((ids, sizes))
    ids, sizes, counts = ids[order], sizes[order], [counts[i].astype(np.int32) for i in order]
    width = np.array([len(c) for c in counts])  # never falls, as the sizes never do
    links = Links(len(ids))
    reach = np.searchsorted(sizes * num, sizes * den, "right")  # the last size that can link
    for w in np.unique(width):
        lo = int(np.searchsorted(width, w))
        own = int(np.searchsorted(width, w, "right"))
        hi = int(reach[own - 1])
        rows = np.stack([c.reshape(-1, w).sum(0) for c in counts[lo:hi]])
        for x in range(lo, own):
            y = slice(x + 1, reach[x])
            apart = np.abs(rows[x + 1 - lo:reach[x] - lo] - rows[x - lo]).sum(1)
            # |x ^ y| is at most (den - num) / (den + num) of |x| + |y|
            for k in np.flatnonzero(apart * (den + num) <= (den - num) * (sizes[y] + sizes[x])):
                links.join(x, x + 1 + int(k))
    root = np.array([links.root(x) for x in range(len(ids))])
    several = np.bincount(root, minlength=len(ids))[root] > 1
    return list(zip(ids[root[several]].tolist(), ids[several].tolist()))


def _by_job(keys, columns, work, out_names):
    """Run ``work(job, column slices)`` on each run of rows of one job; rows come sorted by job,
    and the last job of a batch waits for the next batch."""
    def run(batches):
        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_n, t) in enumerate(out_names)], [n for n, _t in out_names])

        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            k = np.stack([t[c].to_numpy() for c in keys])
            cut = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1), t.num_rows]
            held = t.slice(cut[-2])
            yield emit([r for a, b in zip(cut[:-2], cut[1:-1]) if b - a > 1 for r in work(k[:, a], [t[c].slice(a, b - a) for c in columns])])
        if held is not None and held.num_rows > 1:
            yield emit(work([held[c][0].as_py() for c in keys], [held[c] for c in columns]))
    return run


def _look(num, den):
    def work(_job, cols):
        ids, sizes = cols[0].to_numpy(), cols[1].to_numpy()
        counts = [np.frombuffer(c, np.uint8) for c in cols[2].to_pylist()]
        return possible_groups(ids, sizes, counts, num, den)
    return _by_job(JOB, ["id", "n", "classes"], work, [("a", pa.int64()), ("b", pa.int64())])


def _join(num, den):
    def work(_job, cols):
        return region_edges(cols[0].to_pylist(), [np.frombuffer(s, np.uint64) for s in cols[1].to_pylist()], num, den)
    return _by_job(JOB, ["id", "s"], work, [("a", pa.int64()), ("b", pa.int64())])


JOB = ("p", "i", "j")  # region or group, and two of its blocks


def block_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """``(p, i, j, id, n)``: each member ``(p, id, n)`` in every block pair it takes part in.

    Blocks hold neighbouring sizes; two blocks meet if some sizes in them allow a link.  Blocks
    are laid out on the counts of a region's sizes, so the window sees one row per size, however
    many members there are; members of one size are dealt to its blocks by their id.  A member
    whose size has no other within reach has no partner and gets no block."""
    before = Window.partitionBy("p").orderBy("n")
    weight = F.greatest("n", F.lit(512))
    sizes = members.groupBy("p", "n").agg(F.count("*").alias("c"))
    sizes = sizes.withColumns({
        "fit": (F.col("c") > 1) | (F.lag("n").over(before) * den >= F.col("n") * num) | (F.col("n") * den >= F.lead("n").over(before) * num),
        "begin": F.coalesce(F.sum(weight * F.col("c")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    # written: the join then has an exchange on both sides, and a large region's can be split
    sizes = written(sizes.where("fit").drop("fit"), "sizes")
    place = F.col("begin") + F.pmod(F.xxhash64("id"), F.col("c")) * weight
    sized = members.join(sizes, ["p", "n"]).select("p", "id", "n", F.floor(place / BLOCK_SHINGLES).cast("int").alias("blk"))
    sized = written(sized, "blocks")
    blocks = sized.groupBy("p", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    pairs = blocks.alias("x").join(blocks.alias("y"), F.expr(f"x.p = y.p AND x.blk <= y.blk AND x.hi * {den} >= y.lo * {num}")).select(
        F.col("x.p").alias("p"), F.col("x.blk").alias("i"), F.col("y.blk").alias("j"))
    pairs = written(pairs.withColumn("blk", F.explode(F.array_distinct(F.array("i", "j")))), "pairs")
    return sized.join(pairs, ["p", "blk"]).select("p", "i", "j", "id", "n")


def possible_edges(reps: DataFrame, num: int, den: int) -> DataFrame:
    """Edges ``(a, b)`` that connect documents which may link, by pivot regions and class counts."""
    seen = reps.select("id", "n", F.explode("prefix").alias("s"))
    pivots = seen.groupBy("s").agg(F.min("id").alias("p"), F.max("id").alias("top")).where("p < top").select("s", "p")
    # an aggregate and a join, as one shingle may be in very many documents
    regions = seen.join(written(pivots, "pivots"), "s").groupBy("p", "id").agg(F.max("n").alias("n"))
    rows = block_pairs(written(regions, "regions"), num, den).join(reps.select("id", "classes"), "id")
    return rows.repartition(*JOB).sortWithinPartitions(*JOB).mapInArrow(_look(num, den), "a long, b long")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       num: int = 80, den: int = 100) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs``: documents link when
    ``den * |x & y| >= num * |x | y|`` on their sets of ``k``-word shingles."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("jm_doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("jm_text"))
    # inside, a node is an id with one text, so that texts under one id keep their own sizes and sets
    rows = rows.withColumn("jm_id", F.when(F.col("jm_doc").isNotNull(), F.xxhash64("jm_doc", F.md5("jm_text"))))
    shared = spark.sparkContext.broadcast(frequent_shingles(rows, k))
    prof = written(rows.mapInArrow(_profiles(k, num, den, shared), "id long, doc long, n long, sig binary, prefix array<long>, classes binary"), "profiles")
    full = prof.where("n > 0 AND id IS NOT NULL")
    first = full.groupBy("sig").agg(F.min("id").alias("rep"), F.min("doc").alias("least"))
    reps = full.join(first.select("sig", F.col("rep").alias("id")), ["sig", "id"]).select("id", "n", "prefix", "classes")
    groups = components(possible_edges(reps, num, den)).select(F.col("component").alias("p"), F.col("node").alias("id"))
    members = groups.join(reps.groupBy("id").agg(F.max("n").alias("n")), "id").select("p", "id", "n")
    jobs = block_pairs(written(members, "members"), num, den).groupBy("id").agg(F.collect_list(F.struct(*JOB)).alias("jobs"))
    sets = rows.drop("jm_doc").join(jobs.withColumnRenamed("id", "jm_id").hint("merge"), "jm_id").mapInArrow(_sets(k), "p long, i int, j int, id long, s binary")
    edges = sets.repartition(*JOB).sortWithinPartitions(*JOB).mapInArrow(_join(num, den), "a long, b long")
    # equal sets link through their representative; so do the sets of an id with several texts
    several = written(full.groupBy("doc").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("doc"), "several")
    same = written(full.join(several, "doc").select("doc", "sig").distinct().join(first, "sig").select("doc", "rep"), "same")
    same = same.join(written(same.groupBy("doc").agg(F.min("rep").alias("a")), "one"), "doc").select("a", F.col("rep").alias("b"))
    found = components(edges.unionByName(same))
    groups = written(first.join(found, first.rep == found.node, "left").select("sig", "least", F.coalesce("component", "rep").alias("of")), "groups")
    least = written(groups.groupBy("of").agg(F.min("least").alias("component")), "least")
    groups = written(groups.join(least, "of").select("sig", "component"), "components")
    out = prof.select(F.col("doc").alias("id"), "n", "sig").join(groups, "sig", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id"))
