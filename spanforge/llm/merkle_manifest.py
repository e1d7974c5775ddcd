"""Merkle manifest of a table: one digest a row, one subroot a group, one root for all.

Rows are numbered within their group by a distributed sort.  Every aligned block of ``BLOCK``
consecutive nodes is one row that keeps each of its levels as **one hex string**: the digests side
by side, 64 characters each.  A parent is the hash of a fixed-width substring of ``ARITY``
digests, and the siblings of a node are the two substrings that flank it in that run, so a proof
is cut out of the strings and never looked up node by node.  The roots of the blocks are the nodes
of the next round (``ROUND`` levels higher) until one block a group is left; the groups' roots go
through the same rounds.  Downwards, each block receives the segments above it once, and the rows
of the block are folded in place.

A block holds ``BLOCK`` digests whatever the group's size, so a group of any size is spread over
its blocks.  No node passes the driver, only the number of blocks of a round.

Defined cases: null values, also of the id and the group, are the leaf text ``-``; null ids come first,
the null group too; rows of equal ids are ordered by their digest (rows equal in all hashed
columns are interchangeable); an empty text is ``0:``; a group of one row is its own subroot and a
single group's subroot is the root; an empty table gives no rows.  Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ARITY, ROUND, DIGEST = 8, 3, 64
BLOCK = ARITY**ROUND
RUN = ARITY * DIGEST
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENTS = "array<struct<before:string,after:string>>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as ``-`` if null, else its byte count, ``:`` and its text."""
    part = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[part(v.cast("string")) for v in values]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``: the place of each row in its ``grp`` by ``order``, from 0.

    One range sort; the places of its parts follow from one count a part and group.  Rows equal
    in ``order`` may be split between parts, so a much repeated row is no hot key."""
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]] + [F.col("salt").asc()]
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()).drop("salt")
    rows = written(rows.withColumn("part", F.shiftright("at", 33)), "merkle-sorted")
    runs = rows.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "grp", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(runs, ["part", "grp"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def parents(level: Column) -> Column:
    """The level above, as one string: the hash of each run of a level's string."""
    runs = F.ceil(F.length(level) / RUN).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (``grp, pos, node`` and what else a node carries): ``grp, block, members,
    levels, height``.  A group's only block stops at its root, others go up ``ROUND`` levels."""
    rest = [c for c in nodes.columns if c not in ("grp", "pos", "node")]
    member = F.struct((F.col("pos") % BLOCK).cast("int").alias("at"), "node", *rest)
    sizes = nodes.groupBy("grp").agg((F.max("pos") >= BLOCK).alias("many"))
    rows = nodes.groupBy("grp", F.shiftright("pos", 3 * ROUND).alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    size = F.size("members")
    height = F.when(F.col("many"), ROUND)
    for k in range(ROUND):
        height = height.when(size <= ARITY**k, k)
    rows = rows.join(sizes, "grp").withColumn("height", height.otherwise(ROUND))
    first = F.array_join(F.transform("members", lambda m: m["node"]), "")
    levels = let(first, lambda a: let(parents(a), lambda b: let(parents(b), lambda c: F.array(a, b, c, parents(c)))))
    return rows.select("grp", "block", "members", "height", levels.alias("levels"))


def segments(levels: Column, height: Column, at: Column) -> Column:
    """What flanks a node and its ancestors in their runs, level by level up to the block's root."""
    def cut(k):
        place = F.shiftright(at, 3 * k)
        run = F.substring(levels[k], F.shiftright(place, 3) * RUN + 1, F.lit(RUN))
        own = F.pmod(place, F.lit(ARITY)) * DIGEST
        return F.struct(F.substring(run, F.lit(1), own).alias("before"), F.substring(run, own + DIGEST + 1, F.lit(RUN)).alias("after"))

    return F.slice(F.array(*[cut(k) for k in range(ROUND)]), F.lit(1), height)


def grow(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of every round, written; the last round has one block a group."""
    rounds = []
    while True:
        rounds.append(written(blocks(nodes), "merkle-blocks"))
        if not rounds[-1].agg(F.max("block")).first()[0]:
            return rounds
        nodes = rounds[-1].select("grp", F.col("block").alias("pos"), F.col("levels")[F.col("height")].alias("node"))


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The blocks of the first round with ``above``: the segments over their roots.

    ``above`` has them for the groups' roots, with what else goes down: ``grp, above, ...``"""
    carried = [c for c in above.columns if c not in ("grp", "above")]
    here = rounds[-1].join(above, "grp")
    for lower in reversed(rounds[:-1]):
        path = F.concat(segments(F.col("levels"), F.col("height"), F.col("m")["at"]), F.col("above"))
        down = here.withColumn("m", F.explode("members")).select("grp", (F.col("block") * BLOCK + F.col("m")["at"]).alias("block"), path.alias("above"), *carried)
        here = lower.join(down, ["grp", "block"])
    return here


def merkle_proofs(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Roots and folded proofs of ``leaves`` (``grp``, ``node``: the row's digest, ``claim``: the
    digest to be proven, null: the same, and the columns of ``order``).

    Adds ``subroot, root, proof`` (digest of all siblings) and ``folded`` (the root that the claim
    gives with the siblings of the manifest); ``claim`` goes."""
    columns = [c for c in leaves.columns if c not in ("grp", "node", "claim")]
    keyed = leaves.withColumn("grp", F.coalesce(F.concat(F.lit("="), F.col("grp")), F.lit("-")))  # '-' sorts before '='
    tree = grow(numbered(keyed, [*order, "node"]))
    root_of = F.col("levels")[F.col("height")]
    tops = tree[-1].select("grp", root_of.alias("node"))
    top = grow(numbered(tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"), ["name"]))
    start = top[-1].select("grp", root_of.alias("root"), F.array().cast(SEGMENTS).alias("above"))
    path = F.concat(segments(F.col("levels"), F.col("height"), F.col("m")["at"]), F.col("above"))
    groups = descend(top, start).withColumn("m", F.explode("members"))
    groups = groups.select(F.col("m")["name"].alias("grp"), F.col("m")["node"].alias("subroot"), "root", path.alias("above"))
    ready = descend(tree, written(groups, "merkle-groups"))

    def proven(m):
        def of(p):
            folded = F.aggregate(p, F.coalesce(m["claim"], m["node"]), lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))
            siblings = F.array_join(F.transform(p, lambda s: F.concat(s["before"], s["after"])), "")
            return F.struct(*[m[c].alias(c) for c in columns], m["node"].alias("leaf"), F.sha2(siblings, 256).alias("proof"), folded.alias("folded"))

        return let(F.concat(segments(F.col("levels"), F.col("height"), m["at"]), F.col("above")), of)

    rows = ready.select("subroot", "root", F.explode(F.transform("members", proven)).alias("m"))
    return rows.select("m.*", "subroot", "root")


def document_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest of documents by language; where ``tampered`` holds, the proof is tried on the
    row with A-Z of its text lower-cased."""
    def digest(text):
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    claim = F.when(tampered, digest(F.translate("text", UPPER, LOWER)))
    leaves = docs.select("doc_id", F.col("lang").alias("grp"), digest(F.col("text")).alias("node"), claim.alias("claim"))
    rows = merkle_proofs(written(leaves, "merkle-leaves"), ["doc_id"])
    return rows.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
                       (F.col("folded") == F.col("root")).alias("verified"))


ORACLE = """
    WITH RECURSIVE part AS (
        SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
               list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                   lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
        FROM documents),
    leaf AS (
        SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(small) || ':' || small, '-')) END AS bad FROM part),
    spot AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
               row_number() OVER () AS r FROM leaf),
    tree AS (
        SELECT lang, 0 AS lvl, pos, leaf AS h, n FROM spot
        UNION ALL
        SELECT lang, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 8, n),
    sub AS (SELECT lang, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
    top AS (
        SELECT 0 AS lvl, pos, subroot AS h, n FROM sub
        UNION ALL
        SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n),
    node AS (  -- every node that has a parent, levels of the groups first, then those of the top
        SELECT lang, lvl, pos, h, true AS low FROM tree WHERE n > 1
        UNION ALL SELECT NULL, lvl, pos, h, false FROM top WHERE n > 1),
    flank AS (
        SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
               coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
        FROM node WINDOW w AS (PARTITION BY low, lang, lvl, pos // 8 ORDER BY pos)),
    fold AS (
        SELECT s.r, s.lang, s.pos, 0 AS step, coalesce(s.bad, s.leaf) AS acc, '' AS seen, u.height, u.pos AS upos FROM spot s JOIN sub u ON s.lang IS NOT DISTINCT FROM u.lang
        UNION ALL
        SELECT o.r, o.lang, CASE WHEN o.step + 1 = o.height THEN o.upos ELSE o.pos // 8 END, o.step + 1, sha256(f.before || o.acc || f.after),
               o.seen || f.before || f.after, o.height, o.upos
        FROM (SELECT r, lang, step, acc, seen, height, upos, CASE WHEN step = height THEN upos ELSE pos END AS pos FROM fold) o
        JOIN flank f ON f.pos = o.pos AND CASE WHEN o.step < o.height THEN f.low AND f.lvl = o.step AND f.lang IS NOT DISTINCT FROM o.lang
                                          ELSE NOT f.low AND f.lvl = o.step - o.height END),
    done AS (SELECT r, max_by(acc, step) AS folded_root, sha256(max_by(seen, step)) AS proof_sha256 FROM fold GROUP BY r)
    SELECT s.doc_id, s.leaf, u.subroot, t.h AS root, d.proof_sha256, d.folded_root, d.folded_root = t.h AS verified
    FROM spot s JOIN done d USING (r) JOIN sub u ON s.lang IS NOT DISTINCT FROM u.lang CROSS JOIN (SELECT h FROM top WHERE n = 1) t"""
