"""The Merkle manifest against a plain tree, with hostile rows and several rounds of blocks."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from spanforge.llm.merkle_manifest import document_manifest, merkle_proofs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    vals = (row[0], row[3], row[2], row[4], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        lo = at // 8 * 8
        yield "".join(level[lo:at]), "".join(level[at + 1:lo + 8])
        at //= 8


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_n, _i, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            acc = leaf(r, text)
            for a, b in path:
                acc = H(a, acc, b)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], H(*[a + b for a, b in path]), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def manifest(spark, rows):
    d = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("grp", "node", "leaf", "block", "at", "root", "pos", "claim")})
    got = document_manifest(d, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.select(*names).collect()), key=str)


def sized(lang, n, start):
    return [(start + i, f"Text {i % 50} of É {lang}" if i % 2 else f"plain {i}", lang, None if i % 5 == 0 else f"s{i % 3}", i) for i in range(n)]


def test_every_size_of_run_and_block(spark):
    rows = []
    for k, n in enumerate((1, 2, 7, 8, 9, 64, 65, 512, 513, 520)):
        rows += sized(f"l{k}", n, 10_000 * k)
    rows += [(None, "No Id", "l1", None, None), (3, None, None, None, None), (4, "", None, "", 0), (4, "", None, "", 0), (4, "Other", None, "", 5), (5, "One", "É", "s", 3)]
    assert manifest(spark, rows) == plain(rows)


def test_rounds_over_blocks_and_many_groups(spark):
    rows = sized("big", 8_300, 0) + [(100_000 + i, f"T{i}", f"g{i % 600}", "s", i) for i in range(700)] + [(77, "The Same", "big", "s", 1)] * 900
    assert manifest(spark, rows) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, "Only", "en", None, 4)], [(None, None, None, None, None)]])
def test_small_tables(spark, rows):
    assert manifest(spark, rows) == plain(rows) if rows else manifest(spark, rows) == []


def test_a_changed_claim_is_found(spark):
    rows = [(i, f"d{i}") for i in range(70)]
    d = spark.createDataFrame(rows, "id long, t string").select("id", F.lit(None).cast("string").alias("grp"), F.sha2("t", 256).alias("node"),
                                                               F.when(F.col("id") == 33, F.sha2(F.lit("d34"), 256)).alias("claim"))
    got = {r.id: r.folded == r.root for r in merkle_proofs(d, ["id"]).collect()}
    assert [k for k, v in got.items() if not v] == [33] and len(got) == 70
