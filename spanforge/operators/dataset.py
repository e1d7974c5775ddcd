"""Word-level BIO data set (J3, W6, W7, N3), rejects (D3) and the seeded split (O2)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import token_spans
from ..sources.dictionary import LABEL_ALIAS, tag_to_id_map
from ..functions.arrays import literal_map
from ..session import materialize
from .indexing import dense_index


def alias_type(entity: Column) -> Column:
    """Auto-label -> training type: strip ``B-``/``I-``, then map the type name."""
    bare = F.regexp_replace(entity, r"^[BI]-", "")
    return F.coalesce(F.element_at(literal_map(LABEL_ALIAS.items()), bare), bare)


def entity_ids(entities: Column) -> Column:
    """Entities ``(start, end, label)`` -> ``(s, e, b, i)`` with their B and I tag ids."""
    ids = tag_to_id_map()
    return F.transform(entities, lambda e: F.struct(
        e["start"].alias("s"), e["end"].alias("e"),
        F.element_at(ids, F.concat(F.lit("B-"), e["label"])).alias("b"),
        F.element_at(ids, F.concat(F.lit("I-"), e["label"])).alias("i")))


def _tag_rows(starts: pa.Array, ends: pa.Array, entities: pa.Array) -> pa.Array:
    """BIO tags of every row of an Arrow batch.

    Tokens are sorted and never overlap, so an entity covers the run of tokens from the first
    that starts at or after it to the last that ends inside it, found by binary search; writing
    the runs in entity order lets the last entity win."""
    def flat(a):
        return a.flatten().to_numpy(zero_copy_only=False), a.offsets.to_numpy() - a.offsets[0].as_py()

    s, cut = flat(starts)
    e, _ = flat(ends)
    ent, ent_cut = entities.flatten(), entities.offsets.to_numpy() - entities.offsets[0].as_py()
    es, ee, eb, ei = (np.asarray(ent.field(k).fill_null(-1)) for k in ("s", "e", "b", "i"))
    tags = np.zeros(len(s), np.int32)
    for r in range(len(starts)):
        ts, te, out = s[cut[r]:cut[r + 1]], e[cut[r]:cut[r + 1]], tags[cut[r]:cut[r + 1]]
        at = slice(ent_cut[r], ent_cut[r + 1])
        lo, hi = np.searchsorted(ts, es[at]), np.searchsorted(te, ee[at], "right")
        for a, b, first, rest in zip(lo.tolist(), hi.tolist(), eb[at].tolist(), ei[at].tolist()):
            if a < b:
                out[a:b] = rest
                out[a] = first
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(tags))


def bio_tags(toks: Column, ents: Column) -> Column:
    """W6 + W7 + J3 inside one record: ``array<int>``, the tag id of each token.

    A token inside an entity (``t.start >= e.start and t.end <= e.end``) gets ``B-type`` if
    it is the entity's first contained token, else ``I-type``; a later entity overwrites
    an earlier one; other tokens are ``O`` (0).  No join, no shuffle: one Arrow-batched pass,
    O(T + E log T) per record.  ``toks`` are token spans, ``ents`` are ``entity_ids``.
    """
    return F.arrow_udf(_tag_rows, "array<int>")(F.transform(toks, lambda t: t["start"]), F.transform(toks, lambda t: t["end"]), ents)


def with_bio(df: DataFrame, text: str, entity_cols: dict, keep=("id",)) -> DataFrame:
    """Add ``tokens`` (strings) and one tag array per entity column (``{out: entities_col}``),
    sharing one tokenisation of ``text``; row-local."""
    prep = df.select(*keep, token_spans(text).alias("_toks"),
                     *[entity_ids(F.col(c)).alias(f"_e_{o}") for o, c in entity_cols.items()])
    return prep.select(*keep, F.transform("_toks", lambda t: t["text"]).alias("tokens"),
                       *[bio_tags(F.col("_toks"), F.col(f"_e_{o}")).alias(o) for o in entity_cols])


def word_level(records: DataFrame) -> DataFrame:
    """``(id, tokens array<string>, ner_tags array<int>)`` from ``record_entities``
    rows ``(id, text, entities)``; rejected records (D3) are left out."""
    ok = records.where(bio_reject_reason_col(F.col("entities")).isNull())
    return with_bio(ok, "text", {"ner_tags": "entities"}).select("id", "tokens", "ner_tags")


def bio_reject_reason_col(entities: Column) -> Column:
    """D3 reason for one record, or null when it is usable."""
    valid = F.aggregate(entities, F.lit(True), lambda acc, e: acc & F.element_at(
        tag_to_id_map(), F.concat(F.lit("B-"), e["label"])).isNotNull())
    return (F.when(entities.isNull() | (F.size(entities) == 0), F.lit("no annotations"))
            .when(~valid, F.lit("unknown label")))


def bio_rejects(records: DataFrame) -> DataFrame:
    """D3: ``(id, reason)`` for records the original job would abort on."""
    r = records.select("id", bio_reject_reason_col(F.col("entities")).alias("reason"))
    return r.where(F.col("reason").isNotNull())


def bio_long(word_level_df: DataFrame) -> DataFrame:
    """Long form ``(id, idx, token, tag)`` of the word-level records."""
    return word_level_df.select("id", F.posexplode(F.arrays_zip("tokens", "ner_tags")).alias("idx", "z")).select(
        "id", "idx", F.col("z.tokens").alias("token"), F.col("z.ner_tags").alias("tag"))


DIGITS = 4  # of the hash, a round


def kth_hash(hashes: DataFrame, k: int) -> str:
    """A string below which exactly ``k`` of the distinct hexadecimal ``_h`` lie (equal hashes stay together).

    Counts by the next digits narrow the place down: each round is one aggregate into at most
    ``16 ** DIGITS`` rows, and two or three rounds find it among billions; nothing is sorted."""
    prefix = ""
    while len(prefix) < 32:
        at = len(prefix)
        rows = hashes.where(F.col("_h").startswith(prefix)) if prefix else hashes
        found = rows.groupBy(F.substring("_h", at + 1, DIGITS).alias("d")).count().collect()
        for d, n in sorted((r.d, r["count"]) for r in found):
            if k < n:
                break
            k -= n
        else:
            return prefix + "g"  # beyond all digits
        prefix += d
        if k == 0:
            return prefix
    return prefix


def split_by_selection(df: DataFrame, key: str = "id", ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """O2 without positions: the rows of ``train_val_split`` with ``split`` only.

    The cut is the hash at rank ``floor(n * ratio)``, found by ``kth_hash``; each row compares its
    own hash with it where it lies, so no payload moves and nothing is sorted or joined.  Rows of
    equal keys share a side."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    hashes = materialize(df.select(h.alias("_h")), "split")
    cut = kth_hash(hashes, int(hashes.count() * ratio))
    return df.withColumn("split", F.when(h < F.lit(cut), F.lit("train")).otherwise(F.lit("validation")))


def train_val_split(df: DataFrame, key: str = "id", ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """O2: seeded shuffle, exact cut at ``floor(n * ratio)``; adds ``split`` and ``shuffle_no``.

    The shuffle order is ``md5('{seed}:{key}')`` (portable across engines); positions come
    from the distributed dense index, the cut from one row count.  Same result under any
    partitioning.
    """
    h = df.select(key, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("_h"))
    idx = dense_index(h, ["_h", key], name="shuffle_no").drop("_h")  # keys only, no payload
    cut = int(idx.count() * ratio)
    idx = idx.withColumn("split", F.when(F.col("shuffle_no") < F.lit(cut), F.lit("train")).otherwise(F.lit("validation")))
    return idx if df.columns == [key] else df.join(idx, key)
