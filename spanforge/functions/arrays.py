"""Array, map and sequence column functions: packing, arg-max, padding, map inversion."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .spans import let
from .text import split_sentences, text_length



PACK_BLOCK = 256


def pack(sentences: Column, lengths: Column, max_len: int = 50, drop_empty: bool = True) -> Column:
    """Greedy packing of sentences into chunks of at most ``max_len`` units.

    Per sentence: if ``current + len > max_len`` the current chunk is flushed (even when
    empty), then the sentence is appended; the non-empty tail is flushed at the end.  A
    sentence longer than ``max_len`` is never cut.  The only empty chunk arises when the
    first sentence alone exceeds ``max_len``; ``drop_empty`` removes it.

    The fold reads lengths only and keeps where a new chunk starts; each chunk is joined from
    its slice of the sentences.  The state (length, place) is carried by an outer fold over blocks of
    ``PACK_BLOCK`` sentences; an inner fold cuts one block.  A document of n sentences costs
    O(n * PACK_BLOCK + (n / PACK_BLOCK)^2) appends of a place instead of O(n^2).
    """
    ints = "array<int>"

    def inner_step(acc, n):
        flush = acc["len"] + n > F.lit(max_len)
        return F.struct(F.when(flush, F.concat(acc["cuts"], F.array(acc["at"]))).otherwise(acc["cuts"]).alias("cuts"),
                        F.when(flush, n).otherwise(acc["len"] + n).alias("len"), (acc["at"] + 1).alias("at"))

    def cuts(sizes):
        n_blocks = F.ceil(F.size(sizes) / F.lit(PACK_BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))),
                             lambda b: F.slice(sizes, b * PACK_BLOCK + 1, PACK_BLOCK))
        init = F.struct(F.array().cast(f"array<{ints}>").alias("done"), F.lit(0).alias("len"), F.lit(0).alias("at"))

        def block_step(acc, blk):
            start = F.struct(F.array().cast(ints).alias("cuts"), acc["len"].alias("len"), acc["at"].alias("at"))
            return let(F.aggregate(blk, start, inner_step), lambda res: F.struct(
                F.concat(acc["done"], F.array(res["cuts"])).alias("done"), res["len"].alias("len"), res["at"].alias("at")))

        return F.aggregate(blocks, init, block_step, lambda acc: F.flatten(acc["done"]))

    def joined(text):
        bounds = F.concat(F.array(F.lit(0)), let(lengths, cuts), F.array(F.size(text)))
        return let(bounds, lambda at: F.transform(F.slice(at, F.lit(2), F.size(at) - 1), lambda end, i: F.array_join(
            F.slice(text, F.get(at, i) + 1, end - F.get(at, i)), " ")))

    packed = let(sentences, lambda text: F.when(F.size(text) > 0, joined(text)).when(text.isNotNull(), F.array().cast("array<string>")))
    if drop_empty:
        packed = F.filter(packed, lambda s: s != "")
    return packed


def chunk_text(c: Column, max_len: int = 50, drop_empty: bool = True,
               splitter=None, counter=None) -> Column:
    """F13 + F14 + W1: split into sentences, measure, pack.  Splitter/counter pluggable."""
    count = counter or text_length
    return let((splitter or split_sentences)(c), lambda sentences: pack(
        sentences, F.transform(sentences, count), max_len, drop_empty))


def argmax(c: Column) -> Column:
    """0-based index of the largest element; the lowest index wins ties."""
    return F.array_position(c, F.array_max(c)).cast("int") - 1


def pad(c: Column, n: int = 128, fill: int = -100) -> Column:
    """Truncate to ``n`` elements and pad with ``fill``."""
    head = F.slice(c, 1, n)
    return F.concat(head, F.array_repeat(F.lit(fill), F.lit(n) - F.size(head)))


def invert_map(c: Column) -> Column:
    """Swap keys and values of a map."""
    return F.map_from_arrays(F.map_values(c), F.map_keys(c))


def flatten_terms(c: Column) -> Column:
    """flatten a list of term lists, lower-case, de-duplicate."""
    return F.array_distinct(F.transform(F.flatten(c), lambda t: F.lower(t)))


def literal_map(pairs: Iterable[tuple]) -> Column:
    """A small constant ``MapType`` column from driver-side pairs."""
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)
