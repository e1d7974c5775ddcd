"""Corpus assembly: null drops (P2), title keyword filter (P4-P6), union (U1),
distinct (U2) and null/row counts (A1, A2)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import holds_any
from ..functions.text import keyword_pattern
from ..session import local_table
from ..sources.registry import SourceSpec, read_source


def require(df: DataFrame, cols: Sequence[str], non_empty: bool = False) -> DataFrame:
    """Drop rows with a null in ``cols`` (and, with ``non_empty``, an empty string).

    Plain predicates, so the ``IsNotNull`` filters reach the parquet scan.
    """
    cond = None
    for c in cols:
        one = F.col(c).isNotNull()
        if non_empty:
            one = one & (F.col(c) != "")
        cond = one if cond is None else cond & one
    return df if cond is None else df.where(cond)


def keyword_filter(df: DataFrame, col: str, keywords: Iterable[str]) -> DataFrame:
    """P5: keep rows whose lower-cased ``col`` contains any keyword (case-insensitive
    substring, no word boundary).  Null never matches; an empty list keeps all non-null.

    One regex alternation of quoted literals, evaluated inside the scan stage.
    """
    pattern = keyword_pattern(keywords)
    c = F.lower(F.col(col).cast("string"))
    if pattern is None:
        return df.where(c.isNotNull())
    return df.where(c.rlike(pattern))


def keyword_filter_many(df: DataFrame, col: str, keywords: Iterable[str]) -> DataFrame:
    """P5 for long keyword lists: the rows of ``keyword_filter`` from one automaton pass over each
    value, however many keywords there are."""
    kws = list(keywords)
    c = F.lower(F.col(col).cast("string"))
    return df.where(c.isNotNull()) if not kws else df.where(holds_any(df.sparkSession, c, kws))


def titled_rows(spark: SparkSession, spec: SourceSpec, keywords: Iterable[str]) -> DataFrame | None:
    """Reference flow for one titled source: drop null descriptions and titles, lower
    the title, keep keyword hits."""
    df = read_source(spark, spec)
    if df is None:
        return None
    df = require(df, ["description", "title"]).withColumn("title", F.lower("title"))
    return keyword_filter(df, "title", keywords)


def union_sources(spark: SparkSession, specs: Sequence[SourceSpec], keywords: Iterable[str]) -> DataFrame:
    """Titled sources filtered by keyword, untitled appended whole, in ``rank`` order.

    Output ``(source, source_rank, description)``; a lazy ``UNION ALL`` of scans.  Sources that
    cannot be read or lack a column add no rows; without any the result is empty.
    """
    kws = list(keywords)
    parts = [local_table(spark, [], "source string, source_rank int, description string")]
    for spec in sorted(specs, key=lambda s: s.rank):
        df = titled_rows(spark, spec, kws) if spec.titled else read_source(spark, spec)
        if df is not None:
            parts.append(df.select("source", "source_rank", "description"))
    return reduce(DataFrame.unionByName, parts[1:] or parts)


def distinct_corpus(df: DataFrame, key: str = "description", specs: Sequence[SourceSpec] | None = None) -> DataFrame:
    """Exact distinct on the text, first source (lowest rank) kept; null text dropped.

    Grouped by the text with ``min(source_rank)``, an integer buffer that hash aggregation
    holds, before and after the one exchange.  The rank is mapped to its name afterwards, by
    the registry rows if given, else by the distinct names of the table.  A text copied in a
    third of all rows collapses map-side.  ``doc_id`` is the MD5 of the text (128 bits).
    """
    best = require(df, [key]).groupBy(key).agg(F.min("source_rank").alias("source_rank"))
    if specs is not None:
        best = best.withColumn("source", F.element_at(F.create_map(*[F.lit(x) for s in specs for x in (s.rank, s.name)]), F.col("source_rank")))
    else:
        best = best.join(df.select("source_rank", "source").distinct(), "source_rank")
    return best.select(F.md5(F.col(key)).alias("doc_id"), "source", F.col(key).alias("description"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1 + A2: one row, ``n_rows`` and ``null_<col>`` per column, in one pass."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in cols]
    return df.agg(*aggs)
