"""Label export records (N1, W4, W5, P7, O1) and their flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import dense_index
from .tagging import KEYS, label_order

def labelled_chunks(tagged: DataFrame) -> DataFrame:
    """P7 + O1: ``(doc_id, chunk_no, text, labels)`` for chunks with labels; labels sorted.

    ``tagged`` are label rows that still carry their ``chunk_text`` (``tag_chunks(...,
    keep_text=True)``).  All labels of a chunk lie in one partition, so the partial aggregate
    leaves one row per labelled chunk, and text is shuffled once, for those chunks only."""
    item = F.struct(*[F.col(c) for c in label_order()], "end", "entity", "text")
    return tagged.groupBy(*KEYS).agg(F.first("chunk_text").alias("text"), F.sort_array(F.collect_list(item)).alias("labels"))


def export_records(tagged: DataFrame, partitions: int | None = None) -> DataFrame:
    """N1 + W4 + W5: one nested record per labelled chunk, from label rows with chunk text.

    Records are numbered 0..n-1 in ``(doc_id, chunk_no)`` order (W4, distributed dense index
    over the labelled chunks; no join); results inside a record are numbered in label order as
    ``result-{rec}-{i}`` (W5).  Output columns: ``rec`` (long), ``doc_id``, ``chunk_no`` and the
    record fields ``id``, ``data``, ``annotations``.
    """
    joined = dense_index(labelled_chunks(tagged), KEYS, name="rec", partitions=partitions)

    def result(lab, i):
        return F.struct(
            F.struct(lab["start"].alias("start"), lab["end"].alias("end"), lab["text"].alias("text"),
                     F.array(lab["entity"]).alias("labels")).alias("value"),
            F.format_string("result-%d-%d", F.col("rec"), i).alias("id"),
            F.lit("label").alias("from_name"), F.lit("text").alias("to_name"),
            F.lit("labels").alias("type"))

    return joined.select(
        "rec", *KEYS,
        F.col("rec").cast("string").alias("id"),
        F.struct(F.col("text").alias("text")).alias("data"),
        F.array(F.struct(F.col("rec").alias("id"),
                         F.transform("labels", result).alias("result"))).alias("annotations"),
    )


def flatten_export(records: DataFrame) -> DataFrame:
    """First annotation only, first label only, one row per result:
    ``(id, text, result_no, result_id, start, end, span_text, label)``."""
    first = records.select("id", F.col("data.text").alias("text"),
                           F.posexplode(F.col("annotations")[0]["result"]).alias("result_no", "r"))
    return first.select(
        "id", "text", "result_no", F.col("r.id").alias("result_id"),
        F.col("r.value.start").alias("start"), F.col("r.value.end").alias("end"),
        F.col("r.value.text").alias("span_text"), F.col("r.value.labels")[0].alias("label"))


def record_entities(records: DataFrame, keep=()) -> DataFrame:
    """N2 in array form: ``(id, text, entities array<struct<start,end,label>>)`` in result
    order, ready for the row-local BIO tagger; no explode, no regrouping."""
    return records.select(
        F.col("id").cast("string").alias("id"), *keep, F.col("data.text").alias("text"),
        F.transform(F.col("annotations")[0]["result"], lambda r: F.struct(
            r["value"]["start"].alias("start"), r["value"]["end"].alias("end"),
            r["value"]["labels"][0].alias("label"))).alias("entities"))


def record_ids(tagged: DataFrame) -> DataFrame:
    """The ``id`` of every record without its payload: they are 0..n-1, so a count is enough."""
    n = tagged.select(*KEYS).distinct().count()
    return tagged.sparkSession.range(n).select(F.col("id").cast("string").alias("id"))
