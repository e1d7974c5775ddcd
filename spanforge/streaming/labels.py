"""Incremental labelling of arriving text files.

Cleaning, chunking and both dictionary taggers are per-row expressions plus a
broadcast (stream-static) join, so they run unchanged on a streaming DataFrame in
append mode: each micro-batch is tagged as it lands, with no state to keep.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunking import chunk_corpus, clean_corpus
from ..operators.tagging import refine_labels
from ..session import checkpoint_dir
from ..sources.dictionary import dictionary, term_list

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def label_stream(spark: SparkSession, path: str, terms: Mapping[str, Iterable], exclusions: Iterable,
                 schema: str = DOCUMENT_SCHEMA, fmt: str = "parquet", id_col: str = "doc_id",
                 text_col: str = "text", max_len: int = 50, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming label rows ``(doc_id, chunk_no, start, end, entity, text, origin, ...)``
    for documents arriving under ``path`` (explicit schema, as streams require)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.load(path)
    corpus = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("description"))
    chunks = chunk_corpus(clean_corpus(corpus), max_len)
    d, n = dictionary(spark, terms)
    x, _ = term_list(spark, exclusions)
    return refine_labels(chunks, d, x, dict_bytes=n)


def start_label_sink(labels: DataFrame, out: str, name: str = "labels", fmt: str = "parquet",
                     trigger_seconds: int | None = None) -> StreamingQuery:
    """Append label rows to ``out``; progress is kept under the shared checkpoint folder, in a
    folder of the stream's name and output, so two streams never share it and a restart finds it."""
    mark = hashlib.md5(f"{name}|{fmt}|{out}".encode()).hexdigest()[:12]
    ckpt = f"{checkpoint_dir(labels.sparkSession).rstrip('/')}/stream-{name}-{mark}"
    w = labels.writeStream.outputMode("append").option("checkpointLocation", ckpt).queryName(name)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if fmt == "memory":
        return w.format("memory").start()
    return w.format(fmt).option("path", out).start()
