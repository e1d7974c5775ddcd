"""Cleaning and chunking of a corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import chunk_text, pack
from ..functions.text import clean_text, split_sentences


def clean_corpus(corpus: DataFrame, text_col: str = "description", stopwords: Iterable[str] | None = None,
                 keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """F10 per row; rows whose cleaned text is empty never reach chunking (null rule 3).

    The projection also carries ``spark_partition_id()`` and the filter tests it (always
    true).  A projection with a non-deterministic field is an optimiser barrier: the
    emptiness filter stays above it and reads the cleaned column, instead of being pushed
    down with the whole cleaning chain copied into it (two evaluations per row).  A scan of
    few splits is spread by the caller (``session.spread``).
    """
    cleaned = corpus.select(*keep, clean_text(F.col(text_col), stopwords).alias("text"),
                                    F.spark_partition_id().alias("_part"))
    return cleaned.where((F.col("_part") >= 0) & (F.col("text") != "")).drop("_part")


def chunk_corpus(clean: DataFrame, max_len: int = 50, drop_empty: bool = True,
                 splitter=None, counter=None, keep: Iterable[str] = ("doc_id",), measure=None) -> DataFrame:
    """Sentence-pack each document and explode to ``(doc_id, chunk_no, text)``.

    Runs row-local (no shuffle); chunk rows stay in their document's partition.  ``counter``
    measures one sentence (``Column -> Column``), ``measure`` all sentences of a row at once
    (array -> array, such as ``functions.pieces.subword_lengths``).
    """
    if measure is not None:
        cut = clean.select(*keep, (splitter or split_sentences)(F.col("text")).alias("_sent"))
        cut = cut.select(*keep, "_sent", measure(F.col("_sent")).alias("_size"))
        return cut.select(*keep, F.posexplode(pack(F.col("_sent"), F.col("_size"), max_len, drop_empty)).alias("chunk_no", "text"))
    packed = chunk_text(F.col("text"), max_len, drop_empty, splitter, counter)
    return clean.select(*keep, F.posexplode(packed).alias("chunk_no", "text"))
