"""The whole corpus job as one lazy plan: sources -> keyword filter -> union ->
distinct -> clean -> chunk -> dictionary tagging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.chunking import chunk_corpus, clean_corpus
from ..operators.corpus import distinct_corpus, union_sources
from ..operators.tagging import refine_labels
from ..sources.dictionary import dictionary, term_list
from ..sources.registry import SourceSpec


def run_corpus(spark: SparkSession, specs: Sequence[SourceSpec], keywords: Iterable[str],
               terms: Mapping[str, Iterable], exclusions: Iterable, max_len: int = 50,
               stopwords: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns ``(chunks, labels)``.  One hash exchange (the distinct, with a partial
    aggregate before it); the dictionary side is broadcast; no other shuffle."""
    corpus = distinct_corpus(union_sources(spark, specs, keywords), specs=specs)
    chunks = chunk_corpus(clean_corpus(corpus, "description", stopwords), max_len)
    d, n = dictionary(spark, terms)
    x, _ = term_list(spark, exclusions)
    return chunks, refine_labels(chunks, d, x, dict_bytes=n)
