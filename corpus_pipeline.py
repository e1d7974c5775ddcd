"""The corpus job: stages over ``documents``, each one operator of ``spanforge.llm``.

Every stage reads what the one before it kept, and all but the last return the columns of
``documents``.  Empty tables pass through; rows with a null ``doc_id`` pass every stage that
judges the text itself and are never taken for copies.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.common import table, written
from spanforge.llm.decontam import find_leaks
from spanforge.llm.jaccard_metric import similar_components
from spanforge.llm.langid_ecoc import predict, train
from spanforge.llm.pii_gbt import find_private, redacted
from spanforge.llm.poisson_mix import replicate

READ = ("doc_id", "text", "lang", "source", "n_chars")  # columns that stages read or change


def under_own_names(stage):
    """The stage with other columns renamed around it, so that none clashes with one it adds; a
    column that the stage returns anew (``copy_no``) replaces the one of that name."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = {c if c in READ else f"other_{i}": c for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.toDF(*own), sf_dir)
        new = [c for c in out.columns if c not in own]
        kept = [c for c in out.columns if c in own and own[c] not in new]
        return out.select(*[F.col(c).alias(own[c]) for c in kept], *new)

    return run


@under_own_names
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the predicted language; those without any (``und``) go.  Where no row has a
    label, nothing can be learnt: documents with a letter stay as they are."""
    columns = docs.columns
    model = train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = predict(docs, model, keep=tuple(columns)).where("lang_pred <> 'und'")
    return rows.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in columns])


@under_own_names
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked on five-word shingles at 0.8, the smallest id stays.

    A document is an id with a text: of two texts under one id each is judged alone, and rows
    that repeat both stay once.  Rows with a null id stay."""
    columns = docs.columns
    known = docs.where("doc_id IS NOT NULL").withColumn("node", F.xxhash64("doc_id", F.md5(F.coalesce("text", F.lit("")))))
    found = similar_components(known, id_col="node", k=5, num=80, den=100).where("n_shingles > 0").select("node", F.col("component_id").alias("grp"))
    grouped = written(found.distinct(), "groups")
    names = grouped.join(known.select("node", "doc_id").distinct(), "node")
    stays = names.groupBy("grp").agg(F.min(F.struct("doc_id", "node"))["node"].alias("stays"))
    gone = written(grouped.join(written(stays, "stays"), "grp").where("node <> stays").select("node"), "gone")
    kept = known.join(gone, "node", "left_anti").dropDuplicates(["node"]).select(*columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


@under_own_names
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, whole or edited, go."""
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).where(F.size("dc_hits") == 0).select(*docs.columns)


@under_own_names
def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows."""
    columns = docs.columns
    rows = find_private(docs).withColumn("pii_clean", F.when(F.col("text").isNotNull(), redacted(F.col("pii_text"), F.col("pii_spans"))))
    new = {"text": F.col("pii_clean"), "n_chars": F.length("pii_clean").cast("long")}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in columns])


@under_own_names
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies are drawn so that the sources come near their target weights; adds ``copy_no``."""
    return replicate(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_private),
    ("mix", mix_sources),
]

# classifiers, alignment and joins of the stages are not SQL; tests hold each against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
