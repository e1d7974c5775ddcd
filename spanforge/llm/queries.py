"""One registered query per operator; each applies it to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .ann_forest import nearest
from .common import table
from .decontam import find_leaks
from .fm_dedup import remove_repeats
from .jaccard_metric import similar_components
from .k2_treap import rank_documents
from .langid_ecoc import held_out, predict, train
from .license_scan import scan_licenses
from .lm_xent import cross_entropy_difference
from .merkle_manifest import document_manifest
from .pii_gbt import KINDS, find_private, span_text
from .poisson_mix import replicate
from .va_file import top_inner_products
from .warc_merge import archive_and_merge


def op1_benchmark_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    hits = find_leaks(docs, table(spark, sf, "benchmark")).select("doc_id", F.explode("dc_hits").alias("h"))
    return hits.select("doc_id", "h.item_id", "h.score", "h.start_word", "h.end_word")


def op2_warc_index_merge(spark, sf):
    index = archive_and_merge(table(spark, sf, "pages"))
    return index.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op3_language_id_ecoc(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = train(docs, learn=~held_out())
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model, keep=("doc_id", "held_out"))


def op4_hash_prefix_forest(spark, sf):
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_cross_entropy_difference(spark, sf):
    return cross_entropy_difference(table(spark, sf, "documents"), table(spark, sf, "labels"), F.col("quality") == 1)


def op6_license_scan(spark, sf):
    return scan_licenses(table(spark, sf, "documents"))


def op7_jaccard_metric_join(spark, sf):
    return similar_components(table(spark, sf, "documents"), k=3, num=90, den=100)


def op8_fm_substring_dedup(spark, sf):
    return remove_repeats(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_poisson_mix(spark, sf):
    return replicate(table(spark, sf, "documents"))


def op10_pii_boosted_candidates(spark, sf):
    rows = find_private(table(spark, sf, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *[F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                       F.sha2(span_text("pii_base"), 256).alias("base_sha256"), span_text("pii_spans").alias("spans"))


def op11_merkle_manifest(spark, sf):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return document_manifest(table(spark, sf, "documents"), tampered)


def op12_va_file_search(spark, sf):
    return top_inner_products(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


def op13_k2_treap_search(spark, sf):
    return rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=20)


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc_index_merge": op2_warc_index_merge,
    "op3_language_id_ecoc": op3_language_id_ecoc,
    "op4_hash_prefix_forest": op4_hash_prefix_forest,
    "op5_cross_entropy_difference": op5_cross_entropy_difference,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_metric_join": op7_jaccard_metric_join,
    "op8_fm_substring_dedup": op8_fm_substring_dedup,
    "op9_poisson_mix": op9_poisson_mix,
    "op10_pii_boosted_candidates": op10_pii_boosted_candidates,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_va_file_search": op12_va_file_search,
    "op13_k2_treap_search": op13_k2_treap_search,
}
