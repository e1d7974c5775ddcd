"""Dictionary, exclusion and label-map tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import flatten_terms, literal_map
from ..session import local_table

# Keyword categories of the original job in lookup priority order, with
# the label each one produces.
CATEGORIES = [
    ("programming_languages", 1, "PROGRAMMINGLANG"),
    ("databases", 2, "DATABASE"),
    ("frameworks_libraries", 3, "FRAMEWORK_LIBRARY"),
    ("tools", 4, "TOOLS"),
]

# The training label space (id, tag) of the original job.
LABELS = [
    (0, "O"),
    (1, "B-PROGRAMMINGLANG"),
    (2, "I-PROGRAMMINGLANG"),
    (3, "B-TECHNOLOGY"),
    (4, "I-TECHNOLOGY"),
    (5, "B-DATABASE"),
    (6, "I-DATABASE"),
    (7, "B-FRAMEWORKLIBARY"),
    (8, "I-FRAMEWORKLIBARY"),
]

# Auto-label type -> training type (D2): prefixes are stripped before this lookup.
LABEL_ALIAS = {
    "PROGRAMMINGLANG": "PROGRAMMINGLANG",
    "DATABASE": "DATABASE",
    "FRAMEWORK_LIBRARY": "FRAMEWORKLIBARY",
    "FRAMEWORKLIBARY": "FRAMEWORKLIBARY",
    "TOOLS": "TECHNOLOGY",
    "TECHNOLOGY": "TECHNOLOGY",
}


def _as_lists(items: Iterable) -> list[list[str]]:
    return [list(i) if isinstance(i, (list, tuple)) else [i] for i in items]


def _bytes_bound(lists: list[list[str]]) -> int:
    """Bytes that any lookup row of these terms stays below (term, key, words, pattern)."""
    return sum(8 * len(t.encode("utf-8")) + 64 * (t.count(" ") + 4) for i in lists for t in i) + 1


def dictionary_terms(raw: DataFrame) -> DataFrame:
    """S2 + F15 for a table ``(category, items array<array<string>>)`` of any size, read from a
    file or built by the driver: ``(term, category, priority, label, n_words)``."""
    known = local_table(raw.sparkSession, CATEGORIES, "category string, priority int, label string")
    terms = raw.join(known, "category").select("category", "priority", "label", F.explode(flatten_terms(F.col("items"))).alias("term"))
    return terms.select("term", "category", "priority", "label", F.size(F.split(F.trim("term"), r"\s+")).alias("n_words"))


def dictionary(spark: SparkSession, mapping: Mapping[str, Iterable]) -> tuple[DataFrame, int]:
    """S2 + F15: ``(term, category, priority, label, n_words)`` from category -> items.

    Items are strings or lists of strings (nested lists are flattened), lower-cased and
    de-duplicated per category.  Returns the table and an upper bound of its lookup's bytes,
    by which the taggers decide whether to broadcast it.
    """
    lists = {name: _as_lists(mapping.get(name, [])) for name, _p, _l in CATEGORIES}
    raw = local_table(spark, list(lists.items()), "category string, items array<array<string>>")
    return dictionary_terms(raw), sum(map(_bytes_bound, lists.values()))


def term_list(spark: SparkSession, items: Iterable) -> tuple[DataFrame, int]:
    """Exclusion list (``term``), flattened and lower-cased like the dictionary, and its bound."""
    lists = _as_lists(items)
    raw = local_table(spark, [(lists,)], "items array<array<string>>")
    return raw.select(F.explode(flatten_terms(F.col("items"))).alias("term")), _bytes_bound(lists)


def label_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(id int, tag string)`` from a model config's ``id2label`` (string keys cast
    to int), or the fixed label space when no path is given."""
    if path is None:
        return local_table(spark, LABELS, "id int, tag string")
    cfg = spark.read.option("multiLine", True).schema(
        "id2label map<string,string>, label2id map<string,int>, model_name string").json(path)
    return cfg.select(F.explode("id2label").alias("k", "tag")).select(
        F.col("k").cast("int").alias("id"), "tag")


def write_label_config(spark: SparkSession, path: str, labels: list[tuple[int, str]] = LABELS, model: str = "spanforge-tagger") -> None:
    """Write a model config (``label2id``, ``id2label``, ``model_name``) as a JSON record below
    ``path``, with Spark's writer (any file system)."""
    names, ids = F.create_map(*[F.lit(x) for i, t in labels for x in (str(i), t)]), F.create_map(*[F.lit(x) for i, t in labels for x in (t, i)])
    spark.range(1).select(ids.alias("label2id"), names.alias("id2label"), F.lit(model).alias("model_name")).coalesce(1).write.mode("overwrite").json(path)


def tag_to_id_map():
    """Constant ``map<string,int>`` of the label space (9 entries)."""
    return literal_map([(t, i) for i, t in LABELS])
