"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A document of source ``s`` should appear ``rate(s)`` times on average: the target weight of
its source times the total number of documents, over the source's number of documents.  Its
count inverts the Poisson distribution at a uniform number hashed from seed and key, the
document is exploded by the count, and all copies are shuffled by a hash.

Defined cases: a null source is a source of its own (weighed as any other); a null key is
hashed as the text ``null``; rows with equal keys are told apart by a hash of their text, and
fully equal rows get equal counts; a source without a given weight gets 0 copies; an empty
table gives no rows; a column named ``copy_no`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import set_aside, written

SEED = 17
# Rates are broadcast below this many sources; beyond it they are joined with salted keys.
BROADCAST_SOURCES = 100_000
SALTS = 64
MASK = 2.0 ** 52


def hashed_uniform(seed: int, *parts) -> Column:
    """Uniform number in (0, 1) from 52 bits of an MD5."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(MASK)


def poisson_table(rate: Column) -> Column:
    """Distribution function of a Poisson law at 0, 1, 2, ..., up to where 52 bits end.

    Terms are exp(k ln r - r - ln k!), summed in order; the last k lies 12 deviations and 40
    above the mean, beyond which no 52-bit uniform number can fall."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    acc = F.aggregate(
        F.sequence(F.lit(0), last),
        F.struct(F.lit(0.0).alias("logf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf")),
        lambda a, k: F.struct(
            (a["logf"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(0.0)).alias("logf"),
            (a["sum"] + F.exp(k * F.ln(rate) - rate - (a["logf"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(0.0)))).alias("sum"),
            F.concat(a["cdf"], F.array(a["sum"] + F.exp(k * F.ln(rate) - rate - (a["logf"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(0.0))))).alias("cdf")),
        lambda a: a["cdf"])
    return F.when(rate > 0, acc).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict | None = None,
                 temperature: float = 0.5) -> DataFrame:
    """``(mix_source, mix_n, mix_rate, mix_cdf)``: one row per source.

    ``weights`` maps sources to target shares; without it, a source's share is its number of
    documents to the power ``temperature``, over the sum of these."""
    n = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("null")).alias("mix_source")).agg(
        F.count("*").alias("mix_n"))
    if weights is None:
        share = F.pow(F.col("mix_n").cast("double"), F.lit(float(temperature)))
    else:
        share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in (str(kv[0]), float(kv[1]))]), F.col("mix_source")), F.lit(0.0))
    n = n.withColumn("mix_share", share)
    total = n.agg(F.sum("mix_n").alias("all_n"), F.sum(F.round("mix_share", 9)).alias("all_share"))
    rate = F.col("mix_share") * F.col("all_n") / F.col("all_share") / F.col("mix_n")
    return n.join(F.broadcast(total)).select("mix_source", "mix_n", F.when(F.col("all_share") > 0, rate).otherwise(0.0).alias("mix_rate")).withColumn(
        "mix_cdf", poisson_table(F.col("mix_rate")))


def replicate(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              weights: dict | None = None, temperature: float = 0.5, seed: int = SEED) -> DataFrame:
    """``docs`` exploded to the drawn number of copies and shuffled; adds ``copy_no`` (from 1).

    The rates hold one row per source; they are written first, and broadcast after a check of
    their number.  No text is shuffled by source: the only wide step is the final shuffle by a
    hash of each copy, in which no key is frequent."""
    docs, kept = set_aside(docs, ("copy_no",))
    id_col, source_col, text_col = kept[id_col], kept[source_col], kept[text_col]
    rates = written(source_rates(docs, source_col, weights, temperature).drop("mix_n"), "mix-rates")
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("null"))
    if rates.count() <= BROADCAST_SOURCES:
        drawn = docs.withColumn("mix_source", source).join(F.broadcast(rates), "mix_source")
    else:
        salted = rates.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(SALTS)).cast("int")
        drawn = docs.withColumns({"mix_source": source, "mix_salt": salt}).join(salted, ["mix_source", "mix_salt"])
    # each text is hashed once: a projection with a part number is one that the optimiser leaves
    # whole, and the number drawn is bound before the table is searched
    once = F.spark_partition_id().alias("mix_part")
    drawn = drawn.select("*", F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("mix_md5"), once)
    u = hashed_uniform(seed, F.col(id_col), F.col("mix_md5"))
    count = F.transform(F.array(u), lambda x: F.size(F.filter("mix_cdf", lambda c: c < x)))[0]
    counted = drawn.drop("mix_part").select("*", count.alias("mix_count"), once).where("mix_part >= 0 AND mix_count > 0")
    copies = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("mix_count"))))
    copies = copies.withColumn("mix_key", F.xxhash64(F.lit(seed), F.col(id_col), F.col("mix_md5"), F.col("copy_no")))
    return copies.repartition(F.col("mix_key")).sortWithinPartitions("mix_key").select(*[F.col(v).alias(k) for k, v in kept.items()], "copy_no")


ORACLE = f"""
WITH n AS (SELECT coalesce(source, 'null') AS src, count(*) AS n FROM documents GROUP BY 1),
share AS (SELECT src, n, pow(CAST(n AS DOUBLE), 0.5) AS share FROM n),
rate AS (SELECT src, share * (SELECT sum(n) FROM share) / (SELECT sum(round(share, 9)) FROM share) / n AS r FROM share),
term AS (SELECT src, k, exp(k * ln(r) - r - lgamma(k + 1)) AS p
         FROM rate, LATERAL (SELECT unnest(range(0, CAST(ceil(r + 12 * sqrt(r) + 40) AS BIGINT) + 1)) AS k)),
cdf AS (SELECT src, k, sum(p) OVER (PARTITION BY src ORDER BY k) AS c FROM term),
cdfs AS (SELECT src, list(c ORDER BY k) AS cs FROM cdf GROUP BY src),
drawn AS (SELECT d.*, (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {MASK:.1f}::DOUBLE AS u
          FROM documents d),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, len(list_filter(cs, lambda c: c < u)) AS k
            FROM drawn d JOIN cdfs ON cdfs.src = coalesce(d.source, 'null'))
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, k + 1)) AS INTEGER) AS copy_no FROM counted
"""
assert math.isfinite(MASK)
