"""Source registry (S8), scans (S1, P1), column checks and status."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_table
from .ranges import read_csv_ranges

# The strings pandas reads as missing by default (its NA list); CSV
# sources apply them so that such cells behave as nulls, as in the original job.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


@dataclass(frozen=True)
class SourceSpec:
    """One input table of the corpus.

    ``title`` / ``description`` name columns, or are Columns computed from the table
    (e.g. the ``<title>`` element of a page).  ``title=None`` marks an untitled source
    that is appended unfiltered.  ``rank`` is the position in the union order.
    """

    name: str
    path: str
    description: str | Column
    title: str | Column | None = None
    fmt: str = "parquet"
    rank: int = 0
    null_tokens: tuple = field(default=())
    options: tuple = field(default=())

    @property
    def titled(self) -> bool:
        return self.title is not None


# The six job-posting tables of the original job, in union order
# (title column, description column).  Paths are relative to a landing folder.
JOB_POSTING_SOURCES = [
    ("job_descriptions", "job-description-dataset/job_descriptions.csv", "Job Title", "Job Description"),
    ("eda_data", "jobs-dataset-from-glassdoor/eda_data.csv", "Job Title", "Job Description"),
    ("postings", "LinkedIn Job Postings (2023 - 2024)/postings.csv", "title", "description"),
    ("job_title_des", "jobs-and-job-description/job_title_des.csv", "Job Title", "Job Description"),
    ("jobs", "jobs.csv", None, "description"),
    ("dice_com", "U.S. Technology Jobs on Dice.com/dice_com-job_us_sample.csv", None, "jobdescription"),
]


def job_posting_specs(base: str) -> list[SourceSpec]:
    """The CSV registry rows for a landing folder ``base``."""
    return [
        SourceSpec(name=n, path=f"{base.rstrip('/')}/{p}", title=t, description=d, fmt="csv",
                   rank=i, null_tokens=tuple(PANDAS_NA_TOKENS))
        for i, (n, p, t, d) in enumerate(JOB_POSTING_SOURCES)
    ]


def load_table(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Scan one source.  CSV: header row, quoted multi-line cells, no inference; ``csv`` files are
    read whole by a task each, ``csv_ranges`` files (quoted by the standard) by byte ranges."""
    if spec.fmt == "csv_ranges":
        return read_csv_ranges(spark, spec.path, dict(spec.options))
    if spec.fmt == "csv":
        reader = (spark.read.option("header", True).option("multiLine", True)
                  .option("escape", '"').option("inferSchema", False))
        for k, v in spec.options:
            reader = reader.option(k, v)
        return reader.csv(spec.path)
    return spark.read.format(spec.fmt).load(spec.path)


def _resolve(df: DataFrame, c: str | Column) -> Column:
    return df[c] if isinstance(c, str) else c


def _nullify(c: Column, tokens: tuple) -> Column:
    c = c.cast("string")
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c) if tokens else c


def missing_columns(df: DataFrame, spec: SourceSpec) -> list[str]:
    """Named columns the table lacks (computed Columns are not checked)."""
    cols = set(df.columns)
    need = [c for c in (spec.description, spec.title) if isinstance(c, str)]
    return [c for c in need if c not in cols]


def _open(spark: SparkSession, spec: SourceSpec) -> tuple[DataFrame | None, list[str]]:
    """The table and what is wrong with it; a table that cannot be read is reported."""
    try:
        df = load_table(spark, spec)
        return df, [f"missing {', '.join(m)}"] if (m := missing_columns(df, spec)) else []
    except AnalysisException as exc:  # no such path, no schema
        return None, [f"unreadable: {exc.getCondition() or type(exc).__name__}"]


def read_source(spark: SparkSession, spec: SourceSpec, strict: bool = False) -> DataFrame | None:
    """S1 + P1: ``(source, source_rank, title, description)``; None if the table cannot be read
    or lacks columns.  Columns are resolved at plan time; with ``strict`` a fault raises.
    """
    df, faults = _open(spark, spec)
    if faults:
        if strict:
            raise KeyError(f"{spec.name}: {faults[0]}")
        return None
    title = (_nullify(_resolve(df, spec.title), spec.null_tokens) if spec.titled
             else F.lit(None).cast("string"))
    return df.select(
        F.lit(spec.name).alias("source"),
        F.lit(spec.rank).alias("source_rank"),
        title.alias("title"),
        _nullify(_resolve(df, spec.description), spec.null_tokens).alias("description"),
    )


def land(spark: SparkSession, spec: SourceSpec, path: str) -> SourceSpec:
    """Landing step: a quoted CSV source (cells may hold line breaks) is written once as parquet; the returned spec reads that, split as finely as the cluster likes.
    A source that cannot be read is returned as it is, to be reported by ``source_status``."""
    df = read_source(spark, spec)
    if df is None:
        return spec
    df.select("title", "description").write.mode("overwrite").parquet(path)
    return SourceSpec(spec.name, path, description="description", title="title" if spec.titled else None, rank=spec.rank)


def source_status(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """One row per source ``(source, ok, reason, rows)``; row counts stay lazy."""
    parts = [local_table(spark, [], "source string, ok boolean, reason string, rows bigint")]
    for spec in specs:
        df, faults = _open(spark, spec)
        if faults:
            parts.append(local_table(spark, [(spec.name, False, faults[0], 0)], "source string, ok boolean, reason string, rows bigint"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(spec.name).alias("source"), F.lit(True).alias("ok"),
                F.lit(None).cast("string").alias("reason"), F.col("rows")))
    return reduce(DataFrame.unionByName, parts[1:] or parts)
