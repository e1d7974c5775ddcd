"""Quoted CSV and JSON-array files read by many tasks.

A quoted cell may hold line breaks and a JSON array is one value, so Spark's own readers give
such a file to one task.  Here the text source splits the file into its usual byte ranges.  What a
task must know where its range begins (inside a quote; inside a string and how deep) is a prefix
sum of what the ranges before it hold, so a first pass counts one row a range, a window adds these
up, and a second pass cuts the records.  A record over several ranges comes out as fragments, which
are joined by an aggregate of at most two rows a range.  The records are then parsed by
``from_csv`` or ``from_json`` in the JVM.

CSV must be quoted by the standard (a cell with quotes is quoted as a whole, inner quotes are
doubled), with line feeds or carriage return and line feed between records; files with stray
quotes in unquoted cells need ``load_table``.  The state table, one row a range, is what is
broadcast: a few bytes for each ``spark.sql.files.maxPartitionBytes`` of input.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MARKS = re.compile(r'\\.|["{}\[\]]', re.S)
CUT = "file string, start long, kind string, first boolean, record string"


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, start, value``: the pieces of each byte range in their order."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_range(batches):
    """``(file, start, values)`` of the pieces of an Arrow stream, one range after the other."""
    for batch in batches:
        files, starts, values = (batch.column(i).to_pylist() for i in range(3))
        lo = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or files[i] != files[lo] or starts[i] != starts[lo]:
                yield files[lo], starts[lo], values[lo:i]
                lo = i


class CsvCutter:
    """Records of the lines of a range; ``state``: whether it begins inside quotes."""

    separator, joint = "\n", "\n"

    def __init__(self, state):
        self.open = bool(state[0])
        self.before, self.held = self.open, []

    def feed(self, line: str):
        self.held.append(line)
        self.open ^= line.count('"') & 1 == 1
        return not self.open

    @staticmethod
    def measure(values):
        n = sum(v.count('"') for v in values) & 1
        return n, 0, 0


class JsonCutter:
    """Objects of a JSON array from the pieces before each ``}``; ``state``: whether the range begins
    inside a string, and its depth."""

    separator, joint = "}", ""

    def __init__(self, state):
        self.string, self.depth = bool(state[0]), state[1]
        self.before, self.held = self.depth >= 2, []
        self.open = self.before

    def feed(self, piece: str):
        piece += "}"
        begin = 0
        for m in MARKS.finditer(piece):
            c = m[0]
            if c == '"':
                self.string = not self.string
            elif self.string or len(c) > 1:
                continue
            elif c in "{[":
                if c == "{" and self.depth == 1:
                    begin, self.open = m.start(), True
                self.depth += 1
            else:
                self.depth -= 1
        if self.open:
            self.held.append(piece[begin:])
        if self.open and self.depth <= 1 and not self.string:
            self.open = False
            return True
        return False

    @staticmethod
    def measure(values):
        """Quotes, and the change of depth if the range begins outside or inside a string."""
        quotes, depth = 0, [0, 0]
        for v in values:
            for m in MARKS.finditer(v + "}"):
                c = m[0]
                if c == '"':
                    quotes ^= 1
                elif len(c) == 1:  # counts for the case in which this place lies outside a string
                    depth[quotes] += 1 if c in "{[" else -1
        return quotes, depth[0], depth[1]


def _measure(cutter):
    def run(batches):
        total, at = None, None
        for file, start, values in _by_range(batches):
            found = cutter.measure(values)
            if at == (file, start):
                q, a, b = total
                total = (q ^ found[0], a + found[1 + q], b + found[2 - q])
            else:
                if at:
                    yield _row(at, total)
                at, total = (file, start), found
        if at:
            yield _row(at, total)

    def _row(at, total):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*at, *total), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                          ["file", "start", "quotes", "outside", "inside"])
    return run


def range_states(lines: DataFrame, cutter) -> dict:
    """``(quoted, depth)`` at the beginning of each range, by ``(file, start)``."""
    found = lines.mapInArrow(_measure(cutter), "file string, start long, quotes int, outside long, inside long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    found = found.withColumn("change", F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside")))
    found = found.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    return {(r.file, r.start): (r.quoted, r.depth) for r in found.select("file", "start", "quoted", "depth").collect()}  # one row a range


def _cut(cutter, shared):
    def run(batches):
        at, c, first = None, None, False

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()))],
                                              ["file", "start", "kind", "first", "record"])

        def rest():
            return [(*at, "middle" if c.before else "tail", first, c.joint.join(c.held))] if c and c.held and c.open else []

        for file, start, values in _by_range(batches):
            rows = []
            if at != (file, start):
                rows += rest()
                at, first = (file, start), start == 0
                c = cutter(shared.value[at])
            for v in values:
                if c.feed(v):
                    rows.append((*at, "head" if c.before else "whole", first, c.joint.join(c.held)))
                    c.held, c.before, first = [], False, False
            if rows:
                yield out(rows)
        if rows := rest():
            yield out(rows)
    return run


def records(spark: SparkSession, path: str, cutter) -> DataFrame:
    """``record, first``: the records of all files; ``first`` marks a file's first one."""
    lines = pieces(spark, path, cutter.separator)
    shared = spark.sparkContext.broadcast(range_states(lines, cutter))
    rows = lines.mapInArrow(_cut(cutter, shared), CUT)
    whole = rows.where("kind = 'whole'").select("record", "first")
    parts = rows.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == "tail").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("of", F.max(F.when(F.col("kind") == "tail", F.col("start"))).over(order))
    joined = parts.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("start", "record", "first"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["record"]), cutter.joint)
    return whole.unionByName(joined.select(text.alias("record"), F.exists("p", lambda x: x["first"]).alias("first")))


def read_csv_ranges(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """A quoted CSV file or folder with header rows, all columns as text, read by as many tasks as it
    has byte ranges; equal to the multi-line reader."""
    given = {"header": "true", "multiLine": "true", "escape": '"', **(options or {})}
    names = spark.read.options(**given).csv(path).columns
    rows = records(spark, path, CsvCutter).where(~F.col("first")).select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    parsed = rows.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {k: v for k, v in given.items() if k != "header"}).alias("r"))
    return parsed.select("r.*").toDF(*names)


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of files that hold one JSON array each, read by as many tasks as they have byte
    ranges; equal to the multi-line reader."""
    return records(spark, path, JsonCutter).select(F.from_json("record", schema).alias("r")).select("r.*")
