"""WARC archives and the external merge of their capture indexes.

``write_archives`` writes one WARC record per capture; each archive file is sorted by URL
key and timestamp, so its index is a locally sorted capture run.  ``read_archives`` streams
the files back into index rows, holding one record at a time.  ``merge_runs`` cuts the key space into ranges and merges,
in each range, the slices of all runs with a loser tree: range number and position give
the global order of captures by URL key and timestamp.

Defined cases: a null payload is empty; a null url has the key ``-``; a null id is written
without an id and comes back null; rows with equal id and payload are equal records (each is
written); an empty table gives archives without records and an empty index.  Dates are written as
``2000-01-31T12:00:00Z`` and indexed as 14 digits; a time stamp in neither form stays as it is.
Offsets and lengths count bytes of the unpacked archive.  Only the named columns are read, so
extra columns never clash.
"""

from __future__ import annotations

import hashlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, written

CRLF = "\r\n"
RECORDS_PER_FILE = 2000  # archives roll, so that many tasks can read them back
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
STAMP, DATE = r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", r"^(\d{4})-(\d\d)-(\d\d)T(\d\d):(\d\d):(\d\d)Z$"
INDEX = ("id long, url string, urlkey string, ts string, record_type string, refers_to long, "
         "digest string, payload_bytes long, file string, seq long, offset long, length long")


def url_key(url):
    """Sort-friendly key: reversed host, then path and query, all lower case."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1)), r"^www\d*\.", "")
    rest = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                   F.when(rest == "", F.lit("/")).otherwise(rest))
    return F.when(url.isNull(), F.lit("-")).when(host == "", F.lower(url)).otherwise(key)


def _stamp(id_col):
    """A made-up time for captures that have none: seconds after 2000 by id."""
    return F.date_format(F.timestamp_seconds(F.lit(946684800) + F.pmod(F.col(id_col), F.lit(1 << 31))), "yyyyMMddHHmmss")


def captures(pages: DataFrame, id_col: str, url_col: str, body_col: str, ts=None,
             min_bytes: int = 1000) -> DataFrame:
    """Capture rows with payload digest and record type.

    Among records with equal payloads of at least ``min_bytes`` bytes the largest id is the
    response and the others revisit it; smaller payloads are all responses.  The choice
    needs a digest-to-largest-id table only, aggregated before its shuffle; a payload held
    by a large share of the rows leaves one row per task there.  The table is written, so that
    the join back has an exchange on both sides, which the adaptive skew join can split.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.col(url_col), r"[\r\n]", "").alias("url"), body.alias("body"),
        F.regexp_replace(_stamp(id_col) if ts is None else ts.cast("string"), DATE, "$1$2$3$4$5$6").alias("ts"))
    rows = rows.withColumns({"digest": F.sha1(F.encode("body", "UTF-8")), "payload_bytes": F.octet_length("body").cast("long"),
                             "urlkey": url_key(F.col("url"))})
    keyed = pages.select(F.col(id_col).cast("long").alias("id"), body.alias("body")).where(
        F.octet_length("body") >= min_bytes).select(F.sha1(F.encode("body", "UTF-8")).alias("digest"), "id")
    firsts = keyed.groupBy("digest").agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(written(firsts, "firsts"), "digest", "left")
    revisit = F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    return rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("top"))).drop("top")


def record(c=F.col):
    """One WARC record without the two line ends that close it."""
    head = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), c("record_type"),
        F.when(c("id").isNotNull(), F.concat(F.lit(CRLF + "WARC-Record-ID: <urn:capture:"), c("id").cast("string"), F.lit(">"))).otherwise(""),
        F.when(c("url").isNotNull(), F.concat(F.lit(CRLF + "WARC-Target-URI: "), c("url"))).otherwise(""),
        F.when(c("ts").isNotNull(), F.concat(F.lit(CRLF + "WARC-Date: "), F.regexp_replace(c("ts"), STAMP, "$1-$2-$3T$4:$5:$6Z"))).otherwise(""),
        F.lit(CRLF + "X-URL-Key: "), c("urlkey"),
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), c("digest"),
        F.lit(CRLF + "X-Payload-Length: "), c("payload_bytes").cast("string"),
        F.when(c("refers_to").isNotNull(), F.concat(F.lit(CRLF + "WARC-Refers-To: <urn:capture:"), c("refers_to").cast("string"), F.lit(">"))).otherwise(""))
    full = c("record_type") == "response"
    size = F.when(full, c("payload_bytes") + len(HTTP_HEAD)).otherwise(0).cast("string")
    block = F.when(full, F.concat(F.lit(HTTP_HEAD), c("body"))).otherwise("")
    return F.concat(head, F.lit(CRLF + "Content-Length: "), size, F.lit(CRLF + CRLF), block)


def write_archives(caps: DataFrame, path: str) -> None:
    """Sorted WARC files (gzip) below ``path``, written by Spark's text writer."""
    caps.sortWithinPartitions("urlkey", "ts", "id").select(record().alias("value")).write.option(
        "lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_warc(lines):
    """``(offset, length, headers, payload)`` of each record of an archive, given as an iterable of
    its lines (bytes, each without its line feed).  Records end by Content-Length, whatever their
    payload holds."""
    at, lines = 0, iter(lines)
    for line in lines:
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        start, heads = at, {}
        at += len(line) + 1
        while (line := next(lines, b"\r")) != b"\r":
            name, value = line[:-1].decode("utf-8").split(": ", 1)
            heads[name] = value
            at += len(line) + 1
        at += 2
        size, held, got = int(heads.get("Content-Length", -1)), [], 0
        if size < 0:
            raise ValueError(f"record at byte {start} has no Content-Length")
        while got < size + 4:
            if (line := next(lines, None)) is None:
                raise ValueError(f"record at byte {start} is cut off")
            held.append(line)
            got += len(line) + 1
        block, closing = (whole := b"\n".join(held))[:size], whole[size:]
        if closing != b"\r\n\r":  # its line feed was cut with the line
            raise ValueError(f"record at byte {start} does not end by its Content-Length")
        at += got
        yield start, at - start, heads, block.split(b"\r\n\r\n", 1)[1] if size else b""


def _urn(x):
    return int(x.rsplit(":", 1)[1].rstrip(">")) if x else None


def _index_lines(batches):
    fields = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in INDEX.split(", ")])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=fields)
    lines = (x for batch in batches for x in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()))
    rows = []
    for file, own in groupby(lines, itemgetter(0)):
        for seq, (offset, length, h, body) in enumerate(parse_warc(map(itemgetter(1), own))):
            digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
            n = int(h["X-Payload-Length"])
            if h["WARC-Type"] == "response" and (len(body) != n or hashlib.sha1(body).hexdigest() != digest):
                raise ValueError(f"payload of record {seq} of {file} does not match its digest")
            rows.append((_urn(h.get("WARC-Record-ID")), h.get("WARC-Target-URI"), h["X-URL-Key"], h.get("WARC-Date"), h["WARC-Type"],
                         _urn(h.get("WARC-Refers-To")), digest, n, file, seq, offset, length))
            if len(rows) == RECORDS_PER_FILE:
                yield batch_of(rows)
                rows = []
    yield batch_of(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index rows (one per record, in file order) of all archives below ``path``.

    A packed archive is one split of Spark's text source, so a task gets its lines in order, in
    Arrow batches that Spark bounds by bytes."""
    files = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    lines = files.select(F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_index_lines, INDEX).withColumn("ts", F.regexp_replace("ts", DATE, "$1$2$3$4$5$6"))


class LoserTree:
    """Tournament of ``k`` sorted runs: inner nodes keep the loser of their match, so taking
    the next row replays only the path from its run's leaf to the root."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.tree = [0] * max(1, self.k)
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            if self._before(b, a):
                a, b = b, a
            winners[node], self.tree[node] = a, b
        self.tree[0] = winners[1] if self.k > 1 else 0

    def _before(self, a, b):
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y

    def __iter__(self):
        if not self.k:
            return
        while (top := self.heads[win := self.tree[0]]) is not None:
            yield top
            self.heads[win] = next(self.runs[win], None)
            node = (win + self.k) // 2
            while node:
                if self._before(self.tree[node], win):
                    self.tree[node], win = win, self.tree[node]
                node //= 2
            self.tree[0] = win


def _merge(batches):
    from pyspark import TaskContext

    rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if rows is None or not rows.num_rows:
        return
    keys = list(zip(rows["urlkey"].to_pylist(), (x or "" for x in rows["ts"].to_pylist()),
                    ((x is not None, x or 0) for x in rows["id"].to_pylist()), range(rows.num_rows)))
    file = rows["file"].to_pylist()
    cuts = [0] + [i for i in range(1, len(file)) if file[i] != file[i - 1]] + [len(file)]
    order = [key[3] for key in LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:])])]
    out = rows.take(pa.array(order))
    out = out.append_column("range_no", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32()))
    yield from out.append_column("pos", pa.array(range(len(order)), pa.int64())).combine_chunks().to_batches()


def merge_runs(index: DataFrame) -> DataFrame:
    """Merge the sorted run of each file; adds ``range_no`` and ``pos`` (global order).

    Ranges split on the whole order (key, timestamp, id), so one URL captured in a third of all
    rows still spreads over many ranges.  A task holds one range of index rows, no payloads.
    """
    index = written(index, "capture-runs")  # read twice: range bounds, then the merge
    ranged = index.repartitionByRange("urlkey", F.coalesce("ts", F.lit("")), "id", "file", "seq")
    return ranged.sortWithinPartitions("file", "seq").mapInArrow(_merge, INDEX + ", range_no int, pos long")


def archive_and_merge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                      ts=None, path: str | None = None) -> DataFrame:
    """Write archives of ``pages``, read them back and return the merged capture index."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(captures(pages, id_col, url_col, body_col, ts), path)
    return merge_runs(read_archives(spark, path))
