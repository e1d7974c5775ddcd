"""Helpers shared by the operators: table reading, written intermediates, array tokenising."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

# Bytes of text tokenised at once inside a task; a longer single text is one block.
BLOCK_BYTES = 1 << 19


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and reread it: computed once, and lost executors
    cost no recomputation of what lies before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that clash with no working column, and these names by the
    columns' own; columns named as one of ``added`` are left out, as the added one replaces them."""
    plain = [f"kept_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*plain), {c: p for p, c in zip(plain, docs.columns) if c not in added}


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """``(first row, row offsets, UTF-8 bytes)`` of runs of rows of about ``limit`` bytes.

    Works on the Arrow buffers, so no Python string is made.  A null text has no bytes.
    """
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    big = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offs = np.frombuffer(buffers[1], np.int64 if big else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, offs[lo:hi + 1] - offs[lo], data[offs[lo]:offs[hi]]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), wrapping on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# everything that is not a letter or digit in ASCII; other code points belong to words
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:0x30] = NOT_WORD[0x3A:0x41] = NOT_WORD[0x5B:0x61] = NOT_WORD[0x7B:0x80] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def block_words(offs: np.ndarray, data: np.ndarray, breaks: np.ndarray = SPACE, lower: bool = False, alone: np.ndarray | None = None):
    """Words of a block: ``(row, start, end, hash)``, byte positions within the block.

    A word is a run of bytes outside ``breaks`` within one row; ``lower`` folds A-Z; three-byte
    characters that begin with a byte of ``alone`` are words of their own.
    """
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none, none.astype(np.uint64)
    inside = ~breaks[data]
    first = np.zeros(len(data), bool)
    first[offs[:-1][offs[:-1] < len(data)]] = True
    if alone is not None:
        lead = alone[data]
        first |= lead
        first[3:] |= lead[:-3]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (first | ~before))
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    after = np.ones(len(data), bool)
    after[:-1] = ~inside[1:] | first[1:]
    ends = np.flatnonzero(inside & after) + 1
    row = np.searchsorted(offs, starts, "right") - 1
    length = ends - starts
    # bytes of all words, one after the other, with their position in the word
    at = np.flatnonzero(inside)
    begin = np.cumsum(length) - length
    place = np.arange(len(at)) - np.repeat(begin, length)
    raw = data[at]
    code = _BYTE_CODE[LOWER[raw] if lower else raw]
    code *= _powers(int(length.max()) + 1)[place]
    h = mix64(np.add.reduceat(code, begin) + length.astype(np.uint64))
    return row, starts, ends, h


def gram_hashes(row: np.ndarray, h: np.ndarray, n: int):
    """Hashes of runs of ``n`` words of one row: ``(index of the first word, hash)``."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = h[:m].copy()
    for j in range(1, n):
        g *= np.uint64(0xD6E8FEB86659FD93)
        g += h[j:j + m]
    ok = np.flatnonzero(row[:m] == row[n - 1:])
    return ok, mix64(g[ok])
