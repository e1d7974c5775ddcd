"""Regex matches with character spans.

``find_spans`` finds the matches of a pattern with built-ins: ``split(text, re, -1)`` gives the
gaps between matches and ``regexp_extract_all`` the matches, both driven by the same
left-to-right search; running sums of their lengths are the 0-based, half-open
``[start, end)`` offsets, counted in code points.  ``token_spans`` finds all words of a row.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<text:string,start:int,end:int>>"


def _pattern(p: Column | str) -> Column:
    return F.lit(p) if isinstance(p, str) else p


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable, so ``body`` can
    use it several times without the expression being re-evaluated (nor inlined by the
    optimiser into an inner loop)."""
    return F.element_at(F.transform(F.array(value), body), 1)


SUM_BLOCK = 64


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x)


def running_sum(values: Column, body) -> Column:
    """``body(f)`` where ``f(i)`` is the sum of ``values[0..i]``: totals of blocks of
    ``SUM_BLOCK`` values are summed once, so one sum adds at most one block."""
    def with_blocks(v):
        last = F.floor((F.size(v) - 1) / F.lit(SUM_BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                             lambda b: _total(F.slice(v, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))

        def with_totals(t):
            before = F.transform(t, lambda _x, b: _total(F.slice(t, F.lit(1), b)))

            def up_to(base):
                def f(i):
                    b = F.floor(i / F.lit(SUM_BLOCK)).cast("int")
                    return F.get(base, b) + _total(F.slice(v, b * SUM_BLOCK + 1, i - b * SUM_BLOCK + 1))
                return f

            return let(before, lambda base: body(up_to(base)))

        return let(blocks, with_totals)

    return let(values, with_blocks)


def find_spans(c: Column | str, pattern: Column | str) -> Column:
    """F16: all non-overlapping matches as ``array<struct<text, start, end>>``.

    ``pattern`` may be a literal or a column.  Only for patterns that cannot match the empty
    string.  ``split`` gives the gaps between the matches; the end of match ``i`` is the sum of
    gap and match lengths up to ``i``.  Used where few rows or few matches are expected (phrase
    candidates); whole token rows use ``token_spans``.
    """
    text = F.col(c) if isinstance(c, str) else c
    pat = _pattern(pattern)

    def spans(m):
        steps = F.zip_with(F.slice(F.split(text, pat, -1), F.lit(1), F.size(m)), m, lambda g, x: F.length(g) + F.length(x))
        return running_sum(steps, lambda end: F.transform(m, lambda x, i: F.struct(
            x.alias("text"), (end(i) - F.length(x)).alias("start"), end(i).alias("end"))))

    return let(F.regexp_extract_all(text, pat, 0), lambda m: F.when(
        F.size(m) == 0, F.array().cast(SPAN_TYPE)).otherwise(spans(m)))


@functools.lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    """Whether each code point is a word character (letter, number or underscore)."""
    return np.fromiter((chr(i).isalnum() or i == 95 for i in range(0x110000)), bool, 0x110000)


def batch_token_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``(row bounds, starts, ends, tokens)`` of a batch: offsets in code points per row."""
    joined = "".join(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(size)))
    inside = word_characters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    edge = np.zeros(len(joined) + 1, bool)
    edge[bounds] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    tokens = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    cut = np.searchsorted(starts, bounds)
    shift = np.repeat(bounds[:-1], np.diff(cut))
    return cut, starts - shift, ends - shift, tokens


ROWS_AT_ONCE = 256


def _span_arrays(texts: pa.Array) -> pa.Array:
    """Spans of an Arrow batch.  Only ``ROWS_AT_ONCE`` rows are Python strings at a time, so a worker
    holds the batch and its result as Arrow arrays, whatever the rows of a batch."""
    def part(rows: pa.Array) -> pa.Array:
        cut, starts, ends, tokens = batch_token_spans([t or "" for t in rows.to_pylist()])
        spans = pa.StructArray.from_arrays([pa.array(tokens, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["text", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), spans)

    return pa.concat_arrays([part(texts.slice(i, ROWS_AT_ONCE)) for i in range(0, max(len(texts), 1), ROWS_AT_ONCE)])


def token_spans(c: Column | str) -> Column:
    """F11 + F12: word tokens with offsets, ``array<struct<text, start, end>>``.

    Searching each token from the end of the previous one lands on the maximal word runs, so
    the run bounds are the offsets.  One Arrow batch is scanned at once with array operations;
    a null text has no tokens.
    """
    text = F.col(c) if isinstance(c, str) else c
    return F.arrow_udf(_span_arrays, SPAN_TYPE)(text)


def phrase_word_spans(match: Column, offset: Column) -> Column:
    """the words of one phrase match with absolute offsets.

    A phrase match is ``w1 \\s+ w2 ... wn``; the words are its non-space runs, shifted
    by the match start.  Equals a sequential ``find`` of the lower-cased words inside
    the match on lower-cased text.
    """
    inner = find_spans(match, r"\S+")
    return F.transform(
        inner,
        lambda w: F.struct(
            w["text"].alias("text"),
            (w["start"] + offset).alias("start"),
            (w["end"] + offset).alias("end"),
        ),
    )
