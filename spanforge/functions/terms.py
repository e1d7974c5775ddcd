"""Many search terms at once: one Aho-Corasick pass over each text.

The regex forms (one alternation of keywords, one pattern per phrase and chunk) cost time with the
number of terms.  Here all terms form one automaton, so a text is read once however many there
are.  The terms are broadcast in parts of at most ``BROADCAST_MAX_BYTES`` characters; each Python
worker builds a part's automaton once.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES

# Unicode white space, as a regex with Unicode classes takes it
BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
WORD = re.compile(r"[^ \t-\r]+")


class Fold(dict):
    """Case folding letter by letter (upper, then lower), so that offsets stay."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        up = c.upper() if len(c.upper()) == 1 else c
        low = up.lower() if len(up.lower()) == 1 else up
        self[code] = ord(low)
        return ord(low)


FOLD = Fold()


def is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def edge(text: str, i: int) -> bool:
    """Whether a word character and none meet at ``i``."""
    return (i > 0 and is_word(text[i - 1])) != (i < len(text) and is_word(text[i]))


KEPT: dict[str, object] = {}  # automata of this Python worker by key, the newest few


def _automaton(key: str, terms: list[str]):
    import ahocorasick

    if key not in KEPT:
        found = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            if term:
                found.add_word(term, (*found.get(term, ()), i))
        if len(found):
            found.make_automaton()
        if len(KEPT) >= 4:
            KEPT.pop(next(iter(KEPT)))
        KEPT[key] = found
    return KEPT[key]


def term_parts(spark, terms: list[str], limit: int = BROADCAST_MAX_BYTES):
    """``(offset, key, broadcast)`` of parts of the terms within ``limit`` bytes each."""
    part, size, first = [], 0, 0
    out = []
    for i, t in enumerate([*terms, None]):
        n = len((t or "").encode())
        if part and (t is None or size + n > limit):
            out.append((first, uuid.uuid4().hex, spark.sparkContext.broadcast(part)))
            part, size, first = [], 0, i
        if t is not None:
            part.append(t)
            size += n
    return out


def _holds(key, shared):
    def run(texts: pa.Array) -> pa.Array:
        a = _automaton(key, shared.value)
        return pa.array([None if t is None else next(a.iter(t.translate(FOLD)), None) is not None for t in texts.to_pylist()], pa.bool_())
    return run


def holds_any(spark, text: Column, keywords: list[str], limit: int = BROADCAST_MAX_BYTES) -> Column:
    """Whether a text holds one of ``keywords`` as a substring, case-insensitive; null for a null text.
    An empty keyword is held by every text."""
    if any(k == "" for k in keywords):
        return F.when(text.isNotNull(), F.lit(True))
    found = None
    for _first, key, shared in term_parts(spark, [k.translate(FOLD) for k in keywords], limit):
        one = F.arrow_udf(_holds(key, shared), "boolean")(text)
        found = one if found is None else found | one
    return F.when(text.isNotNull(), F.lit(False)) if found is None else found


def squeezed(text: str) -> tuple[str, list[int] | None]:
    """White space runs as one space each, and where each character stood (None: nowhere else)."""
    if not any(len(m[0]) > 1 or m[0] != " " for m in BLANK.finditer(text)):
        return text, None
    out, place, at = [], [], 0
    for m in BLANK.finditer(text):
        out += [text[at:m.start()], " "]
        place += [*range(at, m.start()), m.start()]
        at = m.end()
    return "".join([*out, text[at:]]), [*place, *range(at, len(text))]


def phrase_matches(text: str, automaton, phrases) -> list[dict]:
    """Words of the matches of all phrases in one text.  A match begins and ends at a word edge,
    ignores case and takes any white space between its words; matches of one phrase do not overlap."""
    flat, place = squeezed(text.translate(FOLD))
    hits = sorted((end + 1 - len(phrases[i][3]), end + 1, i) for end, ids in automaton.iter(flat) for i in ids) if len(automaton) else []
    last, count, out = {}, {}, []
    for a, b, i in hits:
        if a < last.get(i, 0) or not edge(flat, a) or not edge(flat, b):
            continue
        last[i], no = b, count.get(i, 0)
        count[i] = no + 1
        start, end = (a, b) if place is None else (place[a], place[b - 1] + 1)
        term, label, priority, _flat = phrases[i]
        for k, w in enumerate(WORD.finditer(text[start:end])):
            out.append({"term": term, "label": label, "priority": priority, "match_no": no, "word_no": k,
                        "start": start + w.start(), "end": start + w.end(), "text": w[0]})
    return out


MATCHES = "array<struct<term:string,label:string,priority:int,match_no:int,word_no:int,start:int,end:int,text:string>>"
MATCH_TYPE = pa.list_(pa.struct([("term", pa.string()), ("label", pa.string()), ("priority", pa.int32()), ("match_no", pa.int32()),
                                 ("word_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))


def _finds(key, shared, own):
    def run(batch: pa.Array) -> pa.Array:
        a = _automaton(key, shared.value)
        return pa.array([[] if t is None else phrase_matches(t, a, own.value) for t in batch.to_pylist()], MATCH_TYPE)
    return run


def find_phrases(texts: DataFrame, text: str, phrases: list[tuple[str, str, int]], limit: int = BROADCAST_MAX_BYTES) -> Column:
    """``MATCHES`` of each text: the words of every match of ``phrases`` (``term, label, priority``)."""
    spark = texts.sparkSession
    rows = [(*p, " ".join(WORD.findall(p[0])).translate(FOLD)) for p in phrases]
    found = None
    for first, key, shared in term_parts(spark, [r[3] for r in rows], limit):
        own = spark.sparkContext.broadcast(rows[first:first + len(shared.value)])
        one = F.arrow_udf(_finds(key, shared, own), MATCHES)(F.col(text))
        found = one if found is None else F.concat(found, one)
    return F.array().cast(MATCHES) if found is None else found
