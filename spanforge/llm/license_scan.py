"""License scan: base phrases and an exact set-similarity join with notice templates.

Only DataFrame functions.  A **block** is a run of as many neighbouring words as the template has,
anywhere in the text, over line ends or within a long line.  It meets a template if its
containment, |block & template| over |template|, reaches the threshold, it holds the words that
tell the licence (``marks``), and it does not hold the further marks of another licence whose
marks include these (``nc`` for ``cc by``).  The tokens of all templates are ordered by how many
documents hold them (rarest first).  A block that meets the threshold holds at least one of the
template's first |T| - need + 1 tokens (prefix filter), so only the words around these are
taken from the text; a text with fewer than ``need`` words cannot (length filter), nor words around a
token that hold too few of the template's later ones (positional filter).  The blocks that
remain are counted exactly.

Templates are a parameter (``label, text, marks``; ``templates_of`` reads them from a table), a dimension
whose postings are joined with the words around prefix tokens; blocks never meet each other.
Rows are regrouped by id and a hash of the text.

Defined cases: a null or empty text has no words, no places and no labels; null ids are kept;
repeated rows each get the same result; an empty table gives no rows.  Added columns are
prefixed ``ls_``; only the named columns are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: phrases and labels of the base scan
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = (4, 5)  # containment of 0.8
# notice templates of the method: label, words, and the words that tell the licence
TEMPLATES = [
    ("agpl", "this work is licensed under the gnu affero general public license version 3", ("gnu", "general", "affero")),
    ("apache", "licensed under the apache license version 2 0", ("apache",)),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("compliance",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ("redistribution",)),
    ("cc-by", "licensed under cc by 4 0", ("cc", "by")),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("commons", "attribution")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc", "by", "nc")),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("commons", "attribution", "noncommercial")),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc", "by", "sa")),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("commons", "attribution", "sharealike")),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu", "general")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("gnu", "general")),
    ("lgpl", "this work is licensed under the gnu lesser general public license version 3", ("gnu", "general", "lesser")),
    ("mit", "released under the mit license", ("mit",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ("permission", "granted")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla",)),
    ("reserved", "copyright all rights reserved no part of this publication may be reproduced", ("reserved",)),
]


class Template(NamedTuple):
    label: str
    n: int  # words of a block
    tokens: list[str]  # distinct
    need: int  # of these
    marks: list[str]
    bars: list[list[str]]  # marks of others that a block must not hold all of


def template_sets(templates) -> list[Template]:
    num, den = THRESHOLD
    out = []
    for label, text, marks in templates:
        tokens = sorted(set(text.split()))
        bars = sorted({tuple(sorted(set(m) - set(marks))) for other, _t, m in templates if other != label and set(m) > set(marks)})
        out.append(Template(label, len(text.split()), tokens, -(-len(tokens) * num // den), sorted(marks), [list(b) for b in bars]))
    return out


def templates_of(rows: DataFrame) -> list[tuple]:
    """Templates from a table ``label, text, marks array<string>``; texts are folded like documents."""
    words = F.trim(spaced(F.col("text").cast("string")))
    got = rows.where("label IS NOT NULL AND text IS NOT NULL").select("label", words.alias("text"), F.coalesce("marks", F.array().cast("array<string>")).alias("marks"))
    return sorted((r.label, r.text, tuple(r.marks)) for r in got.where("text <> ''").distinct().collect())


def spaced(text):
    """The words of ``text``, A-Z lower-cased, with one space between, before and after."""
    flat = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS, " "))
    return F.concat(F.lit(" "), flat, F.lit(" "))


def _spaces(s):
    return F.length(s) - F.length(F.replace(s, F.lit(" ")))


def base_scan(rows: DataFrame) -> DataFrame:
    """Adds word count, places, first and last place and labels of the base phrases."""
    s = F.col("ls_words")
    any_phrase = F.lit(False)
    for p in PHRASES:
        any_phrase = any_phrase | F.contains(s, F.lit(f" {p} "))
    # cut before each place, so what precedes a cut counts the words before the place
    cut = r"(?= (?:" + "|".join(PHRASES) + r") )"
    rows = rows.withColumn("ls_parts", F.when(any_phrase, F.split(F.concat(F.lit("."), s), cut)))
    parts = F.col("ls_parts")
    labels = F.array_compact(F.array(*[F.when(F.contains(s, F.lit(f" {p} ")), F.lit(label)) for p, label in PHRASES.items()]))
    return rows.withColumns({
        "n_words": F.when(F.length(s) == 2, F.lit(0)).otherwise(_spaces(s) - 1).cast("long"),
        "n_base": F.coalesce(F.size(parts) - 1, F.lit(0)).cast("long"),
        "first_word": F.when(parts.isNotNull(), _spaces(F.get(parts, F.lit(0)))).cast("long"),
        "last_word": F.when(parts.isNotNull(), _spaces(s) - _spaces(F.element_at(parts, -1))).cast("long"),
        "ls_base": labels})


def token_order(rows: DataFrame, sets: list[Template]) -> list[str]:
    """Template tokens by the number of documents that hold them, rarest first."""
    vocab = sorted({t for x in sets for t in x.tokens})
    if not vocab:
        return []
    counts = rows.select(F.explode(F.array_intersect("ls_tokens", F.array(*[F.lit(t) for t in vocab]))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    n = {r.t: r.n for r in counts.collect()}  # at most one row per template token
    return sorted(vocab, key=lambda t: (n.get(t, 0), t))


def similar_blocks(rows: DataFrame, order: list[str], sets: list[Template]) -> DataFrame:
    """``(ls_id, ls_key, label, containment)``: blocks of the texts' words that meet a template."""
    if not sets:
        return rows.select("ls_id", "ls_key", F.lit("").alias("label"), F.lit(0.0).alias("containment")).where(F.lit(False))
    rank = {t: i for i, t in enumerate(order)}
    words = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    postings = []
    for x in sets:
        own = sorted(x.tokens, key=rank.get)
        bars = F.array(*[words(b) for b in x.bars]).cast("array<array<string>>")
        postings += [F.struct(F.lit(t).alias("token"), F.lit(i).alias("place"), F.lit(x.label).alias("label"), F.lit(x.need).alias("need"), F.lit(x.n).alias("n"),
                              words(own).alias("own"), words(x.marks).alias("marks"), bars.alias("bars")) for i, t in enumerate(own[:len(own) - x.need + 1])]
    index = rows.sparkSession.range(1).select(F.inline(F.array(*postings)))
    prefix = words(sorted({t for x in sets for t in sorted(x.tokens, key=rank.get)[:len(x.tokens) - x.need + 1]}))
    few, longest = min(x.need for x in sets), max(x.n for x in sets)
    texts = rows.where(F.arrays_overlap("ls_tokens", prefix) & (F.size("ls_tokens") >= few)).select("ls_id", "ls_key", "ls_tokens")
    # for each prefix token the words around it: ``at`` words before it, then as many after it as a block can have
    spots = F.filter(F.transform("ls_tokens", lambda t, i: F.when(F.array_contains(prefix, t), i)), lambda i: i.isNotNull())
    near = F.transform(spots, lambda i: F.struct(
        F.get("ls_tokens", i).alias("token"), F.least(i, F.lit(longest - 1)).alias("at"),
        F.slice("ls_tokens", F.greatest(i - (longest - 2), F.lit(1)), F.lit(2 * longest - 1)).alias("near")))
    pairs = texts.select("ls_id", "ls_key", F.explode(near).alias("r")).select("ls_id", "ls_key", "r.*").distinct().join(F.broadcast(index), "token")
    later = F.array_intersect(F.slice("own", F.col("place") + 1, F.size("own")), F.col("near"))
    pairs = pairs.where((F.size(later) >= F.col("need") - F.col("place")) & (F.size(F.array_intersect("own", "near")) >= F.col("need")))

    def held(b):
        def of(block):
            told = (F.size(F.array_except("marks", block)) == 0) & F.forall("bars", lambda x: F.size(F.array_except(x, block)) > 0)
            return F.when(told, F.size(F.array_intersect("own", block))).otherwise(0)

        return F.transform(F.array(F.slice("near", b + 1, F.col("n"))), of)[0]

    shared = F.array_max(F.transform(F.sequence(F.greatest(F.col("at") - F.col("n") + 1, F.lit(0)), F.col("at")), held))
    pairs = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    return pairs.select("ls_id", "ls_key", "label", (F.col("shared") / F.size("own")).alias("containment"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per row: words, base places and labels, all labels and the greatest containment found."""
    sets = template_sets(templates)
    rows = docs.select(F.col(id_col).alias("ls_id"), F.col(text_col).cast("string").alias("ls_text"))
    rows = rows.withColumn("ls_key", F.xxhash64("ls_text"))
    split = rows.select("ls_id", "ls_key", F.split(F.trim(spaced(F.col("ls_text"))), " ").alias("ls_tokens"))
    found = similar_blocks(split, token_order(split, sets), sets).groupBy("ls_id", "ls_key").agg(
        F.collect_set("label").alias("ls_more"), F.max("containment").alias("ls_best"))
    found = written(found, "licenses").withColumnsRenamed({"ls_id": "f_id", "ls_key": "f_key"})
    base = base_scan(rows.withColumn("ls_words", spaced(F.col("ls_text")))).drop("ls_text", "ls_words", "ls_parts")
    out = base.join(found, base.ls_id.eqNullSafe(found.f_id) & (base.ls_key == found.f_key), "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("ls_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("ls_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("ls_base", F.coalesce("ls_more", none)))), ",").alias("labels"),
        F.coalesce("ls_best", F.lit(0.0)).alias("score"))


def _sql_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _oracle():
    fold = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    starts = []
    for p in PHRASES:
        w = p.split()
        test = " AND ".join(f"ws[i + {k}] = '{x}'" for k, x in enumerate(w))
        starts.append(f"list_filter(range(1, len(ws) + 1), lambda i: {test})")
    label = [f"CASE WHEN len(p{i}) > 0 THEN '{x}' END" for i, x in enumerate(PHRASES.values())]
    bars = lambda x: "[" + ", ".join(_sql_list(b) for b in x.bars) + "]::VARCHAR[][]"
    templates = ", ".join(f"('{x.label}', {x.n}, {_sql_list(x.tokens)}, {x.need}, {_sql_list(x.marks)}::VARCHAR[], {bars(x)})" for x in template_sets(TEMPLATES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all({fold}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM d),
b AS (SELECT *, {', '.join(f'{x} AS p{i}' for i, x in enumerate(starts))} FROM w),
f AS (SELECT *, list_concat(p0, list_concat(p1, p2)) AS ps, list_filter([{', '.join(label)}], lambda x: x IS NOT NULL) AS bl FROM b),
t(label, n, own, need, marks, bars) AS (VALUES {templates}),
c AS (SELECT rid, ws, t.* FROM w, t WHERE len(list_intersect(own, ws)) >= need),
r AS (SELECT rid, label, own, need, marks, bars, ws[i + 1:i + n] AS block FROM (SELECT *, unnest(range(0, len(ws))) AS i FROM c)),
m AS (SELECT rid, label, len(list_intersect(own, block)) / CAST(len(own) AS DOUBLE) AS c FROM r
      WHERE len(list_intersect(own, block)) >= need AND list_has_all(block, marks) AND len(list_filter(bars, lambda x: list_has_all(block, x))) = 0),
g AS (SELECT rid, list(DISTINCT label) AS ml, max(c) AS best FROM m GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ps) AS BIGINT) AS n_base, list_min(ps) - 1 AS first_word, list_max(ps) - 1 AS last_word,
       array_to_string(list_sort(bl), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(bl, coalesce(ml, [])))), ',') AS labels, coalesce(best, 0.0::DOUBLE) AS score
FROM f LEFT JOIN g USING (rid)
"""


ORACLE = _oracle()
