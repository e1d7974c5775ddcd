"""Dictionary taggers: single words (T2: P8, J1, F19), phrases (T1: J2, F16, F17),
their union in label order (T3, O1), NER candidate merge (W2) and label counts (A3).

All taggers read chunk rows ``(doc_id, chunk_no, text)`` and emit long label rows
``(doc_id, chunk_no, start, end, entity, text, origin, ...)``.  Tokens without offsets meet
the dictionary first; offsets are computed for hits only.  A dictionary within the broadcast
bound (bytes, known when it is built) is broadcast, so tagging is one map-only stage; a larger
one is joined on salted keys with token rows that carry no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import find_spans, phrase_word_spans
from ..functions.terms import find_phrases
from ..functions.text import WORD_CLASS, WORD_EDGE, WORD_TOKEN_PATTERN, key_pattern, normalize_word
from ..session import fits_broadcast

KEYS = ["doc_id", "chunk_no"]
ORIGIN_PHRASE, ORIGIN_WORD = 0, 1
# word runs, and runs of signs for phrases made of signs only
PROBE_PATTERN = rf"{WORD_TOKEN_PATTERN}|[^\p{{L}}\p{{N}}_\s]+"
SALTS = 16
# a lookup of at most so many bytes (some 200 terms) is also searched as one pattern before chunks are cut into tokens
PATTERN_MAX_BYTES = 64 << 10


def quoted(c):
    """A string column as a regex literal."""
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def word_lookup(dictionary: DataFrame, exclusions: DataFrame | None = None) -> DataFrame:
    """J1 + P8 on the dimension side: ``(term, label, priority)`` with the highest-priority
    category per term and excluded terms removed (exclusion is tested first)."""
    d = dictionary
    if exclusions is not None:
        d = d.join(exclusions.select("term").distinct(), "term", "left_anti")
    return d.groupBy("term").agg(
        F.min_by("label", "priority").alias("label"), F.min("priority").alias("priority"))


def phrase_table(dictionary: DataFrame) -> DataFrame:
    """J2 dimension side: multi-word terms with their regex, prefilter key and word runs.

    Pattern: the words, quoted, with white space between and a word edge at both ends,
    case-insensitive.  Key: the first word run of the phrase, lower-cased; every match holds it
    as a complete token.  A phrase without word characters has its first word as key: a word
    character must stand before it and white space after, so it is a complete run of signs.
    ``words`` are all word runs; a text without one of them cannot match.  The pattern first looks
    for the first word, so the edges are tried where it stands only.
    """
    p = dictionary.where(F.instr(F.trim("term"), " ") > 0)
    parts = F.split(F.trim("term"), r"\s+")
    runs = F.regexp_extract_all(F.lower("term"), F.lit(WORD_TOKEN_PATTERN), 0)
    return p.select(
        "term", "label", "priority",
        F.concat(F.lit("(?iuU)(?="), quoted(F.get(parts, F.lit(0))), F.lit(f"){WORD_EDGE}"), F.array_join(F.transform(parts, quoted), r"\s+"), F.lit(WORD_EDGE)).alias("pattern"),
        F.coalesce(F.get(runs, F.lit(0)), F.get(parts, F.lit(0))).alias("key"), runs.alias("words"))


def lookup_table(dictionary: DataFrame, exclusions: DataFrame | None = None, kinds: str = "wp") -> DataFrame:
    """One dimension table for both taggers: ``kind`` 'w' rows map a word to its label
    (J1 + P8), ``kind`` 'p' rows map a phrase key to a phrase, its regex and words (J2)."""
    words = word_lookup(dictionary, exclusions).select(
        F.lit("w").alias("kind"), F.col("term").alias("key"), "term", "label", "priority", F.lit(None).cast("string").alias("pattern"),
        F.array().cast("array<string>").alias("words"))
    phrases = phrase_table(dictionary).select(F.lit("p").alias("kind"), "key", "term", "label", "priority", "pattern", "words")
    both = words.unionByName(phrases)
    return both if kinds == "wp" else both.where(F.col("kind") == kinds)


def lookup_keys(lookup: DataFrame) -> list[str]:
    """The distinct keys of a lookup of known size, read by a small job when the plan is built."""
    return [r.key for r in lookup.select("key").distinct().collect()]


def may_hit(keys: list[str]) -> Column:
    """Whether one of ``keys`` may stand in ``text`` as a token: false for ASCII texts without any, true for
    all others (elsewhere letter case depends on the neighbours)."""
    return (F.octet_length("text") != F.length("text")) | F.lower(F.concat(F.lit(" "), "text")).rlike(key_pattern(keys))


def dictionary_hits(chunks: DataFrame, lookup: DataFrame, lookup_bytes: int | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Chunks joined with the lookup rows that one of their tokens meets, one row per distinct
    hit: ``KEYS, text, kind, term, label, priority, pattern``.

    A word hit's pattern is the token itself between non-word characters; a phrase is kept
    only if the chunk holds all its words.  Without a proven size the lookup is not broadcast:
    ``(kind, key)`` is salted, so a word that stands in every chunk is dealt over ``SALTS``
    tasks, and the hits (no text in them) are joined back to the chunks.  ``carry`` names
    further columns of the lookup to be kept.

    With a small lookup only chunks that may hold one of its keys (``may_hit``) are cut into tokens, and
    only tokens that are keys become rows (a row carries the chunk's text and tokens).
    """
    met = F.col("lows")
    if lookup_bytes is not None and lookup_bytes <= PATTERN_MAX_BYTES:
        keys = lookup_keys(lookup)
        chunks = chunks.where(may_hit(keys))
        met = F.filter("lows", lambda t: t.isin(*keys)) if keys else F.array().cast("array<string>")
    toks = chunks.select(*KEYS, "text", F.array_distinct(F.regexp_extract_all("text", F.lit(PROBE_PATTERN), 0)).alias("toks"))
    low = toks.withColumn("lows", F.array_distinct(F.transform("toks", lambda t: F.lower(t))))
    whole = F.forall("words", lambda w: F.array_contains(F.col("lows"), w))
    word_pattern = F.concat(F.lit("(?="), quoted(F.col("word")), F.lit(f")(?<!{WORD_CLASS})"), quoted(F.col("word")), F.lit(f"(?!{WORD_CLASS})"))
    out = [*KEYS, "text", "kind", "term", "label", "priority", *carry, F.when(F.col("kind") == "w", word_pattern).otherwise(F.col("pattern")).alias("pattern")]
    if fits_broadcast(lookup_bytes):
        # an optimiser barrier above and below the join: the tokens are cut once, and the join, free of
        # array functions, passes the text on without a copy per token
        part = F.spark_partition_id().alias("_part")
        rows = low.select(*KEYS, "text", "toks", "lows", part).where("_part >= 0").select(*KEYS, "text", "toks", "lows", F.explode(met).alias("key"))
        hits = rows.join(F.broadcast(lookup), "key").select("*", part).where((F.col("_part") >= 0) & whole)
        own = F.filter("toks", lambda t: normalize_word(t) == F.col("key"))
        word = F.explode(F.when(F.col("kind") == "w", own).otherwise(F.array(F.lit(None).cast("string")))).alias("word")
        return hits.select(*KEYS, "text", "kind", "term", "label", "priority", *carry, "pattern", word).select(*out)
    probes = F.concat(
        F.transform("toks", lambda t: F.struct(F.lit("w").alias("kind"), normalize_word(t).alias("key"), t.alias("word"))),
        F.transform("lows", lambda t: F.struct(F.lit("p").alias("kind"), t.alias("key"), F.lit(None).cast("string").alias("word"))))
    salt = F.pmod(F.xxhash64(*KEYS), F.lit(SALTS)).cast("int").alias("salt")
    rows = low.select(*KEYS, salt, F.explode(probes).alias("q")).select(*KEYS, "salt", "q.*")
    salted = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = rows.join(salted, ["kind", "key", "salt"]).drop("key", "salt")
    return low.select(*KEYS, "text", "lows").join(hits, KEYS).where(whole).select(*out)


def tag_chunks(chunks: DataFrame, dictionary: DataFrame, exclusions: DataFrame | None = None,
               dict_bytes: int | None = None, reviewed: bool = False, kinds: str = "wp",
               keep_text: bool = False, lookup: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """T3 in one pass over the chunks: word labels and phrase labels together.

    Each chunk is cut into tokens once; ``dictionary_hits`` finds the terms, and each term's
    pattern gives the spans, so offsets cost work for hits only.  ``reviewed`` gives one span
    per phrase match with the training type (D2) instead of B/I word labels.  Matches of one
    phrase never overlap, overlaps across phrases are kept (F16).  ``keep_text`` adds
    ``chunk_text``, for callers that group the labels beside it.  A ``lookup`` made by the caller
    replaces the dictionary's; its columns ``carry`` come with the labels.
    """
    from .dataset import alias_type

    hits = dictionary_hits(chunks, lookup_table(dictionary, exclusions, kinds) if lookup is None else lookup, dict_bytes, carry)
    is_word = F.col("kind") == "w"
    text = [F.col("text").alias("chunk_text")] if keep_text else []
    kept = [*(["chunk_text"] if keep_text else []), *carry]
    matched = hits.select(*KEYS, *text, *carry, "kind", "term", "label", "priority", F.posexplode(find_spans("text", F.col("pattern"))).alias("match_no", "m"))
    pieces = F.array(F.col("m")) if reviewed else F.when(is_word, F.array(F.col("m"))).otherwise(
        phrase_word_spans(F.col("m.text"), F.col("m.start")))
    cut = matched.select(*KEYS, *kept, "kind", "term", "label", "priority", "match_no", F.posexplode(pieces).alias("piece_no", "w"))
    if reviewed:
        entity = alias_type(F.col("label"))
    else:
        entity = F.concat(F.when(is_word | (F.col("piece_no") == 0), F.lit("B-")).otherwise(F.lit("I-")), F.col("label"))
    return cut.select(
        *KEYS, F.col("w.start").alias("start"), F.col("w.end").alias("end"), entity.alias("entity"), F.col("w.text").alias("text"),
        F.when(is_word, F.lit(ORIGIN_WORD)).otherwise(F.lit(ORIGIN_PHRASE)).alias("origin"),
        "priority", "term", F.when(is_word, F.lit(0)).otherwise(F.col("match_no")).alias("match_no"),
        F.when(is_word, F.lit(0)).otherwise(F.col("piece_no")).alias("word_no"), *kept)


def tag_words(chunks: DataFrame, dictionary: DataFrame, exclusions: DataFrame | None = None,
              candidates: DataFrame | None = None, dict_bytes: int | None = None) -> DataFrame:
    """Label single words by dictionary lookup (the candidate's own label is ignored).

    Candidates are all word tokens of the chunk by default, or merged NER pieces
    (``candidates``, see ``merge_candidates``)."""
    if candidates is None:
        return tag_chunks(chunks, dictionary, exclusions, dict_bytes, kinds="w")
    lookup = word_lookup(dictionary, exclusions)
    words = merge_candidates(candidates).select(*KEYS, F.col("seq").alias("word_no"), F.col("word").alias("text"), "start", "end")
    words = words.withColumn("term", normalize_word("text"))
    if fits_broadcast(dict_bytes):
        hit = words.join(F.broadcast(lookup), "term")
    else:
        salted = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = words.withColumn("salt", F.pmod(F.xxhash64(*KEYS), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"])
    return hit.select(*KEYS, "start", "end", F.concat(F.lit("B-"), "label").alias("entity"), "text", F.lit(ORIGIN_WORD).alias("origin"), "priority", "term",
                      F.lit(0).alias("match_no"), F.lit(0).alias("word_no"))


def tag_phrases(chunks: DataFrame, dictionary: DataFrame, dict_bytes: int | None = None) -> DataFrame:
    """Phrase matches cut into word labels, B on the first word and I on the rest."""
    return tag_chunks(chunks, dictionary, None, dict_bytes, kinds="p")


def tag_many_phrases(chunks: DataFrame, dictionary: DataFrame) -> DataFrame:
    """T1 for large dictionaries: the rows of ``tag_phrases`` from one automaton pass over each
    chunk, however many phrases there are; no regex is run and no chunk is joined."""
    rows = dictionary.where(F.instr(F.trim("term"), " ") > 0).select("term", "label", F.col("priority").cast("int")).toArrow()  # a dimension table
    phrases = list(zip(*(rows.column(i).to_pylist() for i in range(3))))
    found = chunks.select(*KEYS, F.explode(find_phrases(chunks, "text", phrases)).alias("m"))
    prefix = F.when(F.col("m.word_no") == 0, F.lit("B-")).otherwise(F.lit("I-"))
    return found.select(*KEYS, "m.start", "m.end", F.concat(prefix, "m.label").alias("entity"), "m.text", F.lit(ORIGIN_PHRASE).alias("origin"),
                        "m.priority", "m.term", "m.match_no", "m.word_no")


def refine_labels(chunks: DataFrame, dictionary: DataFrame, exclusions: DataFrame | None = None,
                  candidates: DataFrame | None = None, dict_bytes: int | None = None) -> DataFrame:
    """Phrase labels and word labels as one bag (duplicates and overlaps kept).

    Without NER candidates this is the single-pass ``tag_chunks``; with candidates the
    word labels come from the merged candidates instead of the chunk's tokens."""
    if candidates is None:
        return tag_chunks(chunks, dictionary, exclusions, dict_bytes)
    return tag_phrases(chunks, dictionary, dict_bytes).unionByName(
        tag_words(chunks, dictionary, exclusions, candidates, dict_bytes))


def reviewed_spans(chunks: DataFrame, dictionary: DataFrame, exclusions: DataFrame | None = None,
                   candidates: DataFrame | None = None, dict_bytes: int | None = None) -> DataFrame:
    """Entity spans in the training label space, as a reviewed export holds them:
    one span per phrase match (not per word) and one per tagged word; ``entity`` is the
    type without prefix, mapped by the label alias table."""
    from .dataset import alias_type

    if candidates is None:
        return tag_chunks(chunks, dictionary, exclusions, dict_bytes, reviewed=True)
    wd = tag_words(chunks, dictionary, exclusions, candidates, dict_bytes).withColumn(
        "entity", alias_type(F.col("entity")))
    return tag_chunks(chunks, dictionary, None, dict_bytes, reviewed=True, kinds="p").unionByName(wd)


def label_order():
    """O1: total order of labels inside a chunk: start, phrases before words, category
    priority, term, match and word number."""
    return ["start", "origin", "priority", "term", "match_no", "word_no"]


def merge_candidates(cands: DataFrame) -> DataFrame:
    """Join ``##`` pieces of NER candidates into words with offsets.

    Input ``(doc_id, chunk_no, seq, word, entity, start)``.  A group starts at each piece
    without ``##``; the leading ``##`` run (group 0), groups whose first piece has no
    start and words that come out empty are dropped; the first piece's entity wins; ``end = start + len(word)``.
    """
    w = Window.partitionBy(*KEYS).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    is_head = ~F.col("word").startswith("##")
    g = cands.withColumn("grp", F.sum(is_head.cast("int")).over(w)).withColumn(
        "piece", F.when(is_head, F.col("word")).otherwise(F.expr("substring(word, 3)")))
    merged = g.where("grp > 0").groupBy(*KEYS, "grp").agg(
        F.min("seq").alias("seq"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "piece"))),
                                 lambda s: s["piece"]), "").alias("word"),
        F.min_by("entity", "seq").alias("entity"),
        F.min_by("start", "seq").alias("start"),
    )
    return merged.where(F.col("start").isNotNull() & (F.col("word") != "")).select(
        *KEYS, "seq", "word", "entity", "start", (F.col("start") + F.length("word")).alias("end"))


def entity_counts(labels: DataFrame) -> DataFrame:
    """A3: label frequency over all records (partial aggregate before the exchange)."""
    return labels.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
