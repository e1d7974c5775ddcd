"""DuckDB twins of the operators, as SQL text builders.

Each builder mirrors one operator with DuckDB's own functions (RE2 regexes, list
lambdas, windows), written independently of the Spark code path: the cleaning step
uses a look-around-free rewrite of the inner-dot rule, spans are recomputed with a
list fold, BIO tags with a containment join.  Used only to check results.
"""

from __future__ import annotations

import re

from ..functions.stopwords import NLTK_ENGLISH
from ..operators.sequence import bio_rules
from ..sources.dictionary import LABELS
from .fixtures import CHUNK_MAX_LEN, PRED_DICTIONARY, TEST_DICTIONARY, TEST_EXCLUSIONS, VOCABULARY_PATH, fixed_tagger, flat_dictionary


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]::VARCHAR[]"


SPAN_T = 'STRUCT(text VARCHAR, start INTEGER, "end" INTEGER)'


def spans_sql(text: str, pattern: str) -> str:
    """All matches of ``pattern`` in ``text`` with offsets, via split + extract + fold."""
    m = f"regexp_extract_all({text}, {pattern})"
    g = f"regexp_split_to_array({text}, {pattern})"
    st = "CAST(acc.pos + length(x.g) AS INTEGER)"
    en = "CAST(acc.pos + length(x.g) + length(x.m) AS INTEGER)"
    return (
        f"list_reduce(list_transform({m}, lambda m, i: {{'g': ({g})[i], 'm': m}}), "
        f"lambda acc, x: {{'pos': {en}, 'spans': list_append(acc.spans, "
        f"{{'text': x.m, 'start': {st}, 'end': {en}}})}}, "
        f"{{'pos': 0, 'spans': []::{SPAN_T}[]}}).spans"
    )


def inner_dots_sql(x: str) -> str:
    """F4 without look-around (valid on comma-free text free of '@')."""
    x = f"regexp_replace({x}, '(\\w)\\.{{3,}}( |$)', '\\1@@\\2', 'g')"
    x = f"regexp_replace({x}, '(\\w)\\.{{1,2}}( |$)', '\\1@\\2', 'g')"
    x = f"regexp_replace({x}, '(\\w)\\.{{2,}}', '\\1@', 'g')"
    x = f"regexp_replace({x}, '\\.+( |$)', '@\\1', 'g')"
    x = f"replace({x}, '.', '')"
    return f"replace({x}, '@', '.')"


def stopwords_sql(x: str, stop=None) -> str:
    stop = NLTK_ENGLISH if stop is None else stop
    return (f"array_to_string(list_filter(string_split({x}, ' '), "
            f"lambda w: NOT list_contains({str_list(stop)}, w)), ' ')")


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def clean_sql(x: str, stop=None) -> str:
    x = f"coalesce(CAST({x} AS VARCHAR), '')"
    x = f"regexp_replace({x}, '<.*?>', '', 'g')"
    x = f"regexp_replace({x}, '[^a-zA-Z0-9.,''\" ]+', ' ', 'g')"
    x = f"replace({x}, ',', '')"
    x = inner_dots_sql(x)
    x = f"lower({x})"
    x = squeeze_sql(x)
    return stopwords_sql(x, stop)


def sentences_sql(x: str) -> str:
    return f"string_split(replace({x}, '. ', '.' || chr(1)), chr(1))"


def units_sql(x: str) -> str:
    return f"len(regexp_extract_all({x}, '\\w+|[^\\w\\s]'))"


def pack_sql(x: str, max_len: int = CHUNK_MAX_LEN) -> str:
    """W1 fold as ``list_reduce`` over (sentence, length) pairs -> struct(chunks, cur, len)."""
    s = sentences_sql(x)
    return (
        f"list_reduce(list_transform({s}, lambda s, i: {{'s': s, 'n': {units_sql('s')}}}), "
        f"lambda acc, x: CASE WHEN acc.len + x.n > {max_len} "
        f"THEN {{'chunks': list_append(acc.chunks, array_to_string(acc.cur, ' ')), 'cur': [x.s], 'len': x.n}} "
        f"ELSE {{'chunks': acc.chunks, 'cur': list_append(acc.cur, x.s), 'len': acc.len + x.n}} END, "
        f"{{'chunks': []::VARCHAR[], 'cur': []::VARCHAR[], 'len': 0}})"
    )


def pack_finish_sql(p: str, drop_empty: bool = True) -> str:
    done = (f"(CASE WHEN len({p}.cur) > 0 THEN list_append({p}.chunks, array_to_string({p}.cur, ' ')) "
            f"ELSE {p}.chunks END)")
    return f"list_filter({done}, lambda c: c <> '')" if drop_empty else done


def dict_values(mapping=None) -> str:
    rows = flat_dictionary(mapping or TEST_DICTIONARY)
    vals = ", ".join(f"({lit(t)}, {lit(c)}, {p}, {lit(lab)})" for t, c, p, lab in rows)
    return f"(VALUES {vals}) AS v(term, category, priority, label)"


def phrase_values(mapping=None) -> str:
    rows = [r for r in flat_dictionary(mapping or TEST_DICTIONARY) if " " in r[0]]
    vals = []
    for t, _c, p, lab in rows:
        pat = "(?i)\\b" + "\\s+".join(re.escape(w) for w in t.split()) + "\\b"
        vals.append(f"({lit(t)}, {p}, {lit(lab)}, {lit(pat)})")
    if not vals:
        return "(SELECT NULL::VARCHAR AS term, NULL::INT AS priority, NULL::VARCHAR AS label, NULL::VARCHAR AS pattern WHERE false)"
    return f"(VALUES {', '.join(vals)}) AS v(term, priority, label, pattern)"


def labels_values() -> str:
    vals = ", ".join(f"({i}, {lit(t)})" for i, t in LABELS)
    return f"(VALUES {vals}) AS v(id, tag)"


def corpus_ctes(max_len: int = CHUNK_MAX_LEN, docs: str | None = None) -> str:
    docs = docs or "SELECT doc_id, text AS description FROM documents"
    return f"""
docs AS ({docs}),
clean0 AS (SELECT doc_id, {clean_sql('description')} AS text FROM docs),
clean AS (SELECT doc_id, text FROM clean0 WHERE text <> ''),
packed0 AS (SELECT doc_id, {pack_sql('text', max_len)} AS p FROM clean),
packed AS (SELECT doc_id, {pack_finish_sql('p')} AS cl FROM packed0),
chunks AS (SELECT doc_id, CAST(generate_subscripts(cl, 1) - 1 AS INTEGER) AS chunk_no, unnest(cl) AS text FROM packed),
toks0 AS (SELECT doc_id, chunk_no, {spans_sql('text', "'\\b\\w+\\b'")} AS sp FROM chunks),
toks AS (SELECT doc_id, chunk_no, CAST(generate_subscripts(sp, 1) - 1 AS INTEGER) AS word_no, unnest(sp) AS s FROM toks0)"""


def label_ctes(sfx: str = "", mapping=None, exclusions=None) -> str:
    """Dictionary tagger CTEs (suffix ``sfx``) over the shared ``chunks``/``toks``."""
    excl = exclusions if exclusions is not None else TEST_EXCLUSIONS
    excl_sql = ", ".join(lit(e.lower()) for e in excl) or "NULL"
    return f"""
dict{sfx} AS (SELECT * FROM {dict_values(mapping)}),
lookup{sfx} AS (SELECT term, min_by(label, priority) AS label, min(priority) AS priority FROM dict{sfx}
           WHERE term NOT IN ({excl_sql}) GROUP BY term),
word_labels{sfx} AS (SELECT t.doc_id, t.chunk_no, t.s.start AS start, t.s."end" AS "end", 'B-' || l.label AS entity,
                t.s.text AS text, 1 AS origin, l.priority, l.term, 0 AS match_no, 0 AS word_no
                FROM toks t JOIN lookup{sfx} l ON lower(trim(t.s.text)) = l.term),
phr{sfx} AS (SELECT * FROM {phrase_values(mapping)}),
pm0{sfx} AS (SELECT c.doc_id, c.chunk_no, p.term, p.priority, p.label, {spans_sql('c.text', 'p.pattern')} AS ms
        FROM chunks c, phr{sfx} p WHERE regexp_matches(c.text, p.pattern)),
pm{sfx} AS (SELECT doc_id, chunk_no, term, priority, label, CAST(generate_subscripts(ms, 1) - 1 AS INTEGER) AS match_no,
       unnest(ms) AS m FROM pm0{sfx}),
pw0{sfx} AS (SELECT *, {spans_sql('m.text', "'\\S+'")} AS ws FROM pm{sfx}),
pw{sfx} AS (SELECT doc_id, chunk_no, term, priority, label, match_no, m.start AS mstart,
       CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS word_no, unnest(ws) AS w FROM pw0{sfx}),
phrase_labels{sfx} AS (SELECT doc_id, chunk_no, mstart + w.start AS start, mstart + w."end" AS "end",
                  CASE WHEN word_no = 0 THEN 'B-' ELSE 'I-' END || label AS entity, w.text AS text,
                  0 AS origin, priority, term, match_no, word_no FROM pw{sfx}),
labels{sfx} AS (SELECT * FROM phrase_labels{sfx} UNION ALL SELECT * FROM word_labels{sfx})"""


def base_ctes(mapping=None, exclusions=None, max_len: int = CHUNK_MAX_LEN) -> str:
    """CTEs ``docs, clean, chunks, toks, word_labels, phrase_labels, labels`` over ``documents``."""
    return corpus_ctes(max_len) + "," + label_ctes("", mapping, exclusions)


def with_base(body: str, **kw) -> str:
    return "WITH " + base_ctes(**kw).strip() + "\n" + body


TOKEN_RE = "'\\b\\w+\\b'"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["strip_tags"] = "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS stripped FROM pages"

ORACLE_SQL["clean_text"] = f"SELECT doc_id, lang, {clean_sql('text')} AS cleaned FROM documents"

ORACLE_SQL["remove_stopwords"] = (
    f"SELECT doc_id, {stopwords_sql(squeeze_sql('lower(text)'))} AS kept FROM documents")

ORACLE_SQL["word_tokens"] = with_base(f"""
, ct AS (SELECT doc_id, {spans_sql('text', TOKEN_RE)} AS sp FROM clean)
SELECT doc_id, CAST(generate_subscripts(sp, 1) - 1 AS INTEGER) AS idx, unnest(sp).text AS token,
       unnest(sp).start AS start, unnest(sp)."end" AS "end" FROM ct""")

ORACLE_SQL["split_sentences"] = with_base(f"""
, ss AS (SELECT doc_id, {sentences_sql('text')} AS s FROM clean),
  su AS (SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sent_no, unnest(s) AS sentence FROM ss)
SELECT doc_id, sent_no, sentence, CAST({units_sql('sentence')} AS INTEGER) AS n_units FROM su""")

ORACLE_SQL["pack_chunks"] = with_base("SELECT doc_id, chunk_no, text FROM chunks")

ORACLE_SQL["tag_words"] = with_base(
    'SELECT doc_id, chunk_no, start, "end", entity, text FROM word_labels')

ORACLE_SQL["tag_phrases"] = with_base(
    'SELECT doc_id, chunk_no, start, "end", entity, text, term, match_no, word_no FROM phrase_labels')

ORACLE_SQL["refine_labels"] = with_base(
    'SELECT doc_id, chunk_no, start, "end", entity, text, origin, CAST(row_number() OVER ('
    'PARTITION BY doc_id, chunk_no ORDER BY start, origin, priority, term, match_no, word_no) - 1 AS INTEGER)'
    ' AS label_no FROM labels')

ORACLE_SQL["entity_counts"] = with_base("SELECT entity, count(*) AS n FROM labels GROUP BY entity")

PAGE_TITLE = "nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '')"
SOURCES_SQL = f"""
src AS (
  SELECT 'pages' AS source, 0 AS source_rank, {PAGE_TITLE} AS title, html AS description FROM pages
  UNION ALL SELECT 'part', 1, p_name, p_type FROM part
  UNION ALL SELECT 'documents', 2, NULL, text FROM documents
  UNION ALL SELECT 'benchmark', 3, NULL, text FROM benchmark
  UNION ALL SELECT 'conversations', 4, NULL, text FROM conversations),
titled AS (
  SELECT source, source_rank, lower(title) AS title, description FROM src
  WHERE source_rank <= 1 AND description IS NOT NULL AND title IS NOT NULL
    AND (contains(lower(title), 'ring') OR contains(lower(title), 'then'))),
corpus_union AS (
  SELECT source, source_rank, description FROM titled
  UNION ALL SELECT source, source_rank, description FROM src WHERE source_rank >= 2),
corpus AS (
  SELECT md5(description) AS doc_id, arg_min(source, source_rank) AS source, description
  FROM corpus_union WHERE description IS NOT NULL GROUP BY description)"""

ORACLE_SQL["scan_sources"] = f"WITH {SOURCES_SQL.strip()} SELECT source, source_rank, title, description FROM src"
ORACLE_SQL["source_status"] = """
SELECT 'pages' AS source, true AS ok, NULL::VARCHAR AS reason, count(*) AS rows FROM pages
UNION ALL SELECT 'part', true, NULL, count(*) FROM part
UNION ALL SELECT 'documents', true, NULL, count(*) FROM documents
UNION ALL SELECT 'benchmark', true, NULL, count(*) FROM benchmark
UNION ALL SELECT 'conversations', true, NULL, count(*) FROM conversations
UNION ALL SELECT 'benchmark_jobs', false, 'missing jobdescription, title', 0"""
ORACLE_SQL["csv_roundtrip"] = """
SELECT 'documents' AS source, source AS title, 'say "hi", ' || text AS description FROM documents"""
ORACLE_SQL["drop_missing"] = (f"SELECT {PAGE_TITLE} AS title, CAST(length(html) AS INTEGER) AS n_chars FROM pages "
                              f"WHERE {PAGE_TITLE} IS NOT NULL AND html IS NOT NULL")
ORACLE_SQL["title_filter"] = f"WITH {SOURCES_SQL.strip()} SELECT source, title, description FROM titled"
ORACLE_SQL["union_sources"] = f"WITH {SOURCES_SQL.strip()} SELECT source, source_rank, description FROM corpus_union"
ORACLE_SQL["distinct_corpus"] = f"WITH {SOURCES_SQL.strip()} SELECT doc_id, source, description FROM corpus"
ORACLE_SQL["null_counts"] = """
SELECT count(*) AS n_rows, CAST(sum(CAST(d.doc_id IS NULL AS BIGINT)) AS BIGINT) AS null_doc_id,
       CAST(sum(CAST(d.text IS NULL AS BIGINT)) AS BIGINT) AS null_text,
       CAST(sum(CAST(l.quality IS NULL AS BIGINT)) AS BIGINT) AS null_quality,
       CAST(sum(CAST(l.toxic IS NULL AS BIGINT)) AS BIGINT) AS null_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLE_SQL["dict_flatten"] = """
SELECT DISTINCT p_type AS category, lower(t) AS term FROM (
  SELECT p_type, unnest(flatten([string_split(p_name, ' '), [p_brand]])) AS t FROM part
  WHERE p_type IS NOT NULL AND p_name IS NOT NULL AND p_brand IS NOT NULL)"""


def alias_sql(x: str) -> str:
    bare = f"regexp_replace({x}, '^[BI]-', '')"
    return (f"(CASE {bare} WHEN 'FRAMEWORK_LIBRARY' THEN 'FRAMEWORKLIBARY' WHEN 'TOOLS' THEN 'TECHNOLOGY' "
            f"ELSE {bare} END)")


EXPORT_CTES = """
, grp AS (SELECT doc_id, chunk_no FROM {src} GROUP BY doc_id, chunk_no),
  rec AS (SELECT doc_id, chunk_no, row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS rec FROM grp),
  exp AS (SELECT CAST(r.rec AS VARCHAR) AS id, r.rec, l.doc_id, l.chunk_no, c.text AS chunk_text,
                 CAST(row_number() OVER (PARTITION BY l.doc_id, l.chunk_no ORDER BY l.start, l.origin, l.priority,
                      l.term, l.match_no, l.word_no, l."end", l.entity, l.text) - 1 AS INTEGER) AS result_no,
                 l.start, l."end", l.text AS span_text, l.entity AS label
          FROM {src} l JOIN rec r ON l.doc_id = r.doc_id AND l.chunk_no = r.chunk_no
          JOIN chunks c ON l.doc_id = c.doc_id AND l.chunk_no = c.chunk_no)"""

REVIEWED_CTES = f"""
, reviewed AS (
    SELECT doc_id, chunk_no, m.start AS start, m."end" AS "end", {alias_sql('label')} AS entity, m.text AS text,
           0 AS origin, priority, term, match_no, 0 AS word_no FROM pm
    UNION ALL
    SELECT doc_id, chunk_no, start, "end", {alias_sql('entity')}, text, origin, priority, term, match_no, word_no
    FROM word_labels)"""

FLAT_EXPORT = ("SELECT id, chunk_text AS text, result_no, 'result-' || id || '-' || result_no AS result_id, "
               "start, \"end\", span_text, label FROM exp")

ORACLE_SQL["export_records"] = with_base(EXPORT_CTES.format(src="labels") + """
SELECT id, doc_id, chunk_no, any_value(chunk_text) AS text, CAST(count(*) AS INTEGER) AS n_results
FROM exp GROUP BY id, doc_id, chunk_no""")
ORACLE_SQL["export_labels"] = with_base(EXPORT_CTES.format(src="labels") + "\n" + FLAT_EXPORT)
ORACLE_SQL["export_roundtrip"] = ORACLE_SQL["export_labels"]
ORACLE_SQL["record_parts"] = with_base(EXPORT_CTES.format(src="labels") + """
SELECT DISTINCT id, CAST(floor(rec / 50) + 1 AS INTEGER) AS part_no FROM exp""")
ORACLE_SQL["flatten_export"] = with_base(REVIEWED_CTES + EXPORT_CTES.format(src="reviewed") + "\n" + FLAT_EXPORT)

BIO_CTES = REVIEWED_CTES + EXPORT_CTES.format(src="reviewed") + f"""
, rtext AS (SELECT DISTINCT id, chunk_text FROM exp),
  rt0 AS (SELECT id, {spans_sql('chunk_text', TOKEN_RE)} AS sp FROM rtext),
  rt AS (SELECT id, CAST(generate_subscripts(sp, 1) - 1 AS INTEGER) AS idx, unnest(sp) AS s FROM rt0),
  cov AS (SELECT t.id, t.idx, e.result_no, e.label,
                 min(t.idx) OVER (PARTITION BY t.id, e.result_no) AS first_idx
          FROM rt t JOIN exp e ON t.id = e.id AND t.s.start >= e.start AND t.s."end" <= e."end"),
  tagged AS (SELECT id, idx, arg_max(CASE WHEN idx = first_idx THEN 'B-' ELSE 'I-' END || label, result_no) AS tagname
             FROM cov GROUP BY id, idx),
  lmap AS (SELECT * FROM {labels_values()}),
  bio AS (SELECT rt.id, rt.idx, rt.s.text AS token, CAST(coalesce(lmap.id, 0) AS INTEGER) AS tag
          FROM rt LEFT JOIN tagged ON rt.id = tagged.id AND rt.idx = tagged.idx
          LEFT JOIN lmap ON lmap.tag = tagged.tagname),
  wl AS (SELECT id, string_agg(token, ' ' ORDER BY idx) AS tokens,
                string_agg(CAST(tag AS VARCHAR), ' ' ORDER BY idx) AS tags, CAST(count(*) AS INTEGER) AS n_tokens
         FROM bio GROUP BY id)"""

ORACLE_SQL["bio_tags"] = with_base(BIO_CTES + "\nSELECT id, idx, token, tag FROM bio")
ORACLE_SQL["word_level"] = with_base(BIO_CTES + "\nSELECT id, tokens, tags, n_tokens FROM wl")
ORACLE_SQL["train_val_split"] = with_base(BIO_CTES + """
, sh AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS shuffle_no, count(*) OVER () AS n FROM wl)
SELECT id, shuffle_no, CASE WHEN shuffle_no < floor(n * 0.8) THEN 'train' ELSE 'validation' END AS split FROM sh""")


ORACLE_SQL["split_files"] = with_base(BIO_CTES + """
, sh AS (SELECT id, n_tokens, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS shuffle_no, count(*) OVER () AS n FROM wl)
SELECT id, n_tokens, CASE WHEN shuffle_no < floor(n * 0.8) THEN 'train' ELSE 'validation' END AS split FROM sh""")


def reviewed_sql(sfx: str = "") -> str:
    return f"""
SELECT doc_id, chunk_no, m.start AS start, m."end" AS "end", {alias_sql('label')} AS entity, m.text AS text,
       0 AS origin, priority, term, match_no, 0 AS word_no FROM pm{sfx}
UNION ALL
SELECT doc_id, chunk_no, start, "end", {alias_sql('entity')}, text, origin, priority, term, match_no, word_no
FROM word_labels{sfx}"""


def side_ctes(k: str, sfx: str) -> str:
    """Tags of the tokens ``et`` by the entities of one dictionary; later entity wins, B on its first token."""
    return f"""
, ents_{k} AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY start, origin, priority, term, match_no,
                  word_no, "end", entity, text) - 1 AS result_no FROM rev_{k}),
  cov_{k} AS (SELECT t.doc_id, t.chunk_no, t.word_no AS idx, e.result_no, e.entity,
                 min(t.word_no) OVER (PARTITION BY t.doc_id, t.chunk_no, e.result_no) AS first_idx
          FROM et t JOIN ents_{k} e ON t.doc_id = e.doc_id AND t.chunk_no = e.chunk_no
               AND t.s.start >= e.start AND t.s."end" <= e."end"),
  tag_{k} AS (SELECT doc_id, chunk_no, idx, arg_max(CASE WHEN idx = first_idx THEN 'B-' ELSE 'I-' END || entity, result_no) AS tagname
          FROM cov_{k} GROUP BY doc_id, chunk_no, idx)"""


EVAL_CTES = ("," + label_ctes("_p", PRED_DICTIONARY) + f"""
, rev_g AS ({reviewed_sql()}), rev_p AS ({reviewed_sql('_p')}),
  ek AS (SELECT doc_id, chunk_no FROM rev_g UNION SELECT doc_id, chunk_no FROM rev_p),
  et AS (SELECT t.* FROM toks t JOIN ek ON t.doc_id = ek.doc_id AND t.chunk_no = ek.chunk_no)"""
             + side_ctes("g", "") + side_ctes("p", "_p") + f"""
, lmap AS (SELECT * FROM {labels_values()}),
  pairs AS (SELECT et.doc_id || ':' || et.chunk_no AS id, et.word_no AS pos, et.s.text AS token,
                   CAST(coalesce(lg.id, 0) AS INTEGER) AS gold, CAST(coalesce(lp.id, 0) AS INTEGER) AS pred
            FROM et LEFT JOIN tag_g g ON g.doc_id = et.doc_id AND g.chunk_no = et.chunk_no AND g.idx = et.word_no
            LEFT JOIN tag_p p ON p.doc_id = et.doc_id AND p.chunk_no = et.chunk_no AND p.idx = et.word_no
            LEFT JOIN lmap lg ON lg.tag = g.tagname LEFT JOIN lmap lp ON lp.tag = p.tagname)""")


def named_cte(src: str) -> str:
    return f"""
, named AS (SELECT x.id, pos, gold, pred, g.tag AS gt, coalesce(q.tag, 'UNK') AS pt
            FROM {src} x LEFT JOIN lmap g ON g.id = x.gold LEFT JOIN lmap q ON q.id = x.pred)"""


def spans_of(col: str, name: str) -> str:
    return f"""
, {name}0 AS (SELECT id, pos, CASE WHEN {col} LIKE 'B-%' THEN 'B' WHEN {col} LIKE 'I-%' THEN 'I' ELSE 'O' END AS pf,
                 CASE WHEN {col} LIKE 'B-%' OR {col} LIKE 'I-%' THEN substr({col}, 3) END AS ty FROM named),
  {name}1 AS (SELECT *, CASE WHEN pf <> 'O' AND (pf = 'B' OR lag(ty) OVER w IS NULL OR lag(ty) OVER w <> ty)
                        THEN 1 ELSE 0 END AS st FROM {name}0 WINDOW w AS (PARTITION BY id ORDER BY pos)),
  {name}2 AS (SELECT *, sum(st) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS sp FROM {name}1),
  {name} AS (SELECT id, any_value(ty) AS type, min(pos) AS start, max(pos) AS "end" FROM {name}2
             WHERE pf <> 'O' GROUP BY id, sp)"""


SCORE_CTES = spans_of("gt", "gspans") + spans_of("pt", "pspans") + """
, both_sides AS (SELECT id, type, start, "end", 1 AS g, 0 AS p FROM gspans
                 UNION ALL SELECT id, type, start, "end", 0, 1 FROM pspans),
  per_span AS (SELECT id, type, start, "end", max(g) AS g, max(p) AS p FROM both_sides GROUP BY id, type, start, "end")"""


def score_select(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    grp = f" GROUP BY {keys}" if keys else ""
    return f"""
, sc AS (SELECT {k}CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold,
                CAST(sum(g * p) AS BIGINT) AS tp FROM per_span{grp}),
  sc2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                    CASE WHEN n_gold > 0 THEN tp / n_gold ELSE 0.0 END AS recall FROM sc)
SELECT {k}n_pred, n_gold, tp, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1"""


BASE = with_base(EVAL_CTES)
WORDS = BASE + named_cte("pairs")
ORACLE_SQL["decode_spans"] = with_base(BIO_CTES) + """
, named AS (SELECT bio.id, idx AS pos, lmap.tag AS gt FROM bio JOIN lmap ON lmap.id = bio.tag)""" + spans_of(
    "gt", "gspans") + '\nSELECT id, type, start, "end" FROM gspans'
ORACLE_SQL["entity_f1_by_type"] = WORDS + SCORE_CTES + score_select("type") + " FROM sc2"
ORACLE_SQL["entity_f1"] = WORDS + SCORE_CTES + score_select() + """, acc.accuracy FROM sc2,
  (SELECT avg(CAST(gold = pred AS DOUBLE)) AS accuracy FROM pairs) acc"""
ORACLE_SQL["token_accuracy"] = BASE + """
SELECT avg(CAST(gold = pred AS DOUBLE)) AS accuracy, count(*) AS n_tokens FROM pairs"""
# pieces of four characters; positions 1..126 hold pieces, the rest is masked
ORACLE_SQL["entity_f1_pieces"] = BASE + """
, pp0 AS (SELECT id, pos AS word_id, gold, pred, unnest(range(0, CAST(greatest(ceil((length(token) - 4) / 4.0), 0) AS BIGINT) + 1)) AS k FROM pairs),
  pp1 AS (SELECT id, gold, pred AS p, row_number() OVER (PARTITION BY id ORDER BY word_id, k) AS pos FROM pp0),
  pp2 AS (SELECT id, pos, gold, list_transform(range(0, 9), lambda c: (pos * 7 + c * 5) % 9 + CASE WHEN c = p THEN 5 ELSE 0 END) AS sc
          FROM pp1 WHERE pos <= 126),
  pieces AS (SELECT id, pos, gold, CAST(list_position(sc, list_max(sc)) - 1 AS INTEGER) AS pred FROM pp2)""" + named_cte("pieces") + SCORE_CTES + score_select() + """, acc.accuracy, round(ce.loss, 9) AS loss FROM sc2,
  (SELECT avg(CAST(gold = pred AS DOUBLE)) AS accuracy FROM pieces) acc,
  (SELECT avg(ln(list_sum(list_transform(sc, lambda x: exp(x::DOUBLE)))) - sc[gold + 1]) AS loss FROM pp2) ce"""

ORACLE_SQL["decode_ids"] = f"""
SELECT vec_id, label, coalesce(m.tag, 'UNK') AS gold_tag FROM embeddings LEFT JOIN
  (SELECT * FROM {labels_values()}) AS m ON m.id = embeddings.label"""
ARGMAX = "CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER)"
ORACLE_SQL["argmax_class"] = f"SELECT vec_id, {ARGMAX} AS pred_index, {ARGMAX} % 9 AS pred_id FROM embeddings"
ORACLE_SQL["label_map_invert"] = f"""
SELECT vec_id, m.tag, m.id AS tag_id FROM embeddings JOIN (SELECT * FROM {labels_values()}) AS m
  ON m.id = {ARGMAX} % 9"""
ORACLE_SQL["best_run"] = """
SELECT event_type, event_id, value FROM (
  SELECT event_type, event_id, value,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id ASC) AS r
  FROM events WHERE value IS NOT NULL) WHERE r = 1"""

ORACLE_SQL["pad_rows"] = with_base(BIO_CTES + """
SELECT id, CAST(count(*) AS INTEGER) AS n_tags,
       array_to_string(list_concat(list_slice(list(tag ORDER BY idx), 1, 128),
                       list_transform(range(greatest(128 - count(*), 0)), lambda x: -100)), ' ') AS padded
FROM bio GROUP BY id""")

ORACLE_SQL["align_pieces"] = with_base(BIO_CTES + """
, wp0 AS (SELECT id, idx AS word_id, tag, token,
                 unnest(range(0, CAST(greatest(ceil((length(token) - 4) / 4.0), 0) AS BIGINT) + 1)) AS k FROM bio),
  wp AS (SELECT id, word_id, tag, CASE WHEN k = 0 THEN substr(token, 1, 4) ELSE '##' || substr(token, 4 * k + 1, 4) END
                AS piece, row_number() OVER (PARTITION BY id ORDER BY word_id, k) AS pos FROM wp0),
  np AS (SELECT id, least(count(*), 126) AS m FROM wp GROUP BY id),
  rows_ AS (
    SELECT id, 0 AS pos, '[CLS]' AS piece, NULL::INTEGER AS word_id, -100 AS label FROM np
    UNION ALL SELECT wp.id, wp.pos, wp.piece, wp.word_id, wp.tag FROM wp JOIN np ON wp.id = np.id WHERE wp.pos <= np.m
    UNION ALL SELECT id, m + 1, '[SEP]', NULL, -100 FROM np
    UNION ALL SELECT id, unnest(range(m + 2, 128)), '[PAD]', NULL, -100 FROM np)
SELECT id, CAST(pos AS INTEGER) AS pos, piece, CAST(word_id AS INTEGER) AS word_id, CAST(label AS INTEGER) AS label
FROM rows_""")

ORACLE_SQL["csv_ranges"] = ORACLE_SQL["csv_roundtrip"]
ORACLE_SQL["json_arrays"] = "SELECT doc_id, text, n_chars FROM documents"
ABBREVIATIONS = """
dw AS (SELECT regexp_replace(w, '\\.$', '') AS word, CAST(ends_with(w, '.') AS INTEGER) AS dotted
       FROM (SELECT unnest(regexp_split_to_array(regexp_replace(text, '[''"]', '', 'g'), '\\s+')) AS w FROM clean) WHERE regexp_matches(w, '[a-z]')),
ct AS (SELECT word, CAST(sum(dotted) AS BIGINT) AS n_dotted, CAST(count(*) - sum(dotted) AS BIGINT) AS n_plain FROM dw GROUP BY word),
al AS (SELECT sum(n_dotted)::DOUBLE / sum(n_dotted + n_plain) AS share FROM ct),
sz AS (SELECT *, length(word) - length(replace(word, '.', '')) AS inside, length(replace(word, '.', ''))::DOUBLE AS size FROM ct, al WHERE n_dotted > 0),
sc AS (SELECT word, n_dotted, n_plain, 2 * (n_dotted * (ln(0.99) - ln(share)) + n_plain * (ln(1 - 0.99::DOUBLE) - ln(1 - share)))
              * exp(-size) * (inside + 1) * pow(size, -n_plain::DOUBLE) AS score FROM sz)"""
ORACLE_SQL["abbreviations"] = with_base("\n, " + ABBREVIATIONS.strip() + " SELECT word, n_dotted, n_plain, CASE WHEN round(score, 6) = 0 THEN 0.0::DOUBLE ELSE round(score, 6) END AS score FROM sc")
ORACLE_SQL["split_learned"] = with_base("\n, " + ABBREVIATIONS.strip() + f"""
, ab AS (SELECT list(word) AS known FROM sc WHERE score >= 0.3 AND length(word) <= 20),
  parts AS (SELECT doc_id, {sentences_sql('text')} AS ss FROM clean),
  marks AS (SELECT doc_id, ss, list_transform(ss, lambda s: ends_with(s, '.') AND list_contains(coalesce(known, []),
              regexp_replace(regexp_extract(s, '[^\\s''"]*$'), '\\.$', ''))) AS go_on FROM parts, ab),
  groups AS (SELECT doc_id, ss, go_on, generate_subscripts(ss, 1) AS i FROM marks),
  flat AS (SELECT doc_id, i, ss[i] AS s, CASE WHEN i > 1 AND go_on[i - 1] THEN 0 ELSE 1 END AS begins FROM groups),
  num AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM flat)
SELECT doc_id, CAST(g - 1 AS INTEGER) AS sent_no, string_agg(s, ' ' ORDER BY i) AS sentence FROM num GROUP BY doc_id, g""")
BENCHMARK_WORDS = f"SELECT string_split({clean_sql('text')}, ' ') AS w FROM benchmark"
ORACLE_SQL["tag_many_phrases"] = with_base(f"""
, bw AS ({BENCHMARK_WORDS}),
  ph AS (SELECT DISTINCT w[i] AS a, w[i + 1] AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM bw)
         WHERE w[i] <> w[i + 1] AND regexp_full_match(w[i], '[a-z0-9]+') AND regexp_full_match(w[i + 1], '[a-z0-9]+')),
  nx AS (SELECT *, lead(s) OVER (PARTITION BY doc_id, chunk_no ORDER BY word_no) AS t FROM toks),
  hit AS (SELECT nx.doc_id, nx.chunk_no, s, t, a || ' ' || b AS term, word_no FROM nx JOIN ph ON s.text = a AND t.text = b
          JOIN chunks c ON c.doc_id = nx.doc_id AND c.chunk_no = nx.chunk_no
          WHERE t.start = s."end" + 1 AND substr(c.text, s."end" + 1, 1) = ' '),
  no AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, chunk_no, term ORDER BY word_no) - 1 AS INTEGER) AS match_no FROM hit)
SELECT doc_id, chunk_no, s.start AS start, s."end" AS "end", 'B-SKILL' AS entity, s.text AS text, term, match_no, 0 AS word_no FROM no
UNION ALL SELECT doc_id, chunk_no, t.start, t."end", 'I-SKILL', t.text, term, match_no, 1 FROM no""")
ORACLE_SQL["filter_many_keywords"] = f"""
WITH kw AS (SELECT DISTINCT k FROM (SELECT unnest(w) AS k FROM ({BENCHMARK_WORDS})) WHERE length(k) >= 5)
SELECT conv_id, turn, text FROM conversations WHERE EXISTS (SELECT 1 FROM kw WHERE contains(lower(text), k))"""


def cut_ctes(words: str) -> str:
    """``cut(word, k, piece)``: longest match of each distinct word of ``words`` (column ``word``), one
    place a step, over the ASCII pieces of the vocabulary file (cleaned text has no others)."""
    return f"""
, vocab AS (SELECT DISTINCT replace(p, '</w>', chr(1)) AS p, length(replace(p, '</w>', chr(1))) AS n
            FROM (SELECT unnest(json_keys(content::JSON, '$.model.vocab')) AS p FROM read_text({lit(VOCABULARY_PATH)}))
            WHERE regexp_full_match(p, '[\\x21-\\x7E]+') AND p <> '</w>'),
  step AS (SELECT word, 0 AS ofs, 0 AS n, word || chr(1) AS s FROM (SELECT DISTINCT word FROM ({words}))
           UNION ALL
           SELECT o.word, o.ofs + o.n, coalesce(max(v.n), 1), o.s
           FROM (SELECT *, unnest(range(1, 33)) AS size FROM step WHERE ofs + n < length(s)) o
           LEFT JOIN vocab v ON v.p = substr(o.s, o.ofs + o.n + 1, o.size) AND v.n = o.size GROUP BY o.word, o.ofs, o.n, o.s),
  cut AS (SELECT word, k, CASE WHEN k = 0 THEN p ELSE '##' || p END AS piece FROM (
            SELECT word, replace(substr(s, ofs + 1, n), chr(1), '') AS p, row_number() OVER (PARTITION BY word ORDER BY ofs) - 1 AS k
            FROM step WHERE n > 0 AND replace(substr(s, ofs + 1, n), chr(1), '') <> ''))"""


ORACLE_SQL["align_subwords"] = with_base(BIO_CTES + cut_ctes("SELECT token AS word FROM bio") + """
, wp AS (SELECT id, idx AS word_id, tag, piece, row_number() OVER (PARTITION BY id ORDER BY idx, k) AS pos FROM bio JOIN cut ON cut.word = bio.token),
  np AS (SELECT id, least(count(*), 126) AS m FROM wp GROUP BY id),
  rows_ AS (
    SELECT id, 0 AS pos, '[CLS]' AS piece, NULL::INTEGER AS word_id, -100 AS label FROM np
    UNION ALL SELECT wp.id, wp.pos, wp.piece, wp.word_id, wp.tag FROM wp JOIN np ON wp.id = np.id WHERE wp.pos <= np.m
    UNION ALL SELECT id, m + 1, '[SEP]', NULL, -100 FROM np
    UNION ALL SELECT id, unnest(range(m + 2, 128)), '[PAD]', NULL, -100 FROM np)
SELECT id, CAST(pos AS INTEGER) AS pos, piece, CAST(word_id AS INTEGER) AS word_id, CAST(label AS INTEGER) AS label
FROM rows_""").replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE_SQL["pack_subwords"] = (f"""WITH RECURSIVE docs AS (SELECT doc_id, text AS description FROM documents),
clean AS (SELECT doc_id, {clean_sql('description')} AS text FROM docs),
sent AS (SELECT doc_id, CAST(generate_subscripts(ss, 1) AS BIGINT) AS no, unnest(ss) AS s FROM (SELECT doc_id, {sentences_sql('text')} AS ss FROM clean WHERE text <> '')),
unit AS (SELECT doc_id, no, unnest(regexp_extract_all(s, '\\w+|[^\\w\\s]')) AS word FROM sent)""" + cut_ctes("SELECT word FROM unit") + f"""
, size AS (SELECT word, count(*) AS n FROM cut GROUP BY word),
  total AS (SELECT doc_id, no, sum(n) AS n FROM unit JOIN size USING (word) GROUP BY doc_id, no),
  item AS (SELECT doc_id, list({{'s': s, 'n': CAST(coalesce(n, 0) AS BIGINT)}} ORDER BY no) AS items FROM sent LEFT JOIN total USING (doc_id, no) GROUP BY doc_id),
  packed0 AS (SELECT doc_id, list_reduce(items, lambda acc, x: CASE WHEN acc.len + x.n > {CHUNK_MAX_LEN}
      THEN {{'chunks': list_append(acc.chunks, array_to_string(acc.cur, ' ')), 'cur': [x.s], 'len': x.n}}
      ELSE {{'chunks': acc.chunks, 'cur': list_append(acc.cur, x.s), 'len': acc.len + x.n}} END,
      {{'chunks': []::VARCHAR[], 'cur': []::VARCHAR[], 'len': 0::BIGINT}}) AS p FROM item),
  packed AS (SELECT doc_id, {pack_finish_sql('p')} AS cl FROM packed0)
SELECT doc_id, CAST(generate_subscripts(cl, 1) - 1 AS INTEGER) AS chunk_no, unnest(cl) AS text FROM packed""")

PIECE_N = "CAST(greatest(ceil((length(s.text) - 4) / 4.0), 0) AS BIGINT) + 1"
ORACLE_SQL["merge_pieces"] = with_base(BIO_CTES + """
, wp0 AS (SELECT id, idx AS word_id, tag, token,
                 unnest(range(0, CAST(greatest(ceil((length(token) - 4) / 4.0), 0) AS BIGINT) + 1)) AS k FROM bio),
  wp AS (SELECT wp0.id, CASE WHEN k = 0 THEN substr(token, 1, 4) ELSE '##' || substr(token, 4 * k + 1, 4) END AS piece,
                CASE WHEN k = 0 THEN lmap.tag ELSE 'O' END AS label, row_number() OVER (PARTITION BY wp0.id ORDER BY word_id, k) AS pos
         FROM wp0 JOIN lmap ON lmap.id = wp0.tag),
  st AS (SELECT id, 0 AS pos, '[CLS]' AS piece, 'O' AS label FROM wl UNION ALL SELECT id, pos, piece, label FROM wp
         UNION ALL SELECT id, 1000000000, '[SEP]', 'O' FROM wl),
  ch AS (SELECT id, pos, CASE WHEN pos = 1 AND CAST(id AS BIGINT) % 3 = 0 THEN '##' || piece ELSE piece END AS piece, label FROM st
         WHERE NOT (pos = 0 AND CAST(id AS BIGINT) % 6 = 0)),
  gr AS (SELECT *, sum(CASE WHEN starts_with(piece, '##') THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM ch),
  mw AS (SELECT id, g, string_agg(CASE WHEN starts_with(piece, '##') THEN substr(piece, 3) ELSE piece END, '' ORDER BY pos) AS word,
                CASE WHEN g = 0 THEN NULL ELSE arg_min(label, pos) END AS label FROM gr GROUP BY id, g)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY g) - 1 AS INTEGER) AS word_no, word, label FROM mw
WHERE word NOT IN ('[PAD]', '[CLS]', '[SEP]', '')""")

CAND_CTES = f"""
, cw AS (SELECT doc_id, chunk_no, word_no, s, unnest(range(0, {PIECE_N})) AS k FROM toks),
  cp AS (SELECT doc_id, chunk_no, CAST(row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY word_no, k) - 1 AS INTEGER) AS seq,
                CASE WHEN k = 0 THEN substr(s.text, 1, 4) ELSE '##' || substr(s.text, CAST(4 * k + 1 AS BIGINT), 4) END AS word,
                CAST(s.start + 4 * k AS INTEGER) AS start FROM cw),
  cand AS (SELECT doc_id, chunk_no, seq, word, CASE WHEN length(word) >= 4 THEN 'B-SKILL' ELSE 'O' END AS entity, start FROM cp)"""
ORACLE_SQL["score_tokens"] = with_base(CAND_CTES + "\nSELECT doc_id, chunk_no, seq, word, entity, start FROM cand")
ORACLE_SQL["merge_candidates"] = with_base(CAND_CTES + """
, cm AS (SELECT doc_id, chunk_no, seq, entity,
                CASE WHEN seq = 0 AND doc_id % 3 = 0 THEN '##' || word WHEN seq % 11 = 5 AND NOT starts_with(word, '##') THEN '' ELSE word END AS word,
                CASE WHEN seq % 7 = 3 AND doc_id % 2 = 0 THEN NULL ELSE start END AS start FROM cand),
  cg AS (SELECT *, sum(CASE WHEN starts_with(word, '##') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, chunk_no ORDER BY seq ROWS UNBOUNDED PRECEDING) AS g FROM cm),
  ca AS (SELECT doc_id, chunk_no, g, min(seq) AS seq, string_agg(CASE WHEN starts_with(word, '##') THEN substr(word, 3) ELSE word END, '' ORDER BY seq) AS word,
                arg_min(entity, seq) AS entity, arg_min_null(start, seq) AS start FROM cg WHERE g > 0 GROUP BY doc_id, chunk_no, g)
SELECT doc_id, chunk_no, seq, word, entity, start, CAST(start + length(word) AS INTEGER) AS "end" FROM ca WHERE start IS NOT NULL AND word <> ''""")
ORACLE_SQL["score_words"] = with_base("""
SELECT doc_id, chunk_no, word_no AS pos, s.text AS word, s.start AS start, s."end" AS "end", true AS in_label_space FROM toks""")



def viterbi_sql(scores: str, start, move) -> str:
    """Best path (0-based ids) over a list of score lists: a fold with back pointers, then a fold back."""
    n, m = len(start), "[" + ", ".join(str([float(x) for x in r]) for r in move) + "]"
    into = f"list_transform(range(0, {n}), lambda p: acc.best[p + 1] + {m}[p + 1][c + 1])"
    ahead = (f"list_reduce(({scores})[2:], lambda acc, e: {{'best': list_transform(range(0, {n}), lambda c: e[c + 1] + list_max({into})), "
             f"'back': list_append(acc.back, list_transform(range(0, {n}), lambda c: CAST(list_position({into}, list_max({into})) - 1 AS INTEGER)))}}, "
             f"{{'best': list_transform(range(0, {n}), lambda c: ({scores})[1][c + 1] + {[float(x) for x in start]}[c + 1]), 'back': []::INTEGER[][]}})")
    return (f"list_transform([{ahead}], lambda a: list_reverse(list_reduce(list_reverse(a.back), lambda path, b: list_append(path, b[path[-1] + 1]), "
            "[CAST(list_position(a.best, list_max(a.best)) - 1 AS INTEGER)])))[1]")


RULES = bio_rules([t for _i, t in LABELS])
ORACLE_SQL["viterbi_tags"] = with_base(BIO_CTES + f"""
, sc AS (SELECT id, list(list_transform(range(0, 9), lambda c: CAST((idx * 7 + c * 5) % 9 + CASE WHEN c = tag THEN 5 ELSE 0 END AS DOUBLE)) ORDER BY idx) AS s
         FROM bio GROUP BY id),
  best AS (SELECT id, {viterbi_sql('s', *RULES)} AS path FROM sc)
SELECT id, CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS pos, unnest(path) AS tag FROM best""")
FIXED = fixed_tagger()
ORACLE_SQL["tag_sequences"] = with_base(f"""
, wt AS (SELECT * FROM (VALUES {', '.join(f"({'NULL' if b is None else lit(b)}, {lit(w)}, {i}, CAST({x} AS DOUBLE))" for b, w, i, x in FIXED[0])}) AS v(before, word, label, weight)),
  seen AS (SELECT doc_id, chunk_no, word_no, s, lower(s.text) AS word, lag(lower(s.text)) OVER (PARTITION BY doc_id, chunk_no ORDER BY word_no) AS before FROM toks),
  em AS (SELECT seen.doc_id, seen.chunk_no, word_no, any_value(s) AS s,
                [{', '.join(f"coalesce(sum(weight) FILTER (label = {i}), 0.0)" for i in range(9))}] AS e
         FROM seen LEFT JOIN wt ON wt.word = seen.word AND (wt.before IS NULL OR wt.before = seen.before) GROUP BY seen.doc_id, seen.chunk_no, word_no),
  row_ AS (SELECT doc_id, chunk_no, list(e ORDER BY word_no) AS es, list(s ORDER BY word_no) AS ss FROM em GROUP BY doc_id, chunk_no),
  best AS (SELECT doc_id, chunk_no, ss, {viterbi_sql('es', [a + b for a, b in zip(FIXED[1], RULES[0])], [[a + b for a, b in zip(x, y)] for x, y in zip(FIXED[2], RULES[1])])} AS path FROM row_),
  flat AS (SELECT doc_id, chunk_no, CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS pos, unnest(ss) AS s, unnest(path) AS t FROM best)
SELECT doc_id, chunk_no, pos, s.text AS word, s.start AS start, s."end" AS "end", m.tag FROM flat JOIN (SELECT * FROM {labels_values()}) m ON m.id = t""")

ORACLE_SQL["corpus_entity_counts"] = (
    "WITH " + SOURCES_SQL.strip() + "," + corpus_ctes(docs="SELECT doc_id, description FROM corpus") + ","
    + label_ctes() + "\nSELECT entity, count(*) AS n FROM labels GROUP BY entity")
