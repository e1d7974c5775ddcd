"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` reads the test tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import flatten_terms, invert_map, literal_map, pad
from ..functions.pieces import read_vocabulary, subword_lengths, subwords
from ..functions.spans import token_spans
from ..functions.text import clean_text as clean_col
from ..functions.text import remove_stopwords, split_sentences, squeeze, strip_tags, text_length
from ..operators.chunking import chunk_corpus, clean_corpus
from ..operators.corpus import distinct_corpus, keyword_filter_many, null_counts, require, titled_rows, union_sources
from ..operators.dataset import bio_long, split_by_selection, train_val_split, with_bio, word_level
from ..operators.evaluation import best_run, decode_spans, evaluate_rows, evaluate_scores, tag_names
from ..operators.export import export_records, flatten_export, record_entities, record_ids
from ..operators.scoring import (CANDIDATE_SCHEMA, align_pieces, argmax_class, decode_ids, merge_pieces,
                                 piece_candidate_scorer, piece_stream, score_tokens, word_pieces)
from ..operators.sentences import abbreviation_scores, learn_abbreviations, sentence_splitter
from ..operators.sequence import (SequenceModel, bio_rules, load_sequence_tagger, predict_sequence, save_sequence_tagger, sequence_rows,
                                  tag_sequences, train_sequence_tagger, viterbi_path)
from ..operators.tagging import (entity_counts, label_order, lookup_table, merge_candidates, refine_labels, tag_chunks,
                                 tag_many_phrases, tag_phrases, tag_words)
from ..operators.training import load_tagger, predict_pairs, save_tagger, tag_text, token_features, train_tagger
from ..session import local_table, materialize, spread
from ..sources.dictionary import LABELS, dictionary, label_map, term_list, write_label_config
from ..sources.ranges import read_json_arrays
from ..sources.records import (read_label_export, read_word_level, record_parts, scratch_path, write_records, write_split,
                               write_table)
from ..sources.registry import PANDAS_NA_TOKENS, SourceSpec, land, read_source, source_status
from .corpus_job import run_corpus
from .fixtures import (CHUNK_MAX_LEN, N_CLASSES, PAD_LEN, PART_SIZE, PIECE_HEAD, PRED_DICTIONARY, SPLIT_RATIO, SPLIT_SEED,
                       TEST_DICTIONARY, TEST_EXCLUSIONS, TITLE_KEYWORDS, VOCABULARY_PATH, broken_spec, fixed_tagger, test_specs)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def all_docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", F.col("text").alias("description")))


def clean_docs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_corpus(all_docs(spark, sf))


def doc_chunks(spark: SparkSession, sf: str, max_len: int = CHUNK_MAX_LEN) -> DataFrame:
    return chunk_corpus(clean_docs(spark, sf), max_len)


def test_dictionary(spark: SparkSession, mapping=None):
    d, n = dictionary(spark, mapping or TEST_DICTIONARY)
    x, _ = term_list(spark, TEST_EXCLUSIONS)
    return d, x, n


def doc_labels(spark: SparkSession, sf: str, mapping=None) -> DataFrame:
    d, x, n = test_dictionary(spark, mapping)
    return refine_labels(doc_chunks(spark, sf), d, x, dict_bytes=n)


LABEL_OUT = ["doc_id", "chunk_no", "start", "end", "entity", "text"]


# ---- step 0: cleaning, tokens, chunks, tagging ---------------------------------

def q_strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", strip_tags("html").alias("stripped"))


def q_clean_text(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", "lang", clean_col("text").alias("cleaned"))


def q_remove_stopwords(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        "doc_id", remove_stopwords(squeeze(F.lower("text"))).alias("kept"))


def q_word_tokens(spark, sf):
    return clean_docs(spark, sf).select(
        "doc_id", F.posexplode(token_spans("text")).alias("idx", "t")).select(
        "doc_id", "idx", F.col("t.text").alias("token"), F.col("t.start").alias("start"),
        F.col("t.end").alias("end"))


def q_split_sentences(spark, sf):
    return clean_docs(spark, sf).select(
        "doc_id", F.posexplode(split_sentences("text")).alias("sent_no", "sentence")).select(
        "doc_id", "sent_no", "sentence", text_length("sentence").alias("n_units"))


def q_abbreviations(spark, sf):
    """words of the cleaned documents that stand with a dot, and their abbreviation scores."""
    score = F.round("score", 6)
    return abbreviation_scores(clean_docs(spark, sf)).select("word", "n_dotted", "n_plain", F.when(score == 0, 0.0).otherwise(score).alias("score"))


def q_split_learned(spark, sf):
    """F13 with the abbreviations learned from the corpus itself, written and read back."""
    clean = materialize(clean_docs(spark, sf), "clean")
    words = materialize(learn_abbreviations(clean), "abbreviations").collect()  # a dimension table
    split = sentence_splitter(r.word for r in words)
    return clean.select("doc_id", F.posexplode(split(F.col("text"))).alias("sent_no", "sentence"))


def q_pack_chunks(spark, sf):
    return doc_chunks(spark, sf).select("doc_id", "chunk_no", "text")


def q_tag_words(spark, sf):
    d, x, n = test_dictionary(spark)
    return tag_words(doc_chunks(spark, sf), d, x, dict_bytes=n).select(*LABEL_OUT)


def q_tag_phrases(spark, sf):
    d, _x, n = test_dictionary(spark)
    return tag_phrases(doc_chunks(spark, sf), d, dict_bytes=n).select(
        *LABEL_OUT, "term", "match_no", "word_no")


def benchmark_words(spark, sf):
    return table(spark, sf, "benchmark").select(F.split(clean_col("text"), " ").alias("w"))


def q_tag_many_phrases(spark, sf):
    """T1 with a large dictionary: every two neighbouring different words of the benchmark's cleaned texts."""
    pairs = benchmark_words(spark, sf).select(F.explode(F.zip_with("w", F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    pairs = pairs.select("p.*").where("a <> b AND a RLIKE '^[a-z0-9]+$' AND b RLIKE '^[a-z0-9]+$'").distinct()
    d = pairs.select(F.concat_ws(" ", "a", "b").alias("term"), F.lit("SKILL").alias("label"), F.lit(0).alias("priority"))
    return tag_many_phrases(doc_chunks(spark, sf), d).select(*LABEL_OUT, "term", "match_no", "word_no")


def q_filter_many_keywords(spark, sf):
    """P5 with a long list: conversation turns that hold a word of the benchmark with five letters or more."""
    words = benchmark_words(spark, sf).select(F.explode("w").alias("w")).where("length(w) >= 5").distinct()
    kept = keyword_filter_many(table(spark, sf, "conversations"), "text", [r.w for r in words.collect()])  # a parameter list
    return kept.select("conv_id", "turn", "text")


def q_refine_labels(spark, sf):
    w = Window.partitionBy("doc_id", "chunk_no").orderBy(*label_order())
    return doc_labels(spark, sf).select(
        *LABEL_OUT, "origin", (F.row_number().over(w) - 1).alias("label_no"))


def q_entity_counts(spark, sf):
    return entity_counts(doc_labels(spark, sf))


# ---- step 1: sources and corpus --------------------------------------------------

def q_scan_sources(spark, sf):
    from functools import reduce
    parts = [read_source(spark, s) for s in test_specs(sf)]
    return reduce(DataFrame.unionByName, parts)


def q_source_status(spark, sf):
    return source_status(spark, test_specs(sf) + [broken_spec(sf)])


def q_csv_roundtrip(spark, sf):
    """S1 + S5: a test table written as quoted CSV (its text holds line breaks, quotes and commas),
    landed as parquet through the registry and read back."""
    raw, landed = scratch_path(spark, "csv"), scratch_path(spark, "landed")
    docs = table(spark, sf, "documents").select(F.col("source").alias("Job Title"), F.concat(F.lit('say "hi", '), "text").alias("Job Description"))
    write_table(docs, raw, fmt="csv")
    spec = SourceSpec("documents", raw, description="Job Description", title="Job Title", fmt="csv", null_tokens=tuple(PANDAS_NA_TOKENS))
    return read_source(spark, land(spark, spec, landed)).select("source", "title", "description")


def q_csv_ranges(spark, sf):
    """The files of ``csv_roundtrip``, landed by byte ranges."""
    raw, landed = scratch_path(spark, "csv"), scratch_path(spark, "landed")
    docs = table(spark, sf, "documents").select(F.col("source").alias("Job Title"), F.concat(F.lit('say "hi", '), "text").alias("Job Description"))
    write_table(docs, raw, fmt="csv")
    spec = SourceSpec("documents", raw, description="Job Description", title="Job Title", fmt="csv_ranges", null_tokens=tuple(PANDAS_NA_TOKENS))
    return read_source(spark, land(spark, spec, landed)).select("source", "title", "description")


def q_json_arrays(spark, sf):
    """S3: legacy files of JSON arrays (64 ids an array) written and read by byte ranges."""
    path = scratch_path(spark, "arrays")
    rows = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 64).alias("g"), F.to_json(F.struct("doc_id", "text", "n_chars")).alias("j"))
    arrays = rows.groupBy("g").agg(F.array_join(F.collect_list("j"), ", ").alias("j"))
    arrays.select(F.concat(F.lit("["), "j", F.lit("]")).alias("value")).write.text(path)
    return read_json_arrays(spark, path, "doc_id long, text string, n_chars long")


def q_drop_missing(spark, sf):
    pages = read_source(spark, test_specs(sf)[0])
    return require(pages, ["title", "description"]).select("title", F.length("description").alias("n_chars"))


def q_title_filter(spark, sf):
    from functools import reduce
    parts = [titled_rows(spark, s, TITLE_KEYWORDS) for s in test_specs(sf) if s.titled]
    return reduce(DataFrame.unionByName, parts).select("source", "title", "description")


def q_union_sources(spark, sf):
    return union_sources(spark, test_specs(sf), TITLE_KEYWORDS)


def q_distinct_corpus(spark, sf):
    return distinct_corpus(union_sources(spark, test_specs(sf), TITLE_KEYWORDS), specs=test_specs(sf))


def q_null_counts(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return null_counts(docs.select("doc_id", "text", "quality", "toxic"))


def q_dict_flatten(spark, sf):
    part = require(table(spark, sf, "part"), ["p_type", "p_name", "p_brand"])
    items = F.array(F.split("p_name", " "), F.array("p_brand"))
    terms = part.select(F.col("p_type").alias("category"), F.explode(flatten_terms(items)).alias("term"))
    return terms.distinct()


# ---- steps 4-5: export records, BIO data set, split -------------------------------

def doc_tags(spark, sf, reviewed=False, mapping=None):
    """Label rows with the text of their chunk."""
    d, x, n = test_dictionary(spark, mapping)
    return tag_chunks(doc_chunks(spark, sf), d, x, n, reviewed=reviewed, keep_text=True)


def doc_export(spark, sf, reviewed=False, mapping=None):
    return export_records(doc_tags(spark, sf, reviewed, mapping))


def q_export_records(spark, sf):
    return doc_export(spark, sf).select(
        "id", "doc_id", "chunk_no", F.col("data.text").alias("text"),
        F.size(F.col("annotations")[0]["result"]).alias("n_results"))


def q_export_labels(spark, sf):
    return flatten_export(doc_export(spark, sf))


def q_flatten_export(spark, sf):
    return flatten_export(doc_export(spark, sf, reviewed=True))


def q_record_parts(spark, sf):
    return record_parts(doc_export(spark, sf), PART_SIZE).select("id", "part_no")


def q_export_roundtrip(spark, sf):
    path = scratch_path(spark, "export")
    write_records(doc_export(spark, sf).select("id", "data", "annotations"), path)
    return flatten_export(read_label_export(spark, path))


def doc_word_level(spark, sf, mapping=None):
    return word_level(record_entities(doc_export(spark, sf, reviewed=True, mapping=mapping)))


def q_bio_tags(spark, sf):
    return bio_long(doc_word_level(spark, sf))


def q_word_level(spark, sf):
    return doc_word_level(spark, sf).select(
        "id", F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.transform("ner_tags", lambda t: t.cast("string")), " ").alias("tags"),
        F.size("tokens").alias("n_tokens"))


def q_train_val_split(spark, sf):
    return train_val_split(record_ids(doc_tags(spark, sf, reviewed=True)), "id", SPLIT_RATIO, SPLIT_SEED)


def q_split_files(spark, sf):
    """Train and validation files written and read back, one row per record."""
    path = scratch_path(spark, "split")
    rows = materialize(doc_word_level(spark, sf), "word-level")
    write_split(split_by_selection(rows, "id", SPLIT_RATIO, SPLIT_SEED), path)
    parts = [read_word_level(spark, path, split=x).select("id", F.size("tokens").alias("n_tokens"), F.lit(x).alias("split"))
             for x in ("train", "validation")]
    return parts[0].unionByName(parts[1])


# ---- steps 6-7: scoring and evaluation ------------------------------------------

def q_decode_ids(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", decode_ids(F.col("label")).alias("gold_tag"))


def q_argmax_class(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", argmax_class(F.col("embedding")).alias("pred_index"),
                    argmax_class(F.col("embedding"), N_CLASSES).alias("pred_id"))


def q_label_map_invert(spark, sf):
    """S4 + N4: read ``id2label`` from a model config file, invert it, round-trip ids."""
    path = scratch_path(spark, "model_config")
    write_label_config(spark, path)
    pairs = [(r.id, r.tag) for r in label_map(spark, path).collect()]  # 9-row dimension table
    id2tag = literal_map(pairs)
    tag2id = invert_map(id2tag)
    e = table(spark, sf, "embeddings").select(
        "vec_id", argmax_class(F.col("embedding"), N_CLASSES).alias("pred_id"))
    tagged = e.select("vec_id", F.element_at(id2tag, F.col("pred_id")).alias("tag"))
    return tagged.select("vec_id", "tag", F.element_at(tag2id, F.col("tag")).alias("tag_id"))


def gold_word_level(spark, sf):
    return doc_word_level(spark, sf)


def q_pad_rows(spark, sf):
    wl = gold_word_level(spark, sf)
    return wl.select("id", F.size("ner_tags").alias("n_tags"),
                     F.array_join(F.transform(pad(F.col("ner_tags"), PAD_LEN, -100), lambda t: t.cast("string")),
                                  " ").alias("padded"))


def q_align_pieces(spark, sf):
    wl = gold_word_level(spark, sf)
    rows = wl.select("id", F.posexplode(align_pieces(F.col("tokens"), F.col("ner_tags"), PAD_LEN, PIECE_HEAD))
                     .alias("pos", "p"))
    return rows.select("id", "pos", F.col("p.piece").alias("piece"), F.col("p.word_id").alias("word_id"),
                       F.col("p.label").alias("label"))


def q_align_subwords(spark, sf):
    """N5 on the pieces of a public vocabulary."""
    cut = subwords(spark, read_vocabulary(VOCABULARY_PATH))
    rows = gold_word_level(spark, sf).select("id", F.posexplode(align_pieces(F.col("tokens"), F.col("ner_tags"), PAD_LEN, cut=cut)).alias("pos", "p"))
    return rows.select("id", "pos", F.col("p.piece").alias("piece"), F.col("p.word_id").alias("word_id"), F.col("p.label").alias("label"))


def q_pack_subwords(spark, sf):
    """W1 with sentence lengths in pieces of a public vocabulary."""
    size = subword_lengths(spark, read_vocabulary(VOCABULARY_PATH))
    return chunk_corpus(clean_docs(spark, sf), CHUNK_MAX_LEN, measure=size)


def piece_labels(tokens, tags):
    """Pieces of each record with labels: a head piece carries its word's tag name,
    ``##`` tails and special tokens carry ``O``."""
    names = literal_map(LABELS)
    return F.transform(piece_stream(tokens, PIECE_HEAD), lambda p: F.struct(
        p["piece"].alias("piece"),
        F.when(p["word_id"].isNull() | p["piece"].startswith("##"), F.lit("O"))
        .otherwise(F.element_at(names, F.element_at(tags, p["word_id"] + 1))).alias("label")))


def q_merge_pieces(spark, sf):
    """Every third record's first word piece becomes a ``##`` piece, and half of these records
    lose ``[CLS]``, so leading runs and pieces joined to a special token occur."""
    wl = gold_word_level(spark, sf).withColumn("no", F.col("id").cast("long"))
    pieces = F.transform(piece_labels(F.col("tokens"), F.col("ner_tags")), lambda p, i: F.struct(
        F.when((i == 1) & (F.col("no") % 3 == 0), F.concat(F.lit("##"), p["piece"])).otherwise(p["piece"]).alias("piece"), p["label"].alias("label")))
    wl = wl.withColumn("pieces", pieces)
    cut = F.when(F.col("no") % 6 == 0, F.slice("pieces", F.lit(2), F.size("pieces"))).otherwise(F.col("pieces"))
    merged = wl.select("id", cut.alias("pieces")).select("id", F.posexplode(merge_pieces(F.col("pieces"))).alias("word_no", "w"))
    return merged.select("id", "word_no", F.col("w.word").alias("word"), F.col("w.label").alias("label"))


def candidate_pieces(chunks):
    """NER-candidate stand-in: every word token cut into pieces with their offsets, numbered
    through the chunk; the entity depends on the piece, so the first piece's entity decides."""
    toks = chunks.select("doc_id", "chunk_no", token_spans("text").alias("toks"))
    pieces = F.flatten(F.transform("toks", lambda t: F.transform(word_pieces(t["text"], PIECE_HEAD), lambda p, k: F.struct(
        p.alias("word"), (t["start"] + k * PIECE_HEAD).alias("start")))))
    rows = toks.select("doc_id", "chunk_no", F.posexplode(pieces).alias("seq", "p"))
    return rows.select("doc_id", "chunk_no", "seq", F.col("p.word").alias("word"),
                       F.when(F.length("p.word") >= 4, F.lit("B-SKILL")).otherwise(F.lit("O")).alias("entity"), F.col("p.start").alias("start"))


def q_merge_candidates(spark, sf):
    """Some pieces are changed by rule, so leading ``##`` runs, missing starts and empty words occur."""
    c = candidate_pieces(doc_chunks(spark, sf))
    word = F.when((F.col("seq") == 0) & (F.col("doc_id") % 3 == 0), F.concat(F.lit("##"), "word")) \
        .when((F.col("seq") % 11 == 5) & ~F.col("word").startswith("##"), F.lit("")).otherwise(F.col("word"))
    start = F.when((F.col("seq") % 7 == 3) & (F.col("doc_id") % 2 == 0), F.lit(None).cast("int")).otherwise(F.col("start"))
    return merge_candidates(c.withColumn("word", word).withColumn("start", start))


def eval_rows(spark, sf):
    """``(id, tokens, gold, pred)`` per chunk that has a gold label (full dictionary) or a
    predicted one (reduced dictionary): one lookup with both dictionaries meets each chunk
    once, and its labels are grouped once beside its text."""
    sides = [test_dictionary(spark, m) for m in (None, PRED_DICTIONARY)]
    gold, pred = (lookup_table(d, x).withColumn("side", F.lit(k)) for k, (d, x, _n) in zip("gp", sides))
    tagged = tag_chunks(doc_chunks(spark, sf), None, dict_bytes=sum(n for _d, _x, n in sides), reviewed=True, keep_text=True,
                        lookup=gold.unionByName(pred), carry=("side",))
    item = F.struct(*label_order(), "end", "entity", "side")
    both = tagged.groupBy("doc_id", "chunk_no").agg(F.first("chunk_text").alias("text"), F.sort_array(F.collect_list(item)).alias("labels"))

    def of(side):
        return F.transform(F.filter("labels", lambda x: x["side"] == side), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["entity"].alias("label")))

    both = both.select(F.concat_ws(":", "doc_id", "chunk_no").alias("id"), "text", of("g").alias("ents_g"), of("p").alias("ents_p"))
    return with_bio(both, "text", {"gold": "ents_g", "pred": "ents_p"})


def q_decode_spans(spark, sf):
    tags = bio_long(doc_word_level(spark, sf))
    return decode_spans(tag_names(tags, "tag", "name"), "id", "idx", "name")


def q_entity_f1(spark, sf):
    return evaluate_rows(eval_rows(spark, sf)).select("n_pred", "n_gold", "tp", "precision", "recall", "f1", "accuracy")


def q_entity_f1_by_type(spark, sf):
    return evaluate_rows(eval_rows(spark, sf), by_type=True)


def q_token_accuracy(spark, sf):
    return evaluate_rows(eval_rows(spark, sf)).select("accuracy", "n_tokens")


def q_entity_f1_pieces(spark, sf):
    """E1 on model rows: 128 positions, -100 at special and pad positions, nine class scores per
    position (noise by position plus a bonus for the reduced dictionary's tag)."""
    rows = eval_rows(spark, sf).select(align_pieces(F.col("tokens"), F.col("gold"), PAD_LEN, PIECE_HEAD).alias("g"),
                                       align_pieces(F.col("tokens"), F.col("pred"), PAD_LEN, PIECE_HEAD).alias("p"))
    scores = F.transform("p", lambda p, i: F.array(*[(
        (i * 7 + F.lit(c * 5)) % 9 + F.when(p["label"] == c, F.lit(5)).otherwise(F.lit(0))).cast("double") for c in range(N_CLASSES)]))
    rows = rows.select(F.transform("g", lambda g: g["label"]).alias("labels"), scores.alias("scores"))
    return evaluate_scores(rows, loss=True).select("n_pred", "n_gold", "tp", "precision", "recall", "f1", "accuracy", F.round("loss", 9).alias("loss"))


def q_best_run(spark, sf):
    ev = table(spark, sf, "events").select("event_type", "event_id", "value")
    return best_run(ev, "event_type", "value", "event_id")


# ---- steps 8-9: model and whole job ------------------------------------------------

def q_score_tokens(spark, sf):
    return score_tokens(doc_chunks(spark, sf).select("doc_id", "chunk_no", "text"),
                        piece_candidate_scorer(PIECE_HEAD), CANDIDATE_SCHEMA)


def fitted_tagger(spark, sf):
    wl = materialize(gold_word_level(spark, sf), "word-level")
    split = train_val_split(wl, "id", SPLIT_RATIO, SPLIT_SEED)
    train = split.where(F.col("split") == "train")
    valid = split.where(F.col("split") == "validation")
    model, metrics = train_tagger(train, valid, grid=(0.0, 0.01), max_iter=20)
    return model, metrics, valid


def q_train_tagger(spark, sf):
    model, _metrics, valid = fitted_tagger(spark, sf)
    return predict_pairs(model, token_features(valid))


def q_score_words(spark, sf):
    """M1 with M2's pipeline, saved and loaded: every word of every chunk gets a tag name (which
    depends on the fit; the query reports whether it is one of the label space)."""
    model, metrics, _valid = fitted_tagger(spark, sf)
    path = scratch_path(spark, "tagger")
    save_tagger(model, metrics, path)
    tagged = tag_text(doc_chunks(spark, sf), load_tagger(path))
    return tagged.select("doc_id", "chunk_no", "pos", "word", "start", "end", F.col("tag").isin(*[t for _i, t in LABELS]).alias("in_label_space"))


def q_train_sequence(spark, sf):
    """M2: the sequence tagger, stopped by validation F1; tags and probabilities of the validation rows."""
    wl = materialize(gold_word_level(spark, sf), "word-level")
    split = train_val_split(wl, "id", SPLIT_RATIO, SPLIT_SEED)
    valid = split.where(F.col("split") == "validation")
    model, _metrics = train_sequence_tagger(split.where(F.col("split") == "train"), valid)
    return predict_sequence(sequence_rows(valid), model).select("id", "pos", "gold", "pred", "confidence")


def q_viterbi_tags(spark, sf):
    """Best BIO paths over given class scores (noise by position plus a bonus for the word's tag)."""
    start, move = bio_rules([t for _i, t in LABELS])
    scores = F.transform("ner_tags", lambda t, i: F.array(*[(
        (i * 7 + F.lit(c * 5)) % 9 + F.when(t == c, F.lit(5)).otherwise(F.lit(0))).cast("double") for c in range(N_CLASSES)]))
    rows = gold_word_level(spark, sf).select("id", scores.alias("scores"))
    return rows.select("id", F.posexplode(viterbi_path(F.col("scores"), start, move)).alias("pos", "tag"))


def q_tag_sequences(spark, sf):
    """M1 with a sequence tagger of fixed weights, saved and loaded: every word of every chunk with its tag."""
    weights, start, move = fixed_tagger()
    buckets = 1 << 40
    names = local_table(spark, [("w=" + w if b is None else f"pw={b}|{w}", i, x) for b, w, i, x in weights], "feature string, label int, weight double")
    rows = names.select(F.pmod(F.xxhash64("feature"), F.lit(buckets)).alias("f"), "label", "weight").collect()  # as many as the rules
    ids = np.unique(np.array([r.f for r in rows]))
    table = np.zeros((len(ids), len(LABELS)))
    for r in rows:
        table[np.searchsorted(ids, r.f), r.label] += r.weight
    path = scratch_path(spark, "sequence")
    save_sequence_tagger(SequenceModel([t for _i, t in LABELS], buckets, ids, table, np.array(start), np.array(move)), path, spark)
    tagged = tag_sequences(doc_chunks(spark, sf), load_sequence_tagger(spark, path))
    return tagged.select("doc_id", "chunk_no", "pos", "word", "start", "end", "tag")


def q_corpus_entity_counts(spark, sf):
    _chunks, labels = run_corpus(spark, test_specs(sf), TITLE_KEYWORDS, TEST_DICTIONARY, TEST_EXCLUSIONS,
                                 CHUNK_MAX_LEN)
    return entity_counts(labels)


QUERIES = {
    "strip_tags": q_strip_tags,
    "clean_text": q_clean_text,
    "remove_stopwords": q_remove_stopwords,
    "word_tokens": q_word_tokens,
    "split_sentences": q_split_sentences,
    "abbreviations": q_abbreviations,
    "split_learned": q_split_learned,
    "pack_chunks": q_pack_chunks,
    "tag_words": q_tag_words,
    "tag_phrases": q_tag_phrases,
    "tag_many_phrases": q_tag_many_phrases,
    "filter_many_keywords": q_filter_many_keywords,
    "refine_labels": q_refine_labels,
    "entity_counts": q_entity_counts,
    "scan_sources": q_scan_sources,
    "source_status": q_source_status,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_ranges": q_csv_ranges,
    "json_arrays": q_json_arrays,
    "drop_missing": q_drop_missing,
    "title_filter": q_title_filter,
    "union_sources": q_union_sources,
    "distinct_corpus": q_distinct_corpus,
    "null_counts": q_null_counts,
    "dict_flatten": q_dict_flatten,
    "export_records": q_export_records,
    "export_labels": q_export_labels,
    "flatten_export": q_flatten_export,
    "record_parts": q_record_parts,
    "export_roundtrip": q_export_roundtrip,
    "bio_tags": q_bio_tags,
    "word_level": q_word_level,
    "train_val_split": q_train_val_split,
    "split_files": q_split_files,
    "decode_ids": q_decode_ids,
    "argmax_class": q_argmax_class,
    "label_map_invert": q_label_map_invert,
    "pad_rows": q_pad_rows,
    "align_pieces": q_align_pieces,
    "align_subwords": q_align_subwords,
    "pack_subwords": q_pack_subwords,
    "merge_pieces": q_merge_pieces,
    "merge_candidates": q_merge_candidates,
    "decode_spans": q_decode_spans,
    "entity_f1": q_entity_f1,
    "entity_f1_by_type": q_entity_f1_by_type,
    "entity_f1_pieces": q_entity_f1_pieces,
    "token_accuracy": q_token_accuracy,
    "best_run": q_best_run,
    "score_tokens": q_score_tokens,
    "train_tagger": q_train_tagger,
    "score_words": q_score_words,
    "train_sequence": q_train_sequence,
    "viterbi_tags": q_viterbi_tags,
    "tag_sequences": q_tag_sequences,
    "corpus_entity_counts": q_corpus_entity_counts,
}
