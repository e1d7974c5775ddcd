"""Sentence breaks with learned abbreviations (F13), without labels.

A word that nearly always carries a dot is an abbreviation, and its dot ends no sentence.  For each
word the corpus gives how often it stands with a dot and without; a log likelihood ratio compares
that with the share of dots among all words, and the score favours short words and ones with inner
dots and drops with every plain occurrence.  The counts are one aggregate over the words of the
corpus, partly added up before the exchange; what is kept is a small table of the words above the threshold.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote_literal, split_sentences

THRESHOLD = 0.3
SURE = 0.99  # share of dots after an abbreviation
LONGEST = 20  # letters of an abbreviation


def dotted_words(text: Column) -> Column:
    """Words of a cleaned text as ``struct<word, dotted>``: quotes go, one last dot is the mark."""
    raw = F.filter(F.split(F.regexp_replace(text, "['\"]", ""), r"\s+"), lambda w: w.rlike("[a-z]"))
    return F.transform(raw, lambda w: F.struct(F.regexp_replace(w, r"\.$", "").alias("word"), w.endswith(".").cast("int").alias("dotted")))


def abbreviation_scores(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n_dotted, n_plain, score)`` of each word that stands with a dot at least once."""
    words = corpus.select(F.explode(dotted_words(F.col(text_col))).alias("w")).select("w.*")
    counts = words.groupBy("word").agg(F.sum("dotted").alias("n_dotted"), F.count("*").alias("n"))
    total = counts.agg(F.sum("n_dotted").alias("dots"), F.sum("n").alias("words"))  # one row
    plain = F.col("n") - F.col("n_dotted")
    share = F.col("dots") / F.col("words")
    ratio = 2 * (F.col("n_dotted") * (F.log(F.lit(SURE)) - F.log(share)) + plain * (F.log(F.lit(1 - SURE)) - F.log(1 - share)))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    size = (F.length("word") - inner).cast("double")
    score = ratio * F.exp(-size) * (inner + 1) * F.pow(size, -plain.cast("double"))
    return counts.where("n_dotted > 0").crossJoin(F.broadcast(total)).where("dots < words").select("word", "n_dotted", plain.alias("n_plain"), score.alias("score"))


def learn_abbreviations(corpus: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The words that score at least ``threshold``, up to ``LONGEST`` letters."""
    return abbreviation_scores(corpus, text_col).where((F.col("score") >= threshold) & (F.length("word") <= LONGEST))


def sentence_splitter(abbreviations: Iterable[str]):
    """A splitter (``Column -> Column``) that does not break after one of ``abbreviations`` and its dot."""
    words = sorted(set(abbreviations))
    if not words:
        return split_sentences
    kept = "|".join(quote_literal(w) for w in words)
    pattern = rf"(?<=\.)(?<!(?:^|[\s'\"])(?:{kept})\.)\s+"
    return lambda c: F.split(c, pattern)
