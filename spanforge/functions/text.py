"""Text column functions (cleaning chain, tokens, sentences, lengths).

Every function maps ``Column -> Column`` with built-in Spark expressions only, so the
whole cleaning chain runs inside whole-stage codegen on the executors.  The chain order
matters and is: strip tags, keep basic characters, drop commas, drop inner dots, lower,
squeeze, remove stop words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import NLTK_ENGLISH

# The cleaning patterns of the original job.  ``(?d)`` (UNIX_LINES) makes
# Java's ``.`` stop only at ``\n`` as Python's does.
TAG_PATTERN = r"(?d)<.*?>"
# written out one by one: Java tests a class of single characters by one table, one of ranges by a chain of calls
NON_BASIC_PATTERN = rf"[^{ascii_letters}{digits}.,'\" ]+"
# the dot comes first, so the look-behind is tried at dots only
INNER_DOT_PATTERN = r"\.(?<!\w\.\.)(?!\s|$)"
# Python's word characters: letters, all kinds of numbers, underscore; no marks.  A token is
# a maximal run of them.  ASCII ones are listed first, so Java finds them in a table.
WORD_CLASS = rf"[[{ascii_letters}{digits}_]\p{{L}}\p{{N}}]"
WORD_TOKEN_PATTERN = WORD_CLASS + "+"
# a place between a word character and none, on either side
WORD_EDGE = rf"(?:(?<={WORD_CLASS})(?!{WORD_CLASS})|(?<!{WORD_CLASS})(?={WORD_CLASS}))"
# white space that is not one single space already
SQUEEZE_PATTERN = r"[\t\n\x0B\f\r]\s*| \s+"
# white space after a dot; again the look-behind comes second
SENTENCE_BREAK_PATTERN = r"\s(?<=\.\s)\s*"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tags(c: Column | str) -> Column:
    """delete ``<...>`` tags (non-greedy, one line); neighbouring words join.  Text without
    ``<`` is not searched."""
    return F.when(F.contains(_c(c), F.lit("<")), F.regexp_replace(_c(c), TAG_PATTERN, "")).otherwise(_c(c))


def keep_basic_chars(c: Column | str) -> Column:
    """each run outside ``a-zA-Z0-9 . , ' " space`` becomes one space."""
    return F.regexp_replace(_c(c), NON_BASIC_PATTERN, " ")


def drop_commas(c: Column | str) -> Column:
    """delete commas."""
    return F.replace(_c(c), F.lit(","), F.lit(""))


def drop_inner_dots(c: Column | str) -> Column:
    """delete a dot unless whitespace/end follows or a word char + dot precedes."""
    return F.regexp_replace(_c(c), INNER_DOT_PATTERN, "")


def squeeze(c: Column | str) -> Column:
    """collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(_c(c), SQUEEZE_PATTERN, " "))


def words(c: Column | str) -> Column:
    """split a squeezed string on single spaces."""
    return F.split(_c(c), " ")


def remove_stopwords(c: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """F8: drop tokens equal to a stop word (exact match, so ``the.`` survives).

    The membership test is an ``IN`` list that Catalyst turns into a hashed ``InSet``.
    """
    stop = list(NLTK_ENGLISH if stopwords is None else stopwords)
    if not stop:
        return _c(c)
    kept = F.filter(words(c), lambda w: ~w.isin(*stop))
    return F.array_join(kept, " ")


def kept_words(c: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """F6 + F8 for text whose only white space is the space, in one pass: without runs of spaces an
    empty word is a stop word."""
    stop = list(NLTK_ENGLISH if stopwords is None else stopwords)
    return remove_stopwords(c, ["", *stop]) if stop else squeeze(c)


def clean_text(c: Column | str, stopwords: Iterable[str] | None = None) -> Column:
    """F10 (F1-F9 chained): the composite cleaner; null input gives ``''``."""
    x = F.coalesce(_c(c).cast("string"), F.lit(""))
    x = strip_tags(x)
    x = keep_basic_chars(x)
    x = drop_commas(x)
    x = drop_inner_dots(x)
    x = F.lower(x)
    return kept_words(x, stopwords)


def word_tokens(c: Column | str) -> Column:
    """word tokens, the maximal runs of Python's word characters."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_TOKEN_PATTERN), 0)


def split_sentences(c: Column | str) -> Column:
    """sentence split after a dot followed by whitespace (cleaned text)."""
    return F.split(_c(c), SENTENCE_BREAK_PATTERN)


def text_length(c: Column | str) -> Column:
    """length in units: words plus single punctuation marks.  Each word becomes one letter and white
    space goes; what is left is counted, without an array of all units."""
    return F.length(F.translate(F.regexp_replace(_c(c), r"\w+", "w"), " \t\n\x0B\f\r", ""))


def normalize_word(c: Column | str) -> Column:
    """strip + lower before a dictionary lookup."""
    return F.lower(F.trim(_c(c)))


def quote_literal(term: str) -> str:
    """Quote a keyword as a regex literal (Java ``\\Q..\\E``)."""
    return r"\Q" + term.replace(r"\E", r"\E\\E\Q") + r"\E"


def _one_of(words: Iterable[str]) -> str:
    """A pattern of ``words``, grouped by first letter, so that most places are decided by one letter."""
    def quote(w):
        return "".join(c if c.isalnum() else "\\" + c for c in w)

    tails: dict[str, list[str]] = {}
    for w in sorted(words):
        tails.setdefault(w[0], []).append(quote(w[1:]))
    return f"(?:{'|'.join(quote(c) + '(?:' + '|'.join(t) + ')' for c, t in tails.items())})"


def key_pattern(keys: Iterable[str]) -> str:
    """A pattern that is found in a lower-case ASCII text with a space put before it if one of the text's tokens
    (a run of word characters, or of signs) is one of ``keys``; without any it is never found.  Signs are searched
    inside their runs too.  A word is tried behind a character that is none only: most places are decided by one look."""
    known = {k for k in keys if k and k.isascii()}
    word = {k for k in known if re.fullmatch(r"\w+", k, re.A)}
    sign = {k for k in known if re.fullmatch(r"[^\w\s]+", k, re.A)}
    parts = [rf"\W{_one_of(word)}(?!\w)"] * bool(word) + [_one_of(sign)] * bool(sign)
    return "|".join(parts) or "(?!)"


def keyword_pattern(keywords: Iterable[str]) -> str | None:
    """One case-insensitive alternation of quoted keywords; None if the list is empty."""
    kws = [k for k in keywords]
    if not kws:
        return None
    return "(?iu)(?:" + "|".join(quote_literal(k) for k in kws) + ")"
