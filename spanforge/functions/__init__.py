"""Column functions (``Column -> Column``), all built from Spark built-ins."""

from .arrays import argmax, chunk_text, flatten_terms, invert_map, literal_map, pack, pad
from .spans import find_spans, phrase_word_spans, token_spans
from .stopwords import NLTK_ENGLISH
from .text import (
    clean_text,
    drop_commas,
    drop_inner_dots,
    keep_basic_chars,
    keyword_pattern,
    normalize_word,
    quote_literal,
    remove_stopwords,
    split_sentences,
    squeeze,
    strip_tags,
    text_length,
    word_tokens,
    words,
)

__all__ = [
    "NLTK_ENGLISH", "argmax", "chunk_text", "clean_text", "drop_commas", "drop_inner_dots",
    "find_spans", "flatten_terms", "invert_map", "keep_basic_chars", "keyword_pattern",
    "literal_map", "normalize_word", "pack", "pad", "phrase_word_spans", "quote_literal",
    "remove_stopwords", "split_sentences", "squeeze", "strip_tags", "text_length",
    "token_spans", "word_tokens", "words",
]
