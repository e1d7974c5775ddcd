"""Sub-word pieces by longest match over a given public vocabulary.

A vocabulary is a file of some published tokenizer; its path is a parameter and nothing is
trained here.  Four formats are read: a word-piece list (``##`` marks pieces inside a word), the
JSON of a byte-pair model (pieces that end a word carry a suffix, or ones that begin it a space), rank
files, and sentence-piece models.  Inside, all are one set of strings over words with a mark
before them (``START``) or behind them (``END``).

A word is cut from the left: at each place the longest piece of the vocabulary, or else one
character.  Pieces after the first are returned with ``##``, as the merge and alignment functions
expect.  One Arrow pass cuts a batch; each distinct word of it is cut once.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

START, END = "\x02", "\x01"
UNIT = re.compile(r"\w+|[^\w\s]")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others are numbered from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _decoded(raw: bytes) -> str | None:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return None  # part of a character: no longest match of whole characters ends there


class Vocabulary:
    """Pieces over marked words; ``marks`` are put around a word before it is cut."""

    def __init__(self, pieces, before: str = "", after: str = ""):
        self.before, self.after = before, after
        self.pieces = frozenset(p for p in pieces if p and p.strip(START + END))
        reach: dict[str, int] = {}
        for p in self.pieces:
            reach[p[0]] = max(reach.get(p[0], 0), len(p))
        self.reach = reach  # longest piece by first character

    def cut(self, word: str) -> list[str]:
        s, i, out = self.before + word + self.after, 0, []
        while i < len(s):
            n = next((n for n in range(min(self.reach.get(s[i], 1), len(s) - i), 1, -1) if s[i:i + n] in self.pieces), 1)
            piece = s[i:i + n].strip(START + END)
            if piece:
                out.append("##" + piece if out else piece)
            i += n
        return out


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a published tokenizer, by the kind of its file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        return Vocabulary((START + p[1:] if p.startswith("▁") else p for p in names if "▁" not in p[1:]), before=START)
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            model = json.load(f)["model"]
            letters, suffix = byte_letters(), model.get("end_of_word_suffix") or ""
            texts = (_decoded(bytes(letters[c] for c in p.removesuffix(suffix))) + (END if suffix and p.endswith(suffix) else "")
                     for p in model["vocab"] if all(c in letters for c in p.removesuffix(suffix))
                     and _decoded(bytes(letters[c] for c in p.removesuffix(suffix))) is not None)
            if suffix:
                return Vocabulary(texts, after=END)
        elif path.endswith(".tiktoken"):
            texts = (t for t in (_decoded(base64.b64decode(line.split()[0])) for line in f if line.strip()) if t is not None)
        else:
            return Vocabulary((p[2:] if p.startswith("##") else START + p for p in map(str.strip, f) if p), before=START)
        return Vocabulary((START + t[1:] if t.startswith(" ") else t for t in texts), before=START)


def subwords(spark: SparkSession, vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """``array<string>`` of words -> ``array<array<string>>`` of their pieces; null words have none."""
    shared = spark.sparkContext.broadcast(vocabulary)  # as large as the vocabulary's file

    def cut_rows(rows: pa.Array) -> pa.Array:
        v, known = shared.value, {None: []}
        out = []
        for words in rows.to_pylist():
            for w in words or ():
                if w not in known:
                    known[w] = v.cut(w)
            out.append(None if words is None else [known[w] for w in words])
        return pa.array(out, pa.list_(pa.list_(pa.string())))

    return lambda words: F.arrow_udf(cut_rows, "array<array<string>>")(words)


def subword_lengths(spark: SparkSession, vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """``array<string>`` of sentences -> number of pieces of each, over its words and
    single signs."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def count_rows(rows: pa.Array) -> pa.Array:
        v, known = shared.value, {}

        def size(w):
            if w not in known:
                known[w] = len(v.cut(w))
            return known[w]

        return pa.array([None if r is None else [sum(map(size, UNIT.findall(s or ""))) for s in r] for r in rows.to_pylist()], pa.list_(pa.int32()))

    return lambda sentences: F.arrow_udf(count_rows, "array<int>")(sentences)
