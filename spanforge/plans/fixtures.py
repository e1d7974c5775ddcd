"""Job parameters used by the registered queries over the test tables.

The dictionary plays the role of the keyword YAML files: a small driver-side
parameter with a known size.  Every query still reads the test tables, so
its work grows with them.
"""

from __future__ import annotations

# Test dictionary whose terms occur in the documents.
TEST_DICTIONARY = {
    "programming_languages": ["rewh", "thatin", "rewh rewh", "eriner thanea"],
    "databases": ["orre", "ononst", "tion", "anea eriner"],
    "frameworks_libraries": ["inoran", "orantion"],
    "tools": ["hehely", "tion", "ther"],
}
TEST_EXCLUSIONS = ["ther"]
TITLE_KEYWORDS = ["ring", "then"]

# Reduced dictionary for "predicted" tags in the scoring queries: drops one term per
# category and one phrase, so predictions differ from the gold tags.
PRED_DICTIONARY = {
    "programming_languages": ["rewh", "rewh rewh"],
    "databases": ["orre", "ononst", "tion"],
    "frameworks_libraries": ["orantion"],
    "tools": ["hehely", "thatin"],
}

CHUNK_MAX_LEN = 50
SPLIT_RATIO = 0.8
SPLIT_SEED = 42
PART_SIZE = 50
PIECE_HEAD = 4
PAD_LEN = 128
# a public tokenizer vocabulary (lower case, word ends marked); read in place
VOCABULARY_PATH = "/opt/tokenizers/word_bpe_49k.json"
N_CLASSES = 9


def fixed_tagger() -> tuple[list[tuple[str | None, str, int, float]], list[float], list[list[float]]]:
    """A sequence tagger written down by rule from the test dictionary: ``(previous word or None, word,
    label id, weight)``, start scores and transition scores."""
    from ..sources.dictionary import LABEL_ALIAS, LABELS

    number = {t: i for i, t in LABELS}
    weights, seen = [], set()
    for term, _category, _priority, label in flat_dictionary(TEST_DICTIONARY):
        first, *rest = term.split(" ")
        kind = LABEL_ALIAS[label]
        if (None, first) not in seen:
            weights.append((None, first, number[f"B-{kind}"], 2.0 if rest else 4.0))
        seen.add((None, first))
        for before, word in zip([first, *rest], rest):
            weights.append((before, word, number[f"I-{kind}"], 6.0))
    start = [0.25 if t == "O" else 0.0 for _i, t in LABELS]
    move = [[1.0 if b == "I-" + a[2:] else 0.5 if a == b == "O" else 0.0 for _j, b in LABELS] for _i, a in LABELS]
    return weights, start, move


def flat_dictionary(mapping: dict) -> list[tuple[str, str, int, str]]:
    """Driver-side flattening used only to inline the dictionary into oracle SQL."""
    from ..sources.dictionary import CATEGORIES

    rows = []
    for name, priority, label in CATEGORIES:
        seen = set()
        for item in mapping.get(name, []):
            for t in item if isinstance(item, list) else [item]:
                t = t.lower()
                if t not in seen:
                    seen.add(t)
                    rows.append((t, name, priority, label))
    return rows


def test_specs(sf: str):
    """Source registry over the test tables, in union order: two titled sources
    (pages: ``<title>`` element / html; part: name / type) and three untitled ones."""
    from pyspark.sql import functions as F

    from ..sources.registry import SourceSpec

    base = sf.rstrip("/")
    page_title = F.nullif(F.regexp_extract(F.col("html"), r"(?is)<title>(.*?)</title>", 1), F.lit(""))
    return [
        SourceSpec("pages", f"{base}/pages.parquet", description="html", title=page_title, rank=0),
        SourceSpec("part", f"{base}/part.parquet", description="p_type", title="p_name", rank=1),
        SourceSpec("documents", f"{base}/documents.parquet", description="text", rank=2),
        SourceSpec("benchmark", f"{base}/benchmark.parquet", description="text", rank=3),
        SourceSpec("conversations", f"{base}/conversations.parquet", description="text", rank=4),
    ]


def broken_spec(sf: str):
    """A registry row whose description column does not exist (status check)."""
    from ..sources.registry import SourceSpec

    return SourceSpec("benchmark_jobs", f"{sf.rstrip('/')}/benchmark.parquet",
                      description="jobdescription", title="title", rank=5)
