import duckdb

import __spark_entry__ as E
from spanforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents pages part benchmark conversations labels embeddings events".split()


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["entity", "n"] and df.count() > 0


def test_every_query_has_a_twin_or_is_rows_only():
    rows_only = set(QUERIES) - set(E.oracle_sql())
    assert rows_only == {"train_tagger", "train_sequence"}  # they depend on the fit


def test_selected_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["clean_text", "pack_chunks", "refine_labels", "distinct_corpus", "bio_tags", "entity_f1", "entity_f1_pieces", "csv_roundtrip", "merge_candidates", "tag_many_phrases", "tag_sequences", "csv_ranges"]:
        df = E.queries()[name](spark, SF)
        res = con.sql(E.oracle_sql()[name])
        assert sorted(df.columns) == sorted(res.columns), name
        assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), res.columns), name
