import shutil

from spanforge.plans import queries as Q
from spanforge.plans.fixtures import TEST_DICTIONARY, TEST_EXCLUSIONS
from spanforge.streaming import label_stream, start_label_sink


def test_stream_labels_equal_batch_labels(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    shutil.copy("/root/testdata/sf0.001/documents.parquet", src / "part-0.parquet")
    stream = label_stream(spark, str(src), TEST_DICTIONARY, TEST_EXCLUSIONS)
    q = start_label_sink(stream, "", name="stream_labels_test", fmt="memory")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT doc_id, chunk_no, start, `end`, entity FROM stream_labels_test").collect()
    d, x, n = Q.test_dictionary(spark)
    from spanforge.operators.chunking import chunk_corpus, clean_corpus
    from spanforge.operators.tagging import refine_labels
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("text", "description")
    batch = refine_labels(chunk_corpus(clean_corpus(docs)), d, x, dict_bytes=n).select(
        "doc_id", "chunk_no", "start", "end", "entity").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch)) and len(got) > 0
