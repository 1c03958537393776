import pytest


@pytest.fixture(scope="module")
def documents(spark):
    """The smallest documents table, as a frame and as a list of (doc_id, text)."""
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return frame, [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
