import zlib

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest documents table, in id order."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


@pytest.fixture(scope="session")
def held_out():
    return lambda doc_id: zlib.crc32(str(doc_id).encode()) % 3 == 1
