"""Texts of the given tables for tests that need no Spark."""

import pyarrow.parquet as pq


def sample_texts(n: int, folder: str = "/root/testdata/sf0.001") -> list[tuple[int, str]]:
    t = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))[:n]
