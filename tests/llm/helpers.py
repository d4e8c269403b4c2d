"""Small tables for the operators' tests."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, source), with columns that clash with names used inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def clashing(docs: DataFrame, *names: str) -> DataFrame:
    """The rows with extra columns under names that operators use themselves."""
    for name in names:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def components(n: int, links: list[tuple[int, int]]) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def tables(name: str, folder: str = FOLDER):
    pq = pytest.importorskip("pyarrow.parquet")
    return pq.read_table(f"{folder}/{name}.parquet")


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
