"""Words of batches of whole texts as arrays, for models over terms and text shape."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 22
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())  # stripped from a term's ends


@dataclass
class Words:
    """``codes[k]`` is the number in ``distinct`` of the k-th word; document d has the words from
    ``starts[d]`` on, ``counts[d]`` of them."""
    distinct: list[str]
    codes: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sum over each document of a value per word."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return total[self.starts + self.counts] - total[self.starts]

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, number, times) for the distinct non-negative numbers[word] of each document."""
        span = int(numbers.max(initial=0)) + 1
        of_word = numbers[self.codes] if len(numbers) else self.codes
        keep = of_word >= 0
        key, times = np.unique(self.owner[keep] * span + of_word[keep], return_counts=True)
        return key // span, key % span, times


def split(texts: pa.Array) -> Words:
    lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten()
    keep = pc.not_equal(flat, "")  # blanks at a text's ends
    kept = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    offsets = kept[offsets - offsets[0]]
    coded = flat.filter(keep).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return Words(coded.dictionary.to_pylist(), codes, offsets[:-1], np.diff(offsets))


def term(word: str) -> str:
    return word.strip(EDGES).lower()


def hashed(words: list[str], length: int | None = None, bits: int = HASH_BITS) -> np.ndarray:
    """Bucket of each word's term, or of the term's first ``length`` characters; -1 for a term that
    is empty, or not longer than that."""
    mask, crc = (1 << bits) - 1, zlib.crc32
    if length is None:
        terms = map(term, words)
    else:
        terms = (f"{t[:length]}*" if len(t) > length else "" for t in map(term, words))
    return np.fromiter((crc(t.encode("utf-8", "surrogatepass")) & mask if t else -1 for t in terms), np.int64, len(words))


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each (or one longer text)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most)) + 1
        stop = min(stop, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label), each once, of the labels 0 and 1 of documents that are not held out."""
    return (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out()).distinct())


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents that are not held out, those with the
    smallest hash. The chosen ids are at most ``most`` rows, which bounds the broadcast. A doc_id may still
    stand on many rows: ``one_each`` bounds what is learned from them."""
    chosen = labelled(labels, label).orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id", "label").limit(most)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label"))


def one_each(rows: DataFrame, features: str) -> DataFrame:
    """One row for each doc_id and label, that whose features have the smallest hash: no more rows
    than labels were chosen reach the driver, however often a labelled doc_id is repeated."""
    return rows.groupBy("doc_id", "label").agg(F.min_by(features, F.xxhash64(features)).alias(features))
