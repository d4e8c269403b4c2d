"""SimHash fingerprints of word shingles, vectorised over batches of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import tidied

# fixed values of XXH64
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)

SPREAD = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1)[:, None],
                     axis=1, bitorder="little").reshape(256, 8).view("<u8")[:, 0]  # one byte per bit


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of many slices of one byte buffer. Slices under 32 bytes are hashed
    together, one length at a time; longer ones by the library."""
    padded = np.append(buffer, np.zeros(8, np.uint8))
    eight = np.ndarray(len(buffer) + 1, "<u8", padded, strides=(1,))
    four = np.ndarray(len(buffer) + 1, "<u4", padded, strides=(1,))
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(lengths, kind="stable")
    cuts = np.searchsorted(lengths[order], np.arange(33))
    for size in range(32):
        rows = order[cuts[size]:cuts[size + 1]]
        if not len(rows):
            continue
        at = starts[rows]
        h = np.full(len(rows), np.uint64(seed) + P5 + np.uint64(size))
        end = at + size
        for _ in range(size // 8):
            h ^= _rotated(eight[at] * P2, 31) * P1
            h = _rotated(h, 27) * P1 + P4
            at = at + 8
        if size % 8 >= 4:
            h ^= four[at].astype(np.uint64) * P1
            h = _rotated(h, 23) * P2 + P3
            at = at + 4
        for k in range(size % 4):
            h ^= buffer[end - size % 4 + k].astype(np.uint64) * P5
            h = _rotated(h, 11) * P1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
        out[rows] = h
    raw = buffer.tobytes()
    for row in order[cuts[32]:].tolist():
        out[row] = xxhash.xxh64_intdigest(raw[starts[row]:starts[row] + lengths[row]], seed)
    return out


def simhashes(texts: list[str | None], width: int = 3, seed: int = 42) -> np.ndarray:
    """One fingerprint per text. Words are runs without ASCII blanks, only A-Z are lower-cased;
    shingles of ``width`` words, repeats included, or the whole sequence where it is shorter. Bit
    b is set where it is set in over half of the shingles' hashes; a text without words gives 0."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    fingerprints = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return fingerprints
    buffer = np.frombuffer(b" ".join(b" ".join(words[i]) for i in full), np.uint8)
    ends = np.append(np.flatnonzero(buffer == 32), len(buffer))
    begins = np.append(0, ends[:-1] + 1)
    counts = counts[full]
    used = np.minimum(counts, width)  # words of a shingle
    shingles = counts - used + 1
    first_word = np.cumsum(counts) - counts
    first = np.cumsum(shingles) - shingles
    word = np.arange(shingles.sum()) + np.repeat(first_word - first, shingles)
    starts = begins[word]
    hashes = xxh64(buffer, starts, ends[word + np.repeat(used, shingles) - 1] - starts, seed)
    # sums of single bits in byte lanes, over runs of at most 255 shingles of one text
    runs = -(-shingles // 255)
    first_run = np.cumsum(runs) - runs
    run_starts = np.repeat(first, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first_run, runs))
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(SPREAD[lanes[:, k]], run_starts) for k in range(8)], axis=1)
    ones = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 64).astype(np.int64), first_run, axis=0)
    bits = np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little")
    fingerprints[full] = bits.view("<u8")[:, 0]
    return fingerprints


def _fingerprint_batches(text: int, most: int = 1 << 21):
    def run(batches):
        for batch in batches:
            prints, part, size = [np.zeros(0, np.uint64)], [], 0
            for value in batch.column(text):
                part.append(value.as_py())
                size += len(part[-1] or "")
                if size > most:
                    prints.append(simhashes(part))
                    part, size = [], 0
            prints.append(simhashes(part))
            fp = pa.array(np.concatenate(prints).view(np.int64))
            kept = [k for k in range(batch.num_columns) if batch.schema.names[k] != "_printed_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), fp], [*(batch.schema.names[k] for k in kept), "fp"])
    return run


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """doc_id, or the columns ``keep``, and ``fp``: the fingerprint's 64 bits as a (signed) long, of
    whole texts; null text: zero."""
    if keep is None:
        docs, keep = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ["doc_id"]
    rows = docs.select(*keep, F.col("text").alias("_printed_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.select(*keep).schema.fields)
    return rows.mapInArrow(tidied(_fingerprint_batches(len(keep))), kinds + "fp long")
