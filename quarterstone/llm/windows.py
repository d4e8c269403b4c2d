"""Which windows of a host's token streams can be on many of its pages: a filter before the exact search of ``runs``.

A window is known by the least hash of the short runs (grams) inside it; equal windows have equal least hashes, and
neighbouring windows mostly share theirs, so a page has far fewer of them than tokens. Their pages are counted by host, exactly but for
collisions, which only add to a count. Those on enough pages are marked in a bitmap of fixed size. What it lets
through wrongly costs work and changes no result; a window that is on enough pages always passes.
"""

from __future__ import annotations

from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import tidied

SLOTS = 1 << 26  # bits of the bitmap
CHUNK_TOKENS = 1 << 23  # tokens of a table for each group that is counted together
FLUSH_KEYS = 1 << 20
MOST_WORDS = 1 << 20  # words whose hash a task keeps

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = found = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found


def window_keys(words: Words, host: str, tokens: list[str], long: int) -> np.ndarray:
    """A key for each window of ``long`` tokens, equal for equal windows of a host."""
    if len(tokens) < long:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    gram = max(1, long // 2)
    runs = np.full(len(tokens) - gram + 1, words[host], np.uint64)
    for k in range(gram):
        runs = _mixed(runs + hashes[k:len(tokens) - gram + 1 + k])
    count = len(tokens) - long + 1
    least = runs[:count].copy()
    for k in range(1, long - gram + 1):
        np.minimum(least, runs[k:k + count], out=least)
    return _mixed(least)


def _parts(keys: np.ndarray, chunks: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and 32 bits of each key."""
    return (keys >> np.uint64(32)) % np.uint64(chunks), keys.astype(np.uint32)


def _slots(chunk, low):
    return (low + chunk * 0x9E3779B1) % SLOTS


def _counted_batches(long: int, chunks: int):
    """Keys of many pages with their numbers of pages, packed by host and group."""
    def run(batches):
        words, met, size = Words(), defaultdict(list), 0

        def packed():
            rows = []
            for host, arrays in met.items():
                keys, counts = np.unique(np.concatenate(arrays), return_counts=True)
                group, low = _parts(keys, chunks)
                for chunk in np.unique(group):
                    mine = group == chunk
                    some, n = low[mine], counts[mine]
                    rows.append((int(chunk), host, some[n == 1].tobytes(), some[n > 1].tobytes(), n[n > 1].astype(np.uint32).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [[]] * 5, (pa.int64(), pa.string(), *[pa.binary()] * 3))],
                                              ["chunk", "host", "once", "often", "counts"])

        for batch in batches:
            for host, blocks in zip(*(batch.column(k).to_pylist() for k in range(2))):
                keys = np.unique(window_keys(words, host, " ".join(blocks).split(" "), long))
                if len(keys):
                    met[host].append(keys)
                    size += len(keys)
                if size >= FLUSH_KEYS:
                    yield packed()
                    met.clear()
                    size = 0
        yield packed()
    return run


def _summed_groups(least_pages: int):
    """Keys of a group that are on enough pages of one host."""
    def run(table):
        met, rows = defaultdict(list), []
        for host, once, often, counts in zip(*(table.column(c).to_pylist() for c in ("host", "once", "often", "counts"))):
            met[host].append((np.frombuffer(once, np.uint32), None))
            met[host].append((np.frombuffer(often, np.uint32), np.frombuffer(counts, np.uint32)))
        chunk = table.column("chunk")[0].as_py()
        out = []
        for host, parts in met.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(place, np.concatenate([np.ones(len(k)) if c is None else c for k, c in parts]), len(keys))
            kept = n >= least_pages
            out.append(pa.table({"host": pa.array([host] * int(kept.sum()), pa.string()), "n": pa.array(n[kept].astype(np.int64)),
                                 "slot": pa.array(_slots(chunk, keys[kept].astype(np.int64)))}))
        return pa.concat_tables(out)
    return run


def _token_batches(bitmap, long: int, chunks: int):
    """Tokens of the windows that pass, each with its place and whether such a window begins there."""
    def run(batches):
        words, bits = Words(), np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            rows: list[tuple] = []
            for seq, host, blocks in zip(*(batch.column(k).to_pylist() for k in range(3))):
                tokens = " ".join(blocks).split(" ")
                chunk, low = _parts(window_keys(words, host, tokens, long), chunks)
                slots = _slots(chunk.astype(np.int64), low.astype(np.int64))
                passed = (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1
                if passed.any():
                    steps = np.zeros(len(tokens) + 1, np.int64)
                    steps[:len(passed)] += passed
                    steps[long:long + len(passed)] -= passed
                    begins = passed.tolist() + [0] * (long - 1)
                    rows += [(seq, host, at, tokens[at], begins[at] == 1) for at in np.flatnonzero(np.cumsum(steps[:-1])).tolist()]
                if len(rows) >= 50_000:
                    yield _token_batch(rows)
                    rows = []
            yield _token_batch(rows)
    return run


def _token_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [[]] * 5, kinds)], ["seq", "host", "pos", "token", "begins"])


def frequent_tokens(given: DataFrame, streams: DataFrame, sizes: DataFrame, tokens: int, long: int, least_pages: int) -> DataFrame:
    """``seq, host, pos, token, begins``: the tokens of those windows of ``long`` tokens of ``streams`` (seq, host, blocks) that are in ``enough``
    streams of their host (``sizes``: host, enough) among all ``given`` ones (host, blocks; of ``tokens`` tokens), and of few others."""
    chunks = max(1, -(-tokens // CHUNK_TOKENS))
    packed = given.select("host", "blocks").mapInArrow(
        tidied(_counted_batches(long, chunks)), "chunk long, host string, once binary, often binary, counts binary")
    found = packed.groupBy("chunk").applyInArrow(_summed_groups(least_pages), "host string, n long, slot long")
    place = F.col("slot") + 1  # Spark's bitmaps count from 1
    rows = (found.join(sizes, "host").filter(F.col("n") >= F.col("enough"))
            .groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    bitmap = bytearray(SLOTS // 8)
    for row in rows:
        bitmap[(row["bucket"] - 1) * 4096:row["bucket"] * 4096] = row["bits"]
    shared = streams.sparkSession.sparkContext.broadcast(bytes(bitmap))
    return streams.select("seq", "host", "blocks").mapInArrow(
        tidied(_token_batches(shared, long, chunks)), "seq long, host string, pos int, token string, begins boolean")
