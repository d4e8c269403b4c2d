"""Comparing the members of buckets of any size without one task ever holding a bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import stored

SIDE = ["block_low", "block_high", "block_second"]


def block_pairs(rows: DataFrame, bucket: list[str], member: str, size: int = 256, spread: int = 64,
                largest: int = 4096) -> DataFrame:
    """Rows of buckets with two members or more, once for each pair of blocks they belong to.

    A bucket of n members is cut into blocks of about ``size`` by a hash of ``member``; beyond
    ``spread`` blocks they grow up to ``largest`` members, and beyond that their number grows.
    Every two members of a bucket meet in exactly one (block_low, block_high) group: in the group
    (b, b) of their common block, or as a low and a high (block_second) row of another. A group
    stays small whatever the bucket's size, so that groups spread evenly over tasks. The result
    is dealt out and sorted by group.
    """
    # written first: a join with a plain table may split a bucket's rows over tasks
    sizes = stored(rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("block_n")).filter("block_n > 1"), "buckets")
    n = F.col("block_n")
    number = (F.when(n <= size * spread, F.ceil(n / size))
              .otherwise(F.greatest(F.lit(spread), F.ceil(n / largest))))
    own = F.expr("pmod(block_hash, block_number)")
    return (rows.join(sizes, bucket)
            .withColumn("block_number", number.cast("bigint"))
            .withColumn("block_hash", F.xxhash64(F.lit(7), member))
            .withColumn("block_own", own)
            .withColumn("block_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("block_number") - 1)))
            .withColumn("block_low", F.least("block_own", "block_other"))
            .withColumn("block_high", F.greatest("block_own", "block_other"))
            .withColumn("block_second", (F.col("block_own") == F.col("block_high")) & (F.col("block_low") < F.col("block_high")))
            .drop("block_n", "block_number", "block_hash", "block_own", "block_other")
            .repartition(*bucket, "block_low", "block_high")
            .sortWithinPartitions(*bucket, "block_low", "block_high"))


def whole_groups(batches, keys: list[str], least: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups from sorted batches, with the start of each group in the table.
    Holds at most about ``least`` rows and one group more."""
    held: list[pa.RecordBatch] = []

    def tables(last: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(len(table), bool)
        change[:1] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        if last:
            return table, starts, None
        end = int(starts[-1])  # the last group may go on
        return table.slice(0, end), starts[:-1], table.slice(end)

    count = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= least:
            table, starts, rest = tables(False)
            if len(table):
                yield table, starts
            held = rest.to_batches()
            count = 0 if len(table) else len(rest) // 2  # a long group: wait for more rows
    if held:
        table, starts, _ = tables(True)
        yield table, starts


def candidate_pairs(starts: np.ndarray, n: int, low: np.ndarray, high: np.ndarray,
                    second: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs to compare within the groups of a table, a distance of rows at a time."""
    left = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) - np.arange(n)
    cross = low != high
    live, d = np.flatnonzero(left > 1), 1
    while len(live):
        a, b = live, live + d
        keep = ~cross[a] | (second[a] != second[b])
        if keep.any():
            yield a[keep], b[keep]
        d += 1
        live = live[left[live] > d]


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node reachable by the links a-b, by hooking and jumping."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if np.array_equal(low, high):
            return root
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
