"""Repeated runs in sequences by distributed prefix doubling.

A suffix of a sequence is ranked by its first 1, 2, 4, ... elements. The rank of a prefix is the
place of its first occurrence in the order of all places, so equal ranks mean equal prefixes and a
rank also tells where the original is. A rank for 2^(k+1) elements follows from the ranks for 2^k at
a place and 2^k further on: one grouping and one join a round. Places whose prefix occurs once drop
out for good (nothing longer can repeat there), so rounds shrink to what is repeated.

Suffixes with an equal rank for m elements form an interval of the suffix array whose longest common
prefix is at least m; a run of m elements, 2^k <= m < 2^(k+1), is named by the ranks of its first and
its last 2^k elements.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import drop_stored, stored


def named(rows: DataFrame, by: list[str], across: bool, done: list[DataFrame]) -> DataFrame:
    """The rows whose ``by`` occurs more than once (``across``: in more than one sequence), with
    ``rank``, the smallest place among them. Counted with map-side combination and written, so that
    the join may split a frequent key; the written table is added to ``done``."""
    counts = (F.min("seq") < F.max("seq")) if across else (F.count(F.lit(1)) > 1)
    groups = stored(rows.groupBy(*by).agg(F.min("at").alias("rank"), counts.alias("_repeats"))
                    .filter("_repeats").drop("_repeats"), "ranks")
    done.append(groups)
    return rows.join(groups, by)


def ahead(rows: DataFrame, by: int) -> DataFrame:
    """Rows with ``next``, the rank ``by`` elements further on in the sequence; those without go."""
    there = Window.partitionBy("seq").orderBy("pos").rangeBetween(by, by)
    return rows.withColumn("next", F.first("rank").over(there)).filter(F.col("next").isNotNull())


def doubled(rows: DataFrame, length: int, across: bool, done: list[DataFrame]) -> DataFrame:
    """Ranks for ``2 * length`` elements from those for ``length`` (seq, pos, at, rank and more)."""
    paired = stored(ahead(rows, length).withColumnRenamed("rank", "first"), "pairs")
    done.append(paired)
    return named(paired, ["first", "next"], across, done)


def repeated_windows(rows: DataFrame, across: bool = False) -> DataFrame:
    """The windows that have an earlier occurrence: seq, pos, length. With ``across`` all those that occur in two
    sequences or more, with ``rank``: windows of one length and rank are equal.

    ``rows`` has one row per element: seq and pos (its place in its sequence), at (its place in the
    order of all elements), keys ``key1`` and ``key2`` that are equal for equal elements only, and
    ``lengths``, the lengths of the windows that begin there. Tables of a round are removed when the
    next one is written.
    """
    columns = ["seq", "pos", "at", "rank", "lengths"]
    done: list[DataFrame] = []
    level = stored(named(rows, ["key1", "key2"], across, done).select(*columns), "level")
    counts = F.lit(True) if across else F.col("rank") < F.col("at")
    found, length = [], 1
    while True:
        spans = (level.select("seq", "pos", "at", "rank", F.explode("lengths").alias("length"))
                 .filter((F.col("length") >= length) & (F.col("length") < 2 * length)))
        if length == 1:
            hits = spans
        else:
            last = level.select("seq", F.col("pos").alias("last"), F.col("rank").alias("last_rank"))
            runs = stored(spans.withColumn("last", F.col("pos") + F.col("length") - length).join(last, ["seq", "last"])
                          .select("seq", "pos", "at", "length", F.col("rank").alias("first_rank"), "last_rank"), "runs")
            done.append(runs)
            hits = named(runs, ["length", "first_rank", "last_rank"], across, done)
        found.append(stored(hits.filter(counts).select("seq", "pos", "length", *(["rank"] if across else [])), "found"))
        if level.filter(F.exists("lengths", lambda n: n >= 2 * length)).isEmpty():
            break
        following = stored(doubled(level, length, across, done).select(*columns), "level")
        for table in (*done, level):
            drop_stored(table)
        done.clear()
        level, length = following, 2 * length
    for table in (*done, level):
        drop_stored(table)
    return reduce(DataFrame.unionByName, found)
