"""Exact interpolated percentiles by group that never hold a whole group in one task.

The built-in exact aggregate keeps every distinct value of a group in one buffer. Here values are
first reduced to frequencies: (group, metric, key, value, n), where ``key`` is a 64-bit integer in the
order of the values. Ranks are then found digit by digit: a histogram over the highest 16 bits tells
which digit holds a wanted rank, the next one looks at the next 16 bits below it, and so on. A histogram
of a group and metric has at most 65,536 rows whatever the data. As soon as every digit that holds a wanted
rank has at most ``LEAST`` distinct values, these are ranked; all 64 bits make a single value.
Nothing is sampled or approximated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16  # bits of a key that one histogram looks at
LEAST = 1 << DIGIT  # distinct values that are ranked in one task

Stage = Callable[[DataFrame, str], DataFrame]


def ordered_key(value: Column) -> Column:
    """A 64-bit integer that ascends with the value: equal for equal doubles (-0.0 and 0.0 are
    equal), different for different ones. Infinite values are the outermost, NaN is the largest.

    The integer is the one that a double's own bits make: 52 bits of fraction below the binary exponent. Spark has no
    function for the bits, so exponent and fraction are computed, exactly, by powers of two.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # the logarithm may be rounded over a power of two
    power = guess + F.when(F.pow(F.lit(2.0), guess) > size, -1).when(F.pow(F.lit(2.0), guess + 1) <= size, 1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), power) - 1) * float(1 << 52)
    tiny = size * float(1 << 537) * float(1 << 537)  # below the normal doubles: a multiple of 2 ** -1074
    smallest = 2.0 ** -1022
    magnitude = (F.when(size == 0, 0).when(size == float("inf"), 2047 << 52).when(size < smallest, tiny.try_cast("bigint"))
                 .otherwise((power + 1023).cast("bigint") * (1 << 52) + fraction.try_cast("bigint")))
    signed = F.when(F.isnan(value), (2047 << 52) + 1).when(value < 0, -magnitude).otherwise(magnitude)
    return signed.cast("bigint")


def _prefix(level: int) -> Column:
    """The highest ``level`` digits of a key; ascending with it."""
    return F.shiftright("key", 64 - DIGIT * level).cast("bigint")


def exact_percentiles(rows: DataFrame, group: str, wanted: dict[str, tuple[Column, float]],
                      count_as: str = "count", stage: Stage | None = None, least: int = LEAST) -> DataFrame:
    """One row per group: the group, its row count, and each named column's percentile.

    NULL values are ignored, infinite values are values, NaN is the largest; a group without values has NULL. A NULL group is a group.

    ``stage`` writes a frame once under a name and returns it as stored. With it, the frequency table is
    computed once, every round reads it from there, and rounds end as soon as ``least`` distinct values are left for each rank.
    Without it, the plan stays lazy and holds all four rounds, each of which computes the frequencies again
    unless Spark reuses the exchange.
    """
    metrics: dict[str, int] = {}
    columns: list[Column] = [F.lit(0.0)]  # metric 0 has one value per row and counts them
    targets: list[Column] = []
    for name, (column, p) in wanted.items():
        if str(column) not in metrics:
            metrics[str(column)] = len(columns)
            columns.append(column.cast("double"))
        targets.append(F.struct(F.lit(metrics[str(column)]).alias("metric"),
                                F.lit(name).alias("name"), F.lit(float(p)).alias("p")))

    keep = stage or (lambda frame, name: frame)
    cells = F.array(*[F.struct(F.lit(i).alias("metric"), c.alias("v")) for i, c in enumerate(columns)])
    freq = keep(rows.select(F.col(group).alias("g"), F.explode(cells).alias("c"))
                .select("g", "c.metric", "c.v").where(F.col("v").isNotNull())
                .groupBy("g", "metric", "v").agg(F.count("*").alias("n"))
                .withColumn("key", ordered_key(F.col("v"))), "frequencies")

    # (g, metric, name, part, prefix, rank): wanted ranks, counted from the smallest key of the prefix
    totals = freq.groupBy("g", "metric").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    rank = F.col("t.p") * (F.col("total") - 1)
    ends = F.array(F.struct(F.lit("lo").alias("end"), F.floor(rank).alias("rank")), F.struct(F.lit("hi").alias("end"), F.ceil(rank).alias("rank")))
    ranks = (totals.withColumn("t", F.explode(F.filter(F.array(*targets), lambda t: t["metric"] == F.col("metric"))))
             .select("g", "metric", "held", F.col("t.name").alias("name"), (rank - F.floor(rank)).alias("share"), F.explode(ends).alias("e"))
             .select("g", "metric", "name", "share", "e.end", "e.rank", F.lit(0).cast("bigint").alias("prefix"), "held"))
    ranks, level = keep(ranks, "ranks"), 0
    while level < 64 // DIGIT:
        if stage and (ranks.agg(F.max("held")).first()[0] or 0) <= least:
            break
        ranks, level = keep(_narrowed(freq, ranks, level), "ranks"), level + 1

    picked = _ranked(freq, ranks, level).groupBy(F.col("g").alias("pg")).agg(*[_interpolated(name).alias(name) for name in wanted])
    groups = freq.where("metric = 0").groupBy("g").agg(F.sum("n").alias(count_as))
    return (groups.join(picked, F.col("g").eqNullSafe(F.col("pg")), "left")
            .select(F.col("g").alias(group), count_as, *wanted))


def _inside(freq: DataFrame, ranks: DataFrame, level: int) -> DataFrame:
    """The frequencies under the prefixes that hold a wanted rank."""
    holding = ranks.select(F.col("g").alias("hg"), F.col("metric").alias("hm"), F.col("prefix").alias("hp")).distinct()
    placed = freq.withColumn("prefix", _prefix(level) if level else F.lit(0).cast("bigint"))
    return placed.join(holding, F.col("g").eqNullSafe(F.col("hg")) & (F.col("metric") == F.col("hm")) & (F.col("prefix") == F.col("hp")), "left_semi")


def _met(counted: DataFrame, ranks: DataFrame) -> DataFrame:
    """Wanted ranks with the row of ``counted`` (n rows from ``below``) that each falls on."""
    of = [F.col(f"c.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("g", "metric", "prefix")]
    on = reduce(lambda a, b: a & b, of) & (F.col("c.below") <= F.col("r.rank")) & (F.col("r.rank") < F.col("c.below") + F.col("c.n"))
    return counted.alias("c").join(ranks.alias("r"), on)


def _below(*order: str) -> Column:
    """Rows before this one under its prefix."""
    before = Window.partitionBy("g", "metric", "prefix").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(before), F.lit(0))


def _narrowed(freq: DataFrame, ranks: DataFrame, level: int) -> DataFrame:
    """The wanted ranks under the next digit; no window holds more rows than a digit has values."""
    histogram = (_inside(freq, ranks, level).groupBy("g", "metric", "prefix", _prefix(level + 1).alias("next"))
                 .agg(F.sum("n").alias("n"), F.count("*").alias("held")).withColumn("below", _below("next")))
    return _met(histogram, ranks).select(
        "r.g", "r.metric", "r.name", "r.share", "r.end", (F.col("r.rank") - F.col("c.below")).alias("rank"),
        F.col("c.next").alias("prefix"), "c.held")


def _ranked(freq: DataFrame, ranks: DataFrame, level: int) -> DataFrame:
    """The value at each wanted rank."""
    return (_met(_inside(freq, ranks, level).withColumn("below", _below("key")), ranks)
            .select("r.g", "r.name", "r.share", "r.end", "c.v"))


def _interpolated(name: str) -> Column:
    def at(end: str) -> Column:
        return F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col("v")))

    share = F.max(F.when(F.col("name") == name, F.col("share")))
    return F.when((share == 0) | (at("lo") == at("hi")), at("lo")).otherwise(at("lo") + (at("hi") - at("lo")) * share)
