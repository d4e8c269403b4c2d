"""Latest quotes against growth, and their percentiles by industry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import ratio, safe_div
from quarterstone.operators.percentiles import exact_percentiles
from quarterstone.plans.items import CODE
from quarterstone.session import written

QUOTE = "decimal(20,6)"


def valuation(latest: DataFrame, company: DataFrame, growth: DataFrame, label: str) -> DataFrame:
    """Quotes of the newest batch with industry and growth; the name is the quote's."""
    quote = latest.select(
        "code", "name", F.col("price").cast(QUOTE).alias("close"),
        *[F.col(c).cast(QUOTE).alias(c) for c in ("pe_ttm", "pb", "mktcap", "pctchg", "turnover")])
    dim = company.select("code", F.col("industry").alias("idst"), "area")
    rates = growth.select(
        F.col(CODE).alias("code"), F.col(label).alias("rp"), F.col("营收同比").alias("rg"),
        F.col("利润同比").alias("pg"), F.col("营收复合").alias("crg"), F.col("利润复合").alias("cpg"))
    pe_share = safe_div(F.col("pe_ttm"), F.lit(100).cast(QUOTE)).cast("decimal(22,8)")
    return quote.join(dim, "code").join(rates, "code").select(
        "code", "name", "rp", "idst", "area", "close", "pe_ttm", "pb",
        ratio(F.col("pb"), F.col("pe_ttm")).alias("roe_ttm"),
        "mktcap", "pctchg", "turnover", "rg", "pg", "crg", "cpg",
        ratio(pe_share, F.col("pg").cast("decimal(20,4)"), 2).alias("peg"))


def industry_stats(values: DataFrame, lazy: bool = False) -> DataFrame:
    """Company count and percentiles by industry, by ascending median P/E.

    P/E and P/B percentiles leave out companies without a positive value. Frequencies of the values are written once to the
    shared folder, unless the result has to stay ``lazy``, as a view does.
    """
    def positive(name: str):
        return F.when(F.col(name) > 0, F.col(name))

    wanted = {
        "pe50": (positive("pe_ttm"), 0.5), "pe25": (positive("pe_ttm"), 0.25),
        "pb50": (positive("pb"), 0.5), "pb25": (positive("pb"), 0.25),
        "roe50": (F.col("roe_ttm"), 0.5), "rg50": (F.col("rg"), 0.5), "pg50": (F.col("pg"), 0.5),
        "crg50": (F.col("crg"), 0.5), "cpg50": (F.col("cpg"), 0.5),
        "c50": (F.col("pctchg"), 0.5), "to50": (F.col("turnover"), 0.5),
    }
    return (exact_percentiles(values, "idst", wanted, stage=None if lazy else written)
            .withColumnRenamed("idst", "idst_name")
            .orderBy(F.col("pe50").asc_nulls_last()))
