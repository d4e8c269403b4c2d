"""The company dimension and its join to report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.plans.items import CODE


def dim_company(listing: DataFrame) -> DataFrame:
    """The six descriptive columns kept from a company listing, keyed by code."""
    return listing.select("code", "name", "area", "industry", "outstanding", "totals", "holders")


def with_company(base: DataFrame, company: DataFrame, label: str, values: list[Column],
                 heads: str = "code name idst area rp") -> DataFrame:
    """Public form of a report: company columns and the period label in the order of ``heads``,
    then the values.

    No broadcast is forced: the dimension grows with the number of companies, so the
    planner decides from its measured size and otherwise joins by hash on the code, on
    which report rows are already partitioned.
    """
    dim = company.select("code", "name", F.col("industry").alias("idst"), "area")
    return (base.withColumnRenamed(CODE, "code").join(dim, "code")
            .withColumnRenamed(label, "rp").select(*heads.split(), *values))
