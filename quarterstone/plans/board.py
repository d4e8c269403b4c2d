"""Directors, supervisors and executives: holdings and pay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import scaled
from quarterstone.operators.keyed import keep_first
from quarterstone.sources.markup import html_records

# The three member lists in the order in which they are concatenated, and the columns
# kept; fixed values.
LISTS = ("dsh", "jsh", "ggc")
COLUMNS = ("股票代码", "姓名", "职务", "持股数", "报酬", "起止时间")


def members_from_pages(pages: DataFrame) -> DataFrame:
    """Members in the board tables of web pages (``code, list, html``); ``--`` counts as 0."""
    cleaned = pages.withColumn("html", F.replace("html", F.lit("--"), F.lit("0")))
    records = html_records(cleaned, ["code", "list"], "html", list(COLUMNS[1:]))
    return records.select(
        F.col("code").alias("股票代码"), "list", F.col("row_no").alias("position"), "姓名", "职务",
        F.col("持股数").cast("decimal(20,2)").alias("持股数"),
        F.col("报酬").cast("decimal(20,2)").alias("报酬"), "起止时间")


def first_in_list(members: DataFrame) -> DataFrame:
    """Each name once per company and list: its first position."""
    return keep_first(members, ["股票代码", "list", "姓名"], ["position"])


def board_all(members: DataFrame) -> DataFrame:
    """Each name once per company: from the first list that has it, at its first position.

    Keeping the first per list and then the first across lists is the same minimum over
    (list, position), so one aggregation does both; list and position are one number, positions below 2 ** 56.
    """
    rank = F.array_position(F.array(*[F.lit(name) for name in LISTS]), F.col("list"))
    place = F.shiftleft(rank.cast("bigint"), 56) + F.col("position")
    return keep_first(members, ["股票代码", "姓名"], [place]).select(*COLUMNS)


def board_summary(board: DataFrame) -> DataFrame:
    return board.groupBy(F.col("股票代码").alias("code")).agg(
        F.sum("持股数").alias("shares"), F.sum("报酬").alias("salaries"))


def board(company: DataFrame, members: DataFrame) -> DataFrame:
    """Every company with the holdings and pay of its board, where known."""
    return (company.join(board_summary(members), "code", "left").select(
        "code", "name", "area", F.col("industry").alias("idst"),
        F.col("totals").alias("total_shares"), F.col("outstanding").alias("out_shares"),
        scaled(F.col("shares"), 100_000_000, 4).alias("mgmt_shares"),
        scaled(F.col("salaries"), 100_000_000, 4).alias("salaries")))
