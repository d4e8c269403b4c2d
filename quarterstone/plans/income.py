"""Income items, and income items as shares of revenue (cost structure)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import any_q4, ratio
from quarterstone.operators.statements import Lookup, Period, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, INCOME_HEADS, PERIOD

PERIODS = {"mrq": Lookup.latest, "q4": Lookup.annual}


def income_items(source: StatementSource, kind: str) -> DataFrame:
    """All income items of the latest report (``mrq``) or fiscal year (``q4``), unrounded."""
    def columns(lk: Lookup):
        period = PERIODS[kind](lk, "is")
        return [F.col("code").alias(CODE), period.label.alias(PERIOD)] + [
            lk.value("is", item, period).alias(head) for item, head in INCOME_HEADS.items()
        ]
    return report(source, columns)


def income_years(source: StatementSource, years: int = 5, *, fix_investment: bool = False) -> DataFrame:
    """Income items of the last fiscal years, one distinct row per company and year.

    The original relation reads investment income of two and more years back from the
    latest year. That is kept by default so results stay equal; ``fix_investment`` reads
    the row's own year.
    """
    def columns(lk: Lookup):
        period = Period("row's year", F.col("period"))
        first = F.when(F.col("back") >= 2, lk.annual("is").label).otherwise(period.label)
        investment_year = period if fix_investment else Period("first year", first)
        return [F.col("code").alias(CODE), period.label.alias(PERIOD)] + [
            lk.value("is", item, investment_year if item == "investment_income" else period).alias(head)
            for item, head in INCOME_HEADS.items()]

    def spread(rows: DataFrame) -> DataFrame:
        back = F.explode(F.array(*[F.lit(k) for k in range(years)]))
        return (rows.withColumn("back", back)
                .withColumn("period", any_q4(F.col("is_rp"), -F.col("back"))))

    return report(source, columns, spread).distinct()


def cost_shares(source: StatementSource, kind: str) -> DataFrame:
    """Every monetary income item divided by total revenue."""
    def columns(lk: Lookup):
        period = PERIODS[kind](lk, "is")
        revenue = lk.value("is", "total_revenue", period)
        return [F.col("code").alias(CODE), period.label.alias(PERIOD)] + [
            ratio(lk.value("is", item, period), revenue).alias(head)
            for item, head in INCOME_HEADS.items() if item != "eps"
        ]
    return report(source, columns)


# Public names of the income items; fixed values (finance expense precedes selling).
PUBLIC_INCOME = {
    "is01": "营业总收入", "is02": "营业收入", "is03": "营业总成本", "is04": "营业成本",
    "is05": "管理费用", "is06": "财务费用", "is07": "销售费用", "is08": "资产减值",
    "is09": "营业税金", "is10": "投资收益", "is11": "公允价值变动", "is12": "营业外收入",
    "is13": "营业外支出", "is14": "利润总额", "is15": "所得税", "is16": "净利润",
    "is17": "少数股东损益", "is18": "归母净利润", "is19": "基本每股收益",
}


def public_income(source: StatementSource, company: DataFrame, kind: str) -> DataFrame:
    items = [F.col(head).alias(name) for name, head in PUBLIC_INCOME.items()]
    return with_company(income_items(source, kind), company, PERIOD, items)


def public_cost(source: StatementSource, company: DataFrame, kind: str) -> DataFrame:
    """Margins and expense ratios."""
    c = F.col
    return with_company(cost_shares(source, kind), company, PERIOD, [
        (1 - c("营业成本")).alias("gpm"),
        c("管理费用").alias("aer"),
        c("销售费用").alias("ser"),
        c("财务费用").alias("fer"),
        (c("管理费用") + c("销售费用") + c("财务费用")).alias("sga"),
        (1 - c("营业成本") - c("管理费用") - c("销售费用")).alias("ccr"),
        c("资产减值").alias("ail"),
        (c("营业外收入") - c("营业外支出") + c("投资收益")).alias("other"),
        c("净利润").alias("npm"),
        c("少数股东损益").alias("ncl"),
    ], "code name area idst rp")
