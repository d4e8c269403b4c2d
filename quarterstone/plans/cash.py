"""Cash-flow quality: profit against operating cash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import scaled
from quarterstone.operators.statements import Lookup, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, LATEST_ANNUAL

# Column heads; fixed values.
PROFIT3, CASH3, GAP = "三年净利润", "三年经营现金流", "现金流减利润"


def cash_quality(source: StatementSource, years: int = 5) -> DataFrame:
    """Three-year sums of profit and operating cash, and cash less profit year by year."""
    def columns(lk: Lookup):
        profit = [lk.value("is", "net_profit", lk.annual("is", k)) for k in range(years)]
        cash = [lk.value("cf", "operating_cash", lk.annual("cf", k)) for k in range(years)]
        return [
            F.col("code").alias(CODE), lk.annual("is").label.alias(LATEST_ANNUAL),
            F.round(profit[0] + profit[1] + profit[2], 4).alias(PROFIT3),
            F.round(cash[0] + cash[1] + cash[2], 4).alias(CASH3),
            *[(-F.round(profit[k] - cash[k], 4)).alias(f"{GAP}{k or ''}") for k in range(years)],
        ]
    return report(source, columns)


def public_cash_quality(source: StatementSource, company: DataFrame, years: int = 5) -> DataFrame:
    heads = {PROFIT3: "ni3", CASH3: "c3", **{f"{GAP}{k or ''}": f"nicf{k or ''}" for k in range(years)}}
    values = [scaled(F.col(head), 10000, 2).alias(name) for head, name in heads.items()]
    return with_company(cash_quality(source, years), company, LATEST_ANNUAL, values, "code name rp idst area")
