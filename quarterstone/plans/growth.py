"""Growth of revenue and profit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import compound3, growth
from quarterstone.operators.statements import Lookup, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, LATEST_ANNUAL, PERIOD

PERIODS = {"mrq": Lookup.latest, "q4": Lookup.annual}
LABELS = {"mrq": PERIOD, "q4": LATEST_ANNUAL}
# Heads of the yearly growth series; fixed values.
SERIES = {"total_revenue": "营收同比", "net_profit": "净利同比"}


def growth_report(source: StatementSource, kind: str) -> DataFrame:
    """One-year change and three-year compound growth of revenue and net profit."""
    def columns(lk: Lookup):
        at = PERIODS[kind]

        def pair(item: str, yearly: str, compound: str):
            now, one, three = (lk.value("is", item, at(lk, "is", k)) for k in (0, 1, 3))
            return [growth(now, one).alias(yearly), compound3(now, three).alias(compound)]

        return [F.col("code").alias(CODE), at(lk, "is").label.alias(LABELS[kind]),
                *pair("total_revenue", "营收同比", "营收复合"),
                *pair("net_profit", "利润同比", "利润复合")]
    return report(source, columns)


def yearly_growth(source: StatementSource, item: str, kind: str, years: int = 5) -> DataFrame:
    """One-year changes of an item for the latest period and the years before."""
    def columns(lk: Lookup):
        at = PERIODS[kind]
        values = [lk.value("is", item, at(lk, "is", k)) for k in range(years + 1)]
        head = f"{SERIES[item]}({kind})"
        return [F.col("code").alias(CODE), at(lk, "is").label.alias(LABELS[kind])] + [
            growth(values[k], values[k + 1]).alias(f"{head}{k or ''}") for k in range(years)
        ]
    return report(source, columns)


def public_yearly_growth(source: StatementSource, company: DataFrame, item: str, prefix: str,
                         years: int = 5) -> DataFrame:
    head = f"{SERIES[item]}(q4)"
    values = [F.col(f"{head}{k or ''}").alias(f"{prefix}_q4" + (f"_{k}" if k else ""))
              for k in range(years)]
    return with_company(yearly_growth(source, item, "q4", years), company, LATEST_ANNUAL, values, "code rp name idst area")
