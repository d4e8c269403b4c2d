"""Returns on assets and on equity over five periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import ratio
from quarterstone.operators.statements import Lookup, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, LATEST_ANNUAL, PERIOD

PERIODS = {"mrq": Lookup.month_end, "q4": Lookup.annual}
LABELS = {"mrq": PERIOD, "q4": LATEST_ANNUAL}
# Column heads; fixed values.
ROA, ROE = "资产收益率", "净资产收益率"


def _returns(source: StatementSource, base_item: str, head: str, kind: str, years: int) -> DataFrame:
    def columns(lk: Lookup):
        at = PERIODS[kind]
        return [F.col("code").alias(CODE), at(lk, "bs").label.alias(LABELS[kind])] + [
            # each side is read at its own statement's period
            ratio(lk.value("is", "parent_net_profit", at(lk, "is", k)),
                  lk.value("bs", base_item, at(lk, "bs", k))).alias(f"{head}{k or ''}")
            for k in range(years)
        ]
    return report(source, columns)


def return_on_assets(source: StatementSource, kind: str = "q4", years: int = 5) -> DataFrame:
    return _returns(source, "total_assets", ROA, kind, years)


def return_on_equity(source: StatementSource, kind: str, years: int = 5) -> DataFrame:
    return _returns(source, "parent_equity", ROE, kind, years)


def public_roe(source: StatementSource, company: DataFrame, kind: str, years: int = 5) -> DataFrame:
    values = [F.col(f"{ROE}{k or ''}").alias(f"roe{k or ''}") for k in range(years)]
    return with_company(return_on_equity(source, kind, years), company, LABELS[kind], values)
