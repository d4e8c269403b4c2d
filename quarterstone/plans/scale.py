"""Size of balance sheet, profit and cash flow, in 100 million yuan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import scaled
from quarterstone.operators.statements import Lookup, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, LATEST_ANNUAL, LATEST_QUARTER

PERIODS = {"mrq": Lookup.month_end, "q4": Lookup.annual}
LABELS = {"mrq": LATEST_QUARTER, "q4": LATEST_ANNUAL}

# Report head -> (public name, statement, items added, items subtracted); fixed values.
# Every item is rounded before it is added.
MEASURES = {
    "流动资产": ("ca", "bs", ["current_assets"], []),
    "非流动资产": ("nca", "bs", ["non_current_assets"], []),
    "营运资本": ("wca", "bs", ["current_assets"], ["current_liabilities"]),
    "商誉": ("gw", "bs", ["goodwill"], []),
    "总资产": ("tca", "bs", ["total_assets"], []),
    "PPE余额": ("ppe", "bs", ["fixed_assets", "intangible_assets", "deferred_expenses"], []),
    "有息债务": ("debts", "bs", ["short_term_loans", "long_term_loans", "loans_due_in_a_year",
                             "other_current_liabilities"], []),
    "总负债": ("tlbt", "bs", ["total_liabilities"], []),
    "归母净资产": ("nae", "bs", ["parent_equity"], []),
    "净资产": ("na", "bs", ["total_equity"], []),
    "营业总收入": ("rve", "is", ["total_revenue"], []),
    "归母净利润": ("npe", "is", ["parent_net_profit"], []),
    "净利润": ("np", "is", ["net_profit"], []),
    "经营": ("ocf", "cf", ["operating_cash"], []),
    "投资": ("icf", "cf", ["investing_cash"], []),
    "筹资": ("ficf", "cf", ["financing_cash"], []),
    "净现金流": ("ncf", "cf", ["net_cash_change"], []),
}


def _heads(kind: str) -> list[str]:
    heads = list(MEASURES)
    if kind == "q4":  # the annual report lists total assets before goodwill
        at = heads.index("商誉")
        heads[at:at + 2] = ["总资产", "商誉"]
    return heads


def scale_report(source: StatementSource, kind: str) -> DataFrame:
    """All values are read at the income statement's period; the label is the balance sheet's."""
    def columns(lk: Lookup):
        at = PERIODS[kind]
        period = at(lk, "is")

        def measure(head: str) -> Column:
            _, statement, plus, minus = MEASURES[head]

            def part(item: str) -> Column:
                return scaled(lk.value(statement, item, period), 10000, 2)

            total = part(plus[0])
            for item in plus[1:]:
                total = total + part(item)
            for item in minus:
                total = total - part(item)
            return total.alias(head)

        return [F.col("code").alias(CODE), at(lk, "bs").label.alias(LABELS[kind])] + [
            measure(head) for head in _heads(kind)]
    return report(source, columns)


def public_scale(source: StatementSource, company: DataFrame, kind: str) -> DataFrame:
    values = [F.col(head).alias(MEASURES[head][0]) for head in _heads(kind)]
    return with_company(scale_report(source, kind), company, LABELS[kind], values)
