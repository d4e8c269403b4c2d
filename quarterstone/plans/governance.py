"""Governance: payouts, financing, receivables and minority interests against profit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import money, ratio, scaled
from quarterstone.operators.statements import Lookup, StatementSource, report
from quarterstone.plans.company import with_company
from quarterstone.plans.items import CODE, LATEST_ANNUAL


def _total(values: list[Column]) -> Column:
    return money(sum(values[1:], values[0]))


def governance_items(source: StatementSource) -> DataFrame:
    """Annual inputs of the governance ratios.

    Equity held by minorities and other receivables follow the balance sheet's own year;
    everything else follows the income statement's.
    """
    def columns(lk: Lookup):
        year = [lk.annual("is", k) for k in range(3)]
        balance_year = lk.annual("bs")

        def income(item: str, k: int = 0) -> Column:
            return lk.value("is", item, year[k])

        def cash(item: str, k: int) -> Column:
            return lk.value("cf", item, year[k])

        def dividend(k: int) -> Column:
            return (cash("dividends_and_interest_paid", k) - cash("dividends_paid_to_minority", k)
                    - income("finance_expense", k) + cash("fx_effect", k))

        def raised(k: int) -> Column:
            return cash("capital_received", k) - cash("capital_from_minority", k)

        capital = [lk.value("bs", "paid_in_capital", year[k]) for k in (0, 2)]
        heads = {
            "净利润": income("net_profit"),
            "管理费用": income("admin_expense"),
            "少数股东损益": income("minority_profit"),
            "少数股东权益": lk.value("bs", "minority_equity", balance_year),
            "其他应收款": lk.value("bs", "other_receivables", balance_year),
            "其他应付款": lk.value("bs", "other_payables", year[0]),
            "当前股利": money(dividend(0)),
            "三年累积股利": _total([dividend(k) for k in range(3)]),
            "股权融资": _total([raised(k) for k in range(3)]),
            "三年净利": _total([income("net_profit", k) for k in range(3)]),
            "股本变动倍数": ratio(*capital, digits=2),
        }
        return [F.col("code").alias(CODE), year[0].label.alias(LATEST_ANNUAL)] + [
            value.alias(head) for head, value in heads.items()]
    return report(source, columns)


def public_governance(source: StatementSource, company: DataFrame) -> DataFrame:
    c = F.col

    def to_profit(head: str) -> Column:
        return ratio(c(head), c("净利润"), 2)

    return with_company(governance_items(source), company, LATEST_ANNUAL, [
        to_profit("管理费用").alias("mgmt"),
        to_profit("少数股东损益").alias("os2p"),
        to_profit("其他应收款").alias("o_rcpt"),
        to_profit("其他应付款").alias("o_pymt"),
        to_profit("当前股利").alias("dp"),
        ratio(c("三年累积股利"), c("三年净利"), 2).alias("dp3"),
        ratio(c("少数股东损益"), c("少数股东权益"), 2).alias("osr"),
        scaled(c("股权融资") - c("三年累积股利"), 10000, 2).alias("fdp"),
        F.round(c("股本变动倍数"), 2).alias("s_x"),
    ], "code name rp idst area")
