"""All relations by name, their refresh into stored tables, and their SQL views."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from quarterstone.functions import register_functions
from quarterstone.operators.snapshots import latest_snapshot
from quarterstone.operators.statements import DocumentSource, StatementSource
from quarterstone.plans import board, cash, consensus, governance, growth, income, quality, returns, scale, valuation
from quarterstone.plans.items import LATEST_ANNUAL, PERIOD
from quarterstone.sources.statement_files import store_documents

T = TypeVar("T")

# Stored reports: relation name -> plan over a statement source. Names are fixed values.
STORED: dict[str, Callable[[StatementSource], DataFrame]] = {
    "_cashflows_q4": cash.cash_quality,
    "_cog_q4a": governance.governance_items,
    "_cost_mrq": lambda s: income.cost_shares(s, "mrq"),
    "_cost_q4a": lambda s: income.cost_shares(s, "q4"),
    "_growth_report_mrq": lambda s: growth.growth_report(s, "mrq"),
    "_growth_report_q4": lambda s: growth.growth_report(s, "q4"),
    "_income_mrqa": lambda s: income.income_items(s, "mrq"),
    "_income_q4": income.income_years,
    "_income_q4a": lambda s: income.income_items(s, "q4"),
    "_pg_yoy_mrq": lambda s: growth.yearly_growth(s, "net_profit", "mrq"),
    "_pg_yoy_q4": lambda s: growth.yearly_growth(s, "net_profit", "q4"),
    "_rg_yoy_mrq": lambda s: growth.yearly_growth(s, "total_revenue", "mrq"),
    "_rg_yoy_q4": lambda s: growth.yearly_growth(s, "total_revenue", "q4"),
    "_roa_q4": returns.return_on_assets,
    "_roe_mrq": lambda s: returns.return_on_equity(s, "mrq"),
    "_roe_q4": lambda s: returns.return_on_equity(s, "q4"),
    "_s_mrqa": lambda s: scale.scale_report(s, "mrq"),
    "_s_q4a": lambda s: scale.scale_report(s, "q4"),
}


class Inputs(Protocol):
    """The inputs of all relations; a relation touches only those it needs."""

    statements: StatementSource
    company: DataFrame
    quotes: DataFrame
    quote_stamps: DataFrame | None  # a cheaper table with the quotes' largest ``inserted``
    board_rows: DataFrame  # the columns of ``board.COLUMNS``
    consensus: DataFrame
    surveys: DataFrame
    latest_periods: DataFrame  # statement, rp: one row per document
    as_of: dt.date | None  # date of the consensus look-up; today where None


Relation = Callable[[Inputs], DataFrame]


def _priced(kind: str, label: str) -> Relation:
    def plan(i: Inputs) -> DataFrame:
        latest = latest_snapshot(i.quotes, i.quote_stamps)
        return valuation.valuation(latest, i.company, growth.growth_report(i.statements, kind), label)
    return plan


def _outlook(figures) -> Relation:
    return lambda i: consensus.company_outlook(
        i.company, figures(i.consensus, i.as_of), consensus.surveys(i.surveys))


def _public(plan, *arguments) -> Relation:
    return lambda i: plan(i.statements, i.company, *arguments)


def _stored(plan) -> Relation:
    return lambda i: plan(i.statements)


# Views, computed when they are read. Names are fixed values.
VIEWS: dict[str, Relation] = {
    "_data_stats": _stored(quality.data_stats),
    "_bod_summ": lambda i: board.board_summary(i.board_rows),
    "bod": lambda i: board.board(i.company, i.board_rows),
    "cashflows_q4": _public(cash.public_cash_quality),
    "cog_q4": _public(governance.public_governance),
    "cons_data": lambda i: consensus.consensus_growth(i.consensus, i.as_of),
    "cons_data_pe": lambda i: consensus.consensus_pe(i.consensus, i.as_of),
    "cost_mrqa": _public(income.public_cost, "mrq"),
    "cost_q4a": _public(income.public_cost, "q4"),
    "f_data_error": _stored(quality.period_errors),
    "f_data_stat": lambda i: quality.period_counts(i.latest_periods),
    "income_mrqa": _public(income.public_income, "mrq"),
    "income_q4a": _public(income.public_income, "q4"),
    "inst_data": lambda i: consensus.surveys(i.surveys),
    "inst": _outlook(consensus.consensus_growth),
    "inst2": _outlook(consensus.consensus_pe),
    "pg_yoy_q4": _public(growth.public_yearly_growth, "net_profit", "pg"),
    "rg_yoy_q4": _public(growth.public_yearly_growth, "total_revenue", "rg"),
    "roe_mrq": _public(returns.public_roe, "mrq"),
    "roe_q4": _public(returns.public_roe, "q4"),
    "s_mrqa": _public(scale.public_scale, "mrq"),
    "s_q4a": _public(scale.public_scale, "q4"),
    "va_mrqa": _priced("mrq", PERIOD),
    "va_q4a": _priced("q4", LATEST_ANNUAL),
    "tdx_va_mrq": lambda i: valuation.industry_stats(_priced("mrq", PERIOD)(i)),
}

RELATIONS: dict[str, Relation] = {name: _stored(plan) for name, plan in STORED.items()} | VIEWS

# Relations that write intermediate rows when they are built, as plans that wait until a view is read.
LAZY: dict[str, Relation] = {"tdx_va_mrq": lambda i: valuation.industry_stats(_priced("mrq", PERIOD)(i), lazy=True)}


def register_views(spark: SparkSession, inputs: Inputs, names: list[str] | None = None) -> None:
    """Temporary views under the relation names (all by default), and the SQL functions."""
    register_functions(spark)
    for name in RELATIONS if names is None else names:
        LAZY.get(name, RELATIONS[name])(inputs).createOrReplaceTempView(name)


def store_statements(spark: SparkSession, documents: dict[str, DataFrame], path: str,
                     buckets: int) -> DocumentSource:
    """Write the statement documents once, bucketed by code.

    All reports then read stored rows, only the items they use, and join them without an
    exchange.
    """
    prefix = "statements_" + hashlib.md5(path.encode()).hexdigest()
    stored = {}
    for statement, rows in documents.items():
        table = f"{prefix}_{statement}"
        store_documents(rows, table, buckets, f"{path}/{statement}")
        stored[statement] = spark.table(table)
    return DocumentSource(stored)


def refresh_reports(spark: SparkSession, source: StatementSource, write: Callable[[str, DataFrame], DataFrame],
                    at_once: int = 8) -> dict[str, DataFrame]:
    """Compute all stored reports; several jobs run side by side.

    Reports read statements only, so their order does not matter. ``write`` stores a report
    under its name and returns the stored table.
    """
    def store(name: str) -> DataFrame:
        return write(name, STORED[name](source))

    return dict(zip(STORED, side_by_side(spark, store, list(STORED), at_once)))


def side_by_side(spark: SparkSession, work: Callable[[str], T], names: list[str], at_once: int = 8) -> list[T]:
    """The results of ``work`` for each name; several jobs run at once."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))
