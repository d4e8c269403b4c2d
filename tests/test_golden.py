"""Reports on hand-made documents against plain-Python evaluation of the definitions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarterstone.operators.statements import DocumentSource
from quarterstone.plans import cash, governance, growth, income, quality, returns, scale
from quarterstone.plans.items import INCOME_HEADS
from quarterstone.sources.statement_files import lookup_form, parse_documents
from tests import golden
from tests.golden import Doc, add, compound, divide, month_end, rounded, year_end


@pytest.fixture(scope="module")
def docs():
    return {s: [Doc(s, row) for row in rows] for s, rows in golden.documents().items()}


@pytest.fixture(scope="module")
def source(spark):
    frames = {}
    for s, rows in golden.documents().items():
        stored = spark.createDataFrame(rows, "code bigint, rp string, data string")
        frames[s] = lookup_form(parse_documents(stored), s)
    return DocumentSource(frames)


@pytest.fixture(scope="module")
def company(spark):
    rows = [(c, f"n{c}", "area", f"i{c % 2}", 1.0, 2.0, 3.0) for c in (1, 2, 3, 4, 5, 6, 8, 9)]
    return spark.createDataFrame(
        rows, "code bigint, name string, area string, industry string, outstanding double, totals double, holders double")


def same(frame, expected):
    """Equal bags of rows; numbers to ten digits."""
    def key(row):
        return tuple((v is None, str(v) if isinstance(v, str) else f"{float(v):.6f}" if v is not None else "") for v in row)
    got = sorted((tuple(r) for r in frame.collect()), key=key)
    want = sorted((tuple(r) for r in expected), key=key)
    assert [key(r) for r in got] == [key(r) for r in want]


def pairs(docs, *statements):
    """Inner join on the code, with every combination of documents."""
    rows = [()]
    for s in statements:
        rows = [r + (d,) for r in rows for d in docs[s] if not r or r[0].code == d.code]
    return rows


@pytest.mark.parametrize("kind", ["mrq", "q4"])
def test_growth(source, docs, kind):
    def at(d, k):
        if kind == "q4":
            return year_end(d.rp, -k)
        return month_end(d.rp, -12 * k) if k else d.rp
    expected = []
    for d in docs["is"]:
        row = [d.code, at(d, 0)]
        for item in ("total_revenue", "net_profit"):
            now, one, three = (d.get(item, at(d, k)) for k in (0, 1, 3))
            row += [golden.growth(now, one), compound(now, three)]
        expected.append(row)
    same(growth.growth_report(source, kind), expected)
    yearly = [[d.code, at(d, 0)] + [
        golden.growth(d.get("net_profit", at(d, k)), d.get("net_profit", at(d, k + 1))) for k in range(5)]
        for d in docs["is"]]
    same(growth.yearly_growth(source, "net_profit", kind), yearly)


def test_growth_of_zero_and_negative_base(source):
    row = growth.growth_report(source, "q4").where("`股票代码` = 4").first()
    assert row["利润同比"] == -1 and row["营收同比"] == -1  # zero base
    assert row["利润复合"] == -3  # cube root of 64 / -8, less one


@pytest.mark.parametrize("kind,period", [("mrq", lambda d, k: month_end(d.rp, -12 * k)),
                                         ("q4", lambda d, k: year_end(d.rp, -k))])
def test_returns_use_each_statements_own_period(source, docs, kind, period):
    expected = [[b.code, period(b, 0)] + [
        rounded(divide(i.get("parent_net_profit", period(i, k)), b.get("parent_equity", period(b, k))), 4)
        for k in range(5)] for b, i in pairs(docs, "bs", "is")]
    same(returns.return_on_equity(source, kind), expected)


def test_two_documents_of_a_company_multiply(source):
    assert returns.return_on_equity(source, "q4").where("`股票代码` = 6").count() == 2


@pytest.mark.parametrize("fixed", [False, True])
def test_income_years_investment_slip(source, docs, fixed):
    expected = set()
    for d in docs["is"]:
        for k in range(5):
            row = [d.code, year_end(d.rp, -k)]
            for item in INCOME_HEADS:
                back = 0 if item == "investment_income" and k >= 2 and not fixed else k
                row.append(d.get(item, year_end(d.rp, -back)))
            expected.add(tuple(row))
    same(income.income_years(source, fix_investment=fixed), expected)


def test_cost_shares(source, docs):
    expected = [[d.code, d.rp] + [
        rounded(divide(d.get(i, d.rp), d.get("total_revenue", d.rp)), 4) for i in INCOME_HEADS if i != "eps"]
        for d in docs["is"]]
    same(income.cost_shares(source, "mrq"), expected)


def test_scale_rounds_before_adding(source, docs):
    def s(d, item, p):
        value = d.get(item, p)
        return None if value is None else rounded(value / 10000, 2)
    expected = []
    for i, b, c in pairs(docs, "is", "bs", "cf"):
        p = year_end(i.rp, 0)
        minus = s(b, "current_liabilities", p)
        expected.append([
            b.code, year_end(b.rp, 0), s(b, "current_assets", p), s(b, "non_current_assets", p),
            add(s(b, "current_assets", p), None if minus is None else -minus),
            s(b, "total_assets", p), s(b, "goodwill", p),
            add(*[s(b, x, p) for x in ("fixed_assets", "intangible_assets", "deferred_expenses")]),
            add(*[s(b, x, p) for x in ("short_term_loans", "long_term_loans", "loans_due_in_a_year",
                                       "other_current_liabilities")]),
            s(b, "total_liabilities", p), s(b, "parent_equity", p), s(b, "total_equity", p),
            s(i, "total_revenue", p), s(i, "parent_net_profit", p), s(i, "net_profit", p),
            s(c, "operating_cash", p), s(c, "investing_cash", p), s(c, "financing_cash", p),
            s(c, "net_cash_change", p)])
    same(scale.scale_report(source, "q4"), expected)


def test_cash_quality(source, docs):
    expected = []
    for i, c in pairs(docs, "is", "cf"):
        np_ = [i.get("net_profit", year_end(i.rp, -k)) for k in range(5)]
        oc = [c.get("operating_cash", year_end(c.rp, -k)) for k in range(5)]
        expected.append([i.code, year_end(i.rp, 0), add(*np_[:3]), add(*oc[:3])] + [
            None if a is None or b is None else b - a for a, b in zip(np_, oc)])
    same(cash.cash_quality(source), expected)


def test_governance_items(source, docs):
    expected = []
    for i, b, c in pairs(docs, "is", "bs", "cf"):
        y = [year_end(i.rp, -k) for k in range(3)]
        own = year_end(b.rp, 0)

        def less(a, b_):
            return None if a is None or b_ is None else a - b_
        div = [add(less(less(c.get("dividends_and_interest_paid", p), c.get("dividends_paid_to_minority", p)),
                        i.get("finance_expense", p)), c.get("fx_effect", p)) for p in y]
        raised = [less(c.get("capital_received", p), c.get("capital_from_minority", p)) for p in y]
        expected.append([
            i.code, y[0], i.get("net_profit", y[0]), i.get("admin_expense", y[0]), i.get("minority_profit", y[0]),
            b.get("minority_equity", own), b.get("other_receivables", own), b.get("other_payables", y[0]),
            div[0], add(*div), add(*raised), add(*[i.get("net_profit", p) for p in y]),
            rounded(divide(b.get("paid_in_capital", y[0]), b.get("paid_in_capital", y[2])), 2)])
    same(governance.governance_items(source), expected)


def test_period_errors(source, spark):
    found = {r["code"] for r in quality.period_errors(source).collect()}
    assert found == {3, 6, 7, 9}
    unknown = DocumentSource({
        s: spark.createDataFrame([(1, None if s == "bs" else "2017-12-31")], "code bigint, rp string")
        .withColumn("data", F.array(F.struct(F.lit("x").alias("period")))) for s in ("is", "bs", "cf")})
    assert quality.period_errors(unknown).count() == 0


def test_public_reports_keep_known_companies_only(source, company):
    codes = {r["code"] for r in returns.public_roe(source, company, "q4").collect()}
    assert codes == {1, 2, 3, 4, 5, 6, 9}


def test_values_are_decimals(source):
    row = income.income_items(source, "q4").where("`股票代码` = 1").first()
    assert isinstance(row["净利润"], Decimal)
