"""The same results in DuckDB SQL, written from the definitions.

Values are looked up by outer joins on a computed period, not by maps; quotients are
rounded exactly with integers, because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re

from quarterstone.sources.testformulas import FISCAL_MONTHS, ITEMS, MEASURES

SQL: dict[str, str] = {}
NAME = {"is": "ist", "bs": "bst", "cf": "cft"}

# ---- statements ----------------------------------------------------------------------

_SUMS = ",\n".join(f"sum(CAST({e} AS DECIMAL(18,4))) AS {m}" for m, e in MEASURES.items())
CELLS = f"""cells AS (
SELECT l_suppkey AS code, make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1) AS month,
{_SUMS}
FROM lineitem GROUP BY 1, 2)"""


def _statement(s: str) -> str:
    items = ", ".join(f"CAST({e} AS DECIMAL(20,4)) AS {i}" for i, e in ITEMS[s].items())
    label = f"strftime(last_day(month + to_months(CAST({FISCAL_MONTHS[s]} AS INTEGER))), '%Y-%m-%d')"
    return (f"{NAME[s]} AS (SELECT code, {label} AS period, {items} FROM cells),\n"
            f"{NAME[s]}d AS (SELECT code, max(period) AS rp FROM {NAME[s]} GROUP BY code)")


BASE = ",\n".join([CELLS] + [_statement(s) for s in NAME])
COMPANY = """company AS (SELECT s_suppkey AS code, s_name AS name, r_name AS area, n_name AS industry,
s_acctbal AS outstanding, s_acctbal * 2 AS totals, CAST(s_nationkey AS DOUBLE) AS holders
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def q4(date: str, n: int) -> str:
    return (f"(CAST(CAST(substr({date}, 1, 4) AS INTEGER) + ({n}) - "
            f"(CASE WHEN substr({date}, 6) = '12-31' THEN 0 ELSE 1 END) AS VARCHAR) || '-12-31')")


def month_end(date: str, months: int) -> str:
    return f"strftime(last_day(CAST({date} AS DATE) + INTERVAL ({months}) MONTH), '%Y-%m-%d')"


def _units(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(28,8)) * CAST(100000000 AS DECIMAL(9,0)) AS HUGEINT)"


def div(a: str, b: str, digits: int) -> str:
    """Zero-safe quotient, rounded half away from zero, exactly."""
    ua, ub = _units(a), _units(b)
    places = 10 ** digits
    exact = (f"CAST(sign({a}) * sign({b}) AS HUGEINT) * "
             f"((abs({ua}) * {2 * places} + abs({ub})) // (abs({ub}) * 2))")
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} = 0 THEN 0 "
            f"ELSE CAST({exact} AS DECIMAL(24,0)) * CAST({1 / places:.{digits}f} AS DECIMAL({digits + 1},{digits})) END)")


def growth(a: str, b: str) -> str:
    return f"({div(a, b, 4)} - 1)"


def compound(a: str, b: str) -> str:
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} = 0 THEN -1 ELSE "
            f"CAST(round(cbrt(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)), 4) AS DECIMAL(20,4)) - 1 END)")


def hundred_millions(x: str) -> str:
    """From 10,000 yuan to 100 million, two decimals."""
    return f"round(CAST({x} AS DECIMAL(24,4)) * CAST(0.0001 AS DECIMAL(5,4)), 2)"


class Report:
    """A SELECT over joined statements, with one outer join per statement and period."""

    def __init__(self, *statements: str):
        self.statements = statements
        self.joins: dict[tuple[str, str], str] = {}
        self.columns: list[str] = []

    def rp(self, s: str) -> str:
        return f"{NAME[s]}d.rp"

    def y(self, s: str, k: int = 0) -> str:
        return q4(self.rp(s), -k)

    def m(self, s: str, k: int = 0) -> str:
        return month_end(self.rp(s), -12 * k)

    def latest(self, s: str, k: int = 0) -> str:
        return self.m(s, k) if k else self.rp(s)

    def v(self, s: str, item: str, period: str) -> str:
        alias = self.joins.setdefault((s, period), f"p{len(self.joins)}")
        return f"{alias}.{item}"

    def text(self, name: str, expression: str) -> None:
        self.columns.append(f'{expression} AS "{name}"')

    def number(self, name: str, expression: str) -> None:
        self.columns.append(f'CAST({expression} AS DOUBLE) AS "{name}"')

    def select(self) -> str:
        first, *rest = (NAME[s] + "d" for s in self.statements)
        tables = first + "".join(f" JOIN {r} ON {r}.code = {first}.code" for r in rest)
        looked = "".join(
            f"\nLEFT JOIN {NAME[s]} AS {alias} ON {alias}.code = {first}.code AND {alias}.period = {period}"
            for (s, period), alias in self.joins.items())
        columns = ",\n".join([f'{first}.code AS "股票代码"'] + self.columns)
        return f"SELECT {columns}\nFROM {tables}{looked}"


PLANS: dict[str, str] = {}  # internal relations as SELECTs over BASE


HEADS: dict[str, dict[str, bool]] = {}  # columns of the internal relations, and whether they hold text


def _internal(key: str, r: Report) -> None:
    PLANS[key] = r.select()
    HEADS[key] = {"股票代码": False} | {re.search('AS "(.*)"$', c).group(1): not c.startswith("CAST(") or " AS DOUBLE) AS " not in c
                                    for c in r.columns}
    SQL[key] = f"WITH {BASE}\n{PLANS[key]}"


INCOME_HEADS = dict(zip(ITEMS["is"], (
    "营业总收入 营业收入 营业总成本 营业成本 管理费用 销售费用 财务费用 资产减值 营业税金 投资收益 公允价值变动 "
    "营业外收入 营业外支出 利润总额 所得税 净利润 少数股东损益 归母净利润 基本每股收益").split()))

r = Report("is", "cf")
np_ = [r.v("is", "net_profit", r.y("is", k)) for k in range(5)]
ocf = [r.v("cf", "operating_cash", r.y("cf", k)) for k in range(5)]
r.text("最新年报", r.y("is"))
r.number("三年净利润", f"{np_[0]} + {np_[1]} + {np_[2]}")
r.number("三年经营现金流", f"{ocf[0]} + {ocf[1]} + {ocf[2]}")
for k in range(5):
    r.number(f"现金流减利润{k or ''}", f"-1 * ({np_[k]} - {ocf[k]})")
_internal("base_cashflows_q4", r)

r = Report("cf", "is", "bs")
r.text("最新年报", r.y("is"))


def _cash(item: str, k: int) -> str:
    return r.v("cf", item, r.y("is", k))


def _profit(item: str, k: int = 0) -> str:
    return r.v("is", item, r.y("is", k))


_div = [f"({_cash('dividends_and_interest_paid', k)} - {_cash('dividends_paid_to_minority', k)}"
        f" - {_profit('finance_expense', k)} + {_cash('fx_effect', k)})" for k in range(3)]
_raised = [f"({_cash('capital_received', k)} - {_cash('capital_from_minority', k)})" for k in range(3)]
for head, value in {
    "净利润": _profit("net_profit"), "管理费用": _profit("admin_expense"),
    "少数股东损益": _profit("minority_profit"),
    "少数股东权益": r.v("bs", "minority_equity", r.y("bs")),
    "其他应收款": r.v("bs", "other_receivables", r.y("bs")),
    "其他应付款": r.v("bs", "other_payables", r.y("is")),
    "当前股利": _div[0], "三年累积股利": " + ".join(_div), "股权融资": " + ".join(_raised),
    "三年净利": " + ".join(_profit("net_profit", k) for k in range(3)),
    "股本变动倍数": div(r.v("bs", "paid_in_capital", r.y("is")), r.v("bs", "paid_in_capital", r.y("is", 2)), 2),
}.items():
    r.number(head, value)
_internal("base_cog_q4a", r)

for kind, at in {"mrq": Report.latest, "q4": Report.y}.items():
    label = {"mrq": "报告期", "q4": "最新年报"}[kind]

    r = Report("is")
    r.text("报告期", at(r, "is"))
    for item, head in INCOME_HEADS.items():
        if item != "eps":
            r.number(head, div(r.v("is", item, at(r, "is")), r.v("is", "total_revenue", at(r, "is")), 4))
    _internal(f"base_cost_{'mrq' if kind == 'mrq' else 'q4a'}", r)

    r = Report("is")
    r.text("报告期", at(r, "is"))
    for item, head in INCOME_HEADS.items():
        r.number(head, r.v("is", item, at(r, "is")))
    _internal(f"base_income_{'mrqa' if kind == 'mrq' else 'q4a'}", r)

    r = Report("is")
    r.text(label, at(r, "is"))
    for item, yearly, three in (("total_revenue", "营收同比", "营收复合"), ("net_profit", "利润同比", "利润复合")):
        now, one, base = (r.v("is", item, at(r, "is", k)) for k in (0, 1, 3))
        r.number(yearly, growth(now, one))
        r.number(three, compound(now, base))
    _internal(f"base_growth_{kind}", r)

    for prefix, item, head in (("pg", "net_profit", "净利同比"), ("rg", "total_revenue", "营收同比")):
        r = Report("is")
        r.text(label, at(r, "is"))
        for k in range(5):
            r.number(f"{head}({kind}){k or ''}", growth(
                r.v("is", item, at(r, "is", k)), r.v("is", item, at(r, "is", k + 1))))
        _internal(f"base_{prefix}_yoy_{kind}", r)

for key, at, base, head, label in (
        ("base_roa_q4", Report.y, "total_assets", "资产收益率", "最新年报"),
        ("base_roe_q4", Report.y, "parent_equity", "净资产收益率", "最新年报"),
        ("base_roe_mrq", Report.m, "parent_equity", "净资产收益率", "报告期")):
    r = Report("bs", "is")
    r.text(label, at(r, "bs"))
    for k in range(5):
        r.number(f"{head}{k or ''}", div(
            r.v("is", "parent_net_profit", at(r, "is", k)), r.v("bs", base, at(r, "bs", k)), 4))
    _internal(key, r)

for key, at, label in (("base_scale_mrqa", Report.m, "最新季报"), ("base_scale_q4a", Report.y, "最新年报")):
    r = Report("is", "bs", "cf")
    r.text(label, at(r, "bs"))

    def _s(s: str, *items: str) -> str:
        return " + ".join(hundred_millions(r.v(s, i, at(r, "is"))) for i in items)

    for head, value in {
        "流动资产": _s("bs", "current_assets"), "非流动资产": _s("bs", "non_current_assets"),
        "营运资本": f"{_s('bs', 'current_assets')} - {_s('bs', 'current_liabilities')}",
        "商誉": _s("bs", "goodwill"), "总资产": _s("bs", "total_assets"),
        "PPE余额": _s("bs", "fixed_assets", "intangible_assets", "deferred_expenses"),
        "有息债务": _s("bs", "short_term_loans", "long_term_loans", "loans_due_in_a_year", "other_current_liabilities"),
        "总负债": _s("bs", "total_liabilities"), "归母净资产": _s("bs", "parent_equity"),
        "净资产": _s("bs", "total_equity"), "营业总收入": _s("is", "total_revenue"),
        "归母净利润": _s("is", "parent_net_profit"), "净利润": _s("is", "net_profit"),
        "经营": _s("cf", "operating_cash"), "投资": _s("cf", "investing_cash"),
        "筹资": _s("cf", "financing_cash"), "净现金流": _s("cf", "net_cash_change"),
    }.items():
        r.number(head, value)
    _internal(key, r)


def _income_years(fixed: bool) -> str:
    branches = []
    for k in range(5):
        r = Report("is")
        r.text("报告期", r.y("is", k))
        for item, head in INCOME_HEADS.items():
            back = 0 if item == "investment_income" and k >= 2 and not fixed else k
            r.number(head, r.v("is", item, r.y("is", back)))
        branches.append(r.select())
    return "\nUNION\n".join(branches)


PLANS["base_income_q4"] = _income_years(False)
SQL["base_income_q4"] = f"WITH {BASE}\n{PLANS['base_income_q4']}"
SQL["base_income_q4_fixed"] = f"WITH {BASE}\n{_income_years(True)}"

# ---- public reports ------------------------------------------------------------------


# Order of the leading columns where it is not code, name, idst, area, rp; fixed values.
ORDER = {
    "cashflows_q4": "code name rp idst area", "cog_q4": "code name rp idst area",
    "cost_mrqa": "code name area idst rp", "cost_q4a": "code name area idst rp",
    "pg_yoy_q4": "code rp name idst area", "rg_yoy_q4": "code rp name idst area",
}


def _public(key: str, base: str, label: str, values: dict[str, str]) -> None:
    heads = {"code": "a.code", "name": "a.name", "idst": "a.industry AS idst", "area": "a.area", "rp": f'b."{label}" AS rp'}
    first = ", ".join(heads[h] for h in ORDER.get(key, "code name idst area rp").split())
    columns = ",\n".join(f"CAST({e} AS DOUBLE) AS {name}" for name, e in values.items())
    SQL[key] = (f"WITH {BASE},\n{COMPANY},\nb AS ({PLANS[base]})\n"
                f'SELECT {first}, {columns}\n'
                f'FROM b JOIN company a ON a.code = b."股票代码"')


def _dec(head: str, places: int = 4) -> str:
    return f'CAST("{head}" AS DECIMAL(20,{places}))'


_public("cashflows_q4", "base_cashflows_q4", "最新年报", {
    "ni3": hundred_millions(_dec("三年净利润")), "c3": hundred_millions(_dec("三年经营现金流")),
    **{f"nicf{k or ''}": hundred_millions(_dec(f"现金流减利润{k or ''}")) for k in range(5)}})
_np = _dec("净利润")
_public("cog_q4", "base_cog_q4a", "最新年报", {
    **{name: div(_dec(head), _np, 2) for name, head in (
        ("mgmt", "管理费用"), ("os2p", "少数股东损益"), ("o_rcpt", "其他应收款"),
        ("o_pymt", "其他应付款"), ("dp", "当前股利"))},
    "dp3": div(_dec("三年累积股利"), _dec("三年净利"), 2),
    "osr": div(_dec("少数股东损益"), _dec("少数股东权益"), 2),
    "fdp": hundred_millions(f"{_dec('股权融资')} - {_dec('三年累积股利')}"),
    "s_x": _dec("股本变动倍数", 2)})
for key, base in (("cost_mrqa", "base_cost_mrq"), ("cost_q4a", "base_cost_q4a")):
    d = _dec
    _public(key, base, "报告期", {
        "gpm": f"1 - {d('营业成本')}", "aer": d("管理费用"), "ser": d("销售费用"), "fer": d("财务费用"),
        "sga": f"{d('管理费用')} + {d('销售费用')} + {d('财务费用')}",
        "ccr": f"1 - {d('营业成本')} - {d('管理费用')} - {d('销售费用')}", "ail": d("资产减值"),
        "other": f"{d('营业外收入')} - {d('营业外支出')} + {d('投资收益')}",
        "npm": d("净利润"), "ncl": d("少数股东损益")})
_swapped = {"is06": "财务费用", "is07": "销售费用"}
for key, base in (("income_mrqa", "base_income_mrqa"), ("income_q4a", "base_income_q4a")):
    _public(key, base, "报告期", {
        f"is{n:02d}": f'"{_swapped.get(f"is{n:02d}", head)}"'
        for n, head in enumerate(INCOME_HEADS.values(), 1)})
for prefix, head in (("pg", "净利同比"), ("rg", "营收同比")):
    _public(f"{prefix}_yoy_q4", f"base_{prefix}_yoy_q4", "最新年报", {
        f"{prefix}_q4" + (f"_{k}" if k else ""): f'"{head}(q4){k or ""}"' for k in range(5)})
for kind, label in (("mrq", "报告期"), ("q4", "最新年报")):
    _public(f"roe_{kind}", f"base_roe_{kind}", label, {
        f"roe{k or ''}": f'"净资产收益率{k or ""}"' for k in range(5)})
for key, base, label in (("s_mrqa", "base_scale_mrqa", "最新季报"), ("s_q4a", "base_scale_q4a", "最新年报")):
    _public(key, base, label, {name: f'"{head}"' for name, head in zip(
        "ca nca wca gw tca ppe debts tlbt nae na rve npe np ocf icf ficf ncf".split(),
        "流动资产 非流动资产 营运资本 商誉 总资产 PPE余额 有息债务 总负债 归母净资产 净资产 营业总收入 归母净利润 净利润 "
        "经营 投资 筹资 净现金流".split())})

_STATS = """SELECT bstd.code, bstd.rp AS bsrp, istd.rp AS isrp, cftd.rp AS cfrp
FROM bstd JOIN istd ON bstd.code = istd.code JOIN cftd ON bstd.code = cftd.code"""
SQL["data_stats"] = f"WITH {BASE}\n{_STATS}"
SQL["f_data_error"] = f"WITH {BASE}\nSELECT * FROM ({_STATS}) WHERE bsrp <> cfrp OR bsrp <> isrp OR isrp <> cfrp"
SQL["f_data_stat"] = f"""WITH {BASE}
SELECT a.rp, a.bsrp, b.isrp, c.cfrp
FROM (SELECT rp, count(*) AS bsrp FROM bstd GROUP BY rp) a
JOIN (SELECT rp, count(*) AS isrp FROM istd GROUP BY rp) b ON a.rp = b.rp
JOIN (SELECT rp, count(*) AS cfrp FROM cftd GROUP BY rp) c ON b.rp = c.rp"""

# ---- quotes --------------------------------------------------------------------------

QUOTES = """quotes AS (
SELECT user_id AS code, CAST(ts AS DATE) AS inserted, 'u' || user_id AS name, max(value) AS price,
CAST(sum(CASE WHEN event_type = 'error' THEN -CAST(value AS DECIMAL(18,4)) ELSE CAST(value AS DECIMAL(18,4)) END) AS DOUBLE) AS pe_ttm,
CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS mktcap, min(value) AS pb,
CAST(max(CAST(value AS DECIMAL(18,4))) - min(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS pctchg,
CAST(count(*) AS DOUBLE) AS turnover
FROM events GROUP BY user_id, CAST(ts AS DATE))"""
_QUOTE = "code, name, price, pe_ttm, mktcap, pb, pctchg, turnover, CAST(inserted AS VARCHAR) AS inserted"
SQL["latest_snapshot"] = f"WITH {QUOTES}\nSELECT {_QUOTE} FROM quotes WHERE inserted = (SELECT max(inserted) FROM quotes)"
SQL["trading_day_gate"] = f"WITH {QUOTES}\nSELECT {_QUOTE} FROM quotes WHERE isodow(inserted) <= 5"


def _valuation(kind: str, label: str) -> str:
    pe, pb = "CAST(q.pe_ttm AS DECIMAL(20,6))", "CAST(q.pb AS DECIMAL(20,6))"
    pg = 'CAST(g."利润同比" AS DECIMAL(20,4))'
    share = f"({pe} * CAST(0.01 AS DECIMAL(3,2)))"
    return f"""SELECT q.code, q.name, g."{label}" AS rp, c.industry AS idst, c.area, q.price AS close, q.pe_ttm, q.pb,
CAST({div(pb, pe, 4)} AS DOUBLE) AS roe_ttm, q.mktcap, q.pctchg, q.turnover,
g."营收同比" AS rg, g."利润同比" AS pg, g."营收复合" AS crg, g."利润复合" AS cpg,
CAST({div(share, pg, 2)} AS DOUBLE) AS peg
FROM quotes q JOIN company c ON q.code = c.code JOIN ({PLANS[f'base_growth_{kind}']}) g ON q.code = g."股票代码"
WHERE q.inserted = (SELECT max(inserted) FROM quotes)"""


_VA = f"WITH {BASE},\n{COMPANY},\n{QUOTES}\n"
SQL["va_mrqa"] = _VA + _valuation("mrq", "报告期")
SQL["va_q4a"] = _VA + _valuation("q4", "最新年报")


def _pct(column: str, p: float, name: str, positive: bool = False) -> str:
    only = f" FILTER (WHERE {column} > 0)" if positive else ""
    return f"round(quantile_cont({column}, {p}){only}, 8) AS {name}"


SQL["industry_stats"] = f"""{_VA}, t AS ({_valuation('mrq', '报告期')})
SELECT idst AS idst_name, count(*) AS count,
{_pct('pe_ttm', 0.5, 'pe50', True)}, {_pct('pe_ttm', 0.25, 'pe25', True)},
{_pct('pb', 0.5, 'pb50', True)}, {_pct('pb', 0.25, 'pb25', True)},
{', '.join(_pct(c, 0.5, n) for c, n in (('roe_ttm', 'roe50'), ('rg', 'rg50'), ('pg', 'pg50'), ('crg', 'crg50'), ('cpg', 'cpg50'), ('pctchg', 'c50'), ('turnover', 'to50')))}
FROM t GROUP BY idst ORDER BY pe50 NULLS LAST""".replace("\n, t AS", ",\nt AS")

SQL["snapshot_append"] = f"""WITH {QUOTES}
SELECT code, price, CAST(inserted AS VARCHAR) AS quoted,
CASE WHEN inserted < DATE '2024-01-16' THEN '2024-01-15 21:10:00' ELSE '2024-01-30 21:10:00' END AS inserted,
CASE WHEN inserted < DATE '2024-01-16' THEN '2024-01-15' ELSE '2024-01-30' END AS snapshot_day
FROM quotes"""
SQL["latest_snapshot_stored"] = SQL["snapshot_append"] + " WHERE inserted >= DATE '2024-01-16'"
SQL["snapshot_append_stream"] = """SELECT event_id, user_id AS code, value AS price,
CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_day FROM events"""
SQL["parse_quote_records"] = """SELECT user_id AS code, 'u' || user_id AS name, value AS price, value AS pe_ttm,
CASE WHEN event_type = 'error' THEN NULL ELSE value END AS mktcap, value AS pb, -value AS pctchg,
CAST(event_id AS DOUBLE) AS turnover FROM events"""

# ---- board, consensus, surveys -------------------------------------------------------

MEMBERS = """members AS (
SELECT o_custkey AS code, CASE o_orderstatus WHEN 'O' THEN 'dsh' WHEN 'F' THEN 'jsh' ELSE 'ggc' END AS list,
CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS list_rank,
o_orderkey AS position, o_orderpriority AS name, o_orderstatus AS duty,
CAST(o_totalprice AS DECIMAL(18,2)) AS shares, CAST(o_totalprice AS DECIMAL(18,2)) AS salary,
strftime(o_orderdate, '%Y-%m-%d') AS term FROM orders),
seated AS (SELECT * FROM members QUALIFY row_number() OVER (PARTITION BY code, name ORDER BY list_rank, position) = 1)"""
_SEAT = ('code AS "股票代码", name AS "姓名", duty AS "职务", CAST(shares AS DOUBLE) AS "持股数", '
         'CAST(salary AS DOUBLE) AS "报酬", term AS "起止时间"')
SQL["board_all"] = f"WITH {MEMBERS}\nSELECT {_SEAT} FROM seated"
SQL["dedup_keep_first"] = f"""WITH {MEMBERS}
SELECT {_SEAT}, list, position FROM members
QUALIFY row_number() OVER (PARTITION BY code, list, name ORDER BY position) = 1"""
_SUMMARY = "SELECT code, sum(shares) AS shares, sum(salary) AS salaries FROM seated GROUP BY code"
SQL["board_summary"] = f"""WITH {MEMBERS}
SELECT code, CAST(shares AS DOUBLE) AS shares, CAST(salaries AS DOUBLE) AS salaries FROM ({_SUMMARY})"""
_TENTH = "CAST(0.00000001 AS DECIMAL(9,8))"
SQL["board"] = f"""WITH {COMPANY},\n{MEMBERS}, summary AS ({_SUMMARY})
SELECT a.code, a.name, a.area, a.industry AS idst, a.totals AS total_shares, a.outstanding AS out_shares,
CAST(round(CAST(b.shares AS DECIMAL(22,2)) * {_TENTH}, 4) AS DOUBLE) AS mgmt_shares,
CAST(round(CAST(b.salaries AS DECIMAL(22,2)) * {_TENTH}, 4) AS DOUBLE) AS salaries
FROM company a LEFT JOIN summary b ON a.code = b.code"""


def _cons(row: int, names: list[str]) -> str:
    cells = []
    for i, name in enumerate(names):
        value = f"CAST(CAST(s_acctbal AS DECIMAL(18,2)) + {10 * i + row} AS DOUBLE)"
        if i == 3:
            value = f"CASE WHEN s_acctbal < 7500 THEN {value} END"
        cells.append(f"{value} AS {name}")
    return f"SELECT s_suppkey AS code, {', '.join(cells)} FROM supplier"


_INST = "SELECT s_suppkey AS code, " + ", ".join(
    f"CAST(CAST(s_acctbal AS DECIMAL(18,2)) + {10 * i + row} AS DOUBLE) AS {name}{row + 1}"
    for i, name in enumerate(("inst", "ef")) for row in (1, 2)) + " FROM supplier"
SQL["cons_data"] = _cons(3, ["pg", "e_pg0", "e_pg1", "e_pg2"])
SQL["cons_data_pe"] = _cons(5, ["pe", "e_pe0", "e_pe1", "e_pe2"])
SQL["inst_data"] = _INST
for key, source in (("inst", "cons_data"), ("inst2", "cons_data_pe")):
    SQL[key] = f"""WITH {COMPANY}
SELECT a.code, a.name, a.industry AS idst, a.area, b.* EXCLUDE (code), c.* EXCLUDE (code)
FROM company a JOIN ({SQL[source]}) b ON a.code = b.code JOIN ({_INST}) c ON b.code = c.code"""

# ---- ingest --------------------------------------------------------------------------

from quarterstone.plans.items import STATEMENTS  # noqa: E402  (labels of the source reports)


def _long(*statements: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{s}' AS statement, code, '{label}' AS item, period, CAST({item} AS DOUBLE) AS value FROM {NAME[s]}"
        for s in statements for item, label in STATEMENTS[s].items())


SQL["src_statement_files"] = f"WITH {BASE}\n{_long('is', 'bs', 'cf')}"
SQL["src_statement_folder"] = SQL["src_statement_files"]
_most = max(len(items) for items in ITEMS.values())
SQL["load_statements_job"] = f"WITH {BASE}\n" + "\nUNION ALL\n".join(
    f"SELECT '{s}' AS statement, d.code, d.rp, a.period, " + ", ".join(
        f"CAST({'a.' + [*STATEMENTS[s]][i] if i < len(STATEMENTS[s]) else 'NULL'} AS DOUBLE) AS v{i}" for i in range(_most))
    + f" FROM {NAME[s]}d d JOIN {NAME[s]} a ON a.code = d.code" for s in STATEMENTS)
SQL["replace_table"] = "SELECT c_custkey, c_name FROM customer"
SQL["stmt_document"] = f"""WITH {BASE}, long AS ({_long('is', 'bs', 'cf')}),
tops AS (SELECT statement, code, max(period) AS rp FROM long GROUP BY ALL)
SELECT l.statement, l.code, t.rp, l.item, CAST(count(*) AS INTEGER) AS n_periods,
max(l.value) FILTER (WHERE l.period = t.rp) AS latest_value
FROM long l JOIN tops t ON l.statement = t.statement AND l.code = t.code GROUP BY 1, 2, 3, 4"""
SQL["stmt_document_from_cells"] = SQL["stmt_document"]
SQL["stmt_latest_period"] = f"WITH {BASE}\n" + " UNION ALL ".join(
    f"SELECT '{s}' AS statement, code, rp FROM {NAME[s]}d" for s in NAME)
SQL["upsert_by_key"] = """WITH rows AS (SELECT o_custkey AS code, o_orderkey AS position, o_totalprice AS amount, o_orderdate FROM orders),
late AS (SELECT DISTINCT code FROM rows WHERE o_orderdate >= TIMESTAMP '2001-01-01')
SELECT code, position, amount, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM rows
WHERE o_orderdate >= TIMESTAMP '2001-01-01' OR code NOT IN (SELECT code FROM late)"""
SQL["dim_company"] = f"WITH {COMPANY}\nSELECT code, name, area, industry, outstanding, totals, holders FROM company"
SQL["full_refresh"] = SQL["dim_company"]
SQL["incremental_antijoin"] = """SELECT c_custkey AS code, c_name AS name, c_mktsegment AS class_name,
CASE WHEN c_acctbal < 0 THEN 'cached' ELSE 'listed' END AS origin FROM customer"""
SQL["csv_cache_gbk"] = """SELECT c_custkey AS code, c_name AS name, c_mktsegment[1:1] AS class_code,
'行业' || c_mktsegment AS class_name, CAST(c_nationkey AS VARCHAR) AS idst_code,
'门类' || c_nationkey AS idst_name,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS pe, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 1 AS VARCHAR) AS pe_ttm,
CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 2 AS VARCHAR) AS pb, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 3 AS VARCHAR) AS dpr FROM customer"""
SQL["pledge_ranked"] = """SELECT '2018.04.06' AS date, CAST(c_custkey AS VARCHAR) AS code, c_name AS name,
CAST(c_nationkey AS VARCHAR) AS stroke_nu, CASE WHEN c_acctbal < 0 THEN '--' ELSE CAST(c_acctbal AS VARCHAR) END AS am_u,
CAST(c_acctbal AS VARCHAR) AS am_l, c_acctbal || ' x' AS shares,
CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS ratio,
CAST(c_custkey AS DOUBLE) AS code_num, CAST(c_nationkey AS DOUBLE) AS stroke_nu_num,
CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS am_u_num, c_acctbal AS am_l_num,
CAST(NULL AS DOUBLE) AS shares_num, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS ratio_num
FROM customer ORDER BY ratio_num NULLS LAST"""
_day = "strftime(o_orderdate, '%Y-%m-%d')"
_unlock = f"""SELECT {{sn}} AS sn, CAST(o_custkey AS VARCHAR) AS code, o_orderstatus AS market, o_orderpriority AS name,
{_day} AS date, {", ".join(f"CAST(o_custkey AS VARCHAR) AS {c}" for c in ("count", "ratio", "close", "mktvalue", "shares", "c_shares"))} FROM orders"""
SQL["feed_unlocks"] = (_unlock.format(sn="CAST(o_orderkey AS VARCHAR)") + " UNION ALL "
                       + _unlock.format(sn="'0' || o_orderkey"))
_twice = "CROSS JOIN (VALUES (1), (2)) AS twice(n)"
SQL["feed_holder_changes"] = f"""SELECT true AS increase, {_day} AS day, o_orderkey AS feed_id,
CAST(o_custkey AS VARCHAR) AS code, o_orderpriority AS name,
CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, CAST(o_orderkey AS VARCHAR) AS shares, '1.50' AS exprice
FROM orders {_twice} WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1998-01-01'"""
_fields = ["method", "inshare", "divmethod", "amounts", "dps", "dpr", "eps", "rps", "rps2", "rdate", "pdate", "rpdate"]
SQL["feed_dividends"] = f"""SELECT CAST(o_custkey AS VARCHAR) AS code, o_orderpriority AS name,
{", ".join(f"'f{i}-' || o_orderkey AS {f}" for i, f in enumerate(_fields) if f not in ("inshare", "divmethod", "pdate"))}
FROM orders {_twice}"""
HEADS["base_income_q4"] = {"股票代码": False, "报告期": True} | dict.fromkeys(INCOME_HEADS.values(), False)


def _column_sums(name: str, key: str) -> str:
    rows = [f"""SELECT '{name}' AS report, '{head}' AS head, count(*) AS n_rows, count("{head}") AS n_values,
{'CAST(NULL AS DOUBLE)' if text else f'CAST(sum(CAST("{head}" AS DECIMAL(24,4))) AS DOUBLE)'} AS total,
{f'max("{head}")' if text else 'CAST(NULL AS VARCHAR)'} AS largest FROM {key}""" for head, text in HEADS[key].items()]
    return "\nUNION ALL\n".join(rows)


_stored = {
    "_cashflows_q4": "base_cashflows_q4",
    "_cog_q4a": "base_cog_q4a",
    "_cost_mrq": "base_cost_mrq",
    "_cost_q4a": "base_cost_q4a",
    "_growth_report_mrq": "base_growth_mrq",
    "_growth_report_q4": "base_growth_q4",
    "_income_mrqa": "base_income_mrqa",
    "_income_q4": "base_income_q4",
    "_income_q4a": "base_income_q4a",
    "_pg_yoy_mrq": "base_pg_yoy_mrq",
    "_pg_yoy_q4": "base_pg_yoy_q4",
    "_rg_yoy_mrq": "base_rg_yoy_mrq",
    "_rg_yoy_q4": "base_rg_yoy_q4",
    "_roa_q4": "base_roa_q4",
    "_roe_mrq": "base_roe_mrq",
    "_roe_q4": "base_roe_q4",
    "_s_mrqa": "base_scale_mrqa",
    "_s_q4a": "base_scale_q4a",
}
SQL["refresh_reports"] = (f"WITH {BASE},\n" + ",\n".join(f"{key} AS MATERIALIZED ({PLANS[key]})" for key in _stored.values())
                          + "\n" + "\nUNION ALL\n".join(_column_sums(name, key) for name, key in _stored.items()))

# ---- markup and text -----------------------------------------------------------------


def _extract(text: str, tag: str) -> str:
    return f"regexp_extract_all({text}, '(?is)<{tag}.*?>(.*?)</{tag}>', 1)"


def _cells(rows: str) -> str:
    """Rows and cells of ``rows`` (page_id, list of row texts) with 0-based numbers."""
    return f"""WITH found AS ({rows}),
by_row AS (SELECT page_id, CAST(generate_subscripts(r, 1) - 1 AS INTEGER) AS row_no, unnest(r) AS row_text FROM found),
by_cell AS (SELECT page_id, row_no, {_extract('row_text', 'a')} AS c FROM by_row)
SELECT page_id, row_no, CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS cell_no, unnest(c) AS cell FROM by_cell"""


_clean = "replace(replace(replace(replace(html, '&nbsp;', ''), '--', '0.00'), ',', ''), chr(10), '')"
SQL["markup_rows"] = _cells(f"SELECT page_id, {_extract(_clean, 'li')} AS r FROM pages")
_space = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_page = f"regexp_replace(regexp_replace(replace(html, ',', ''), '<!--.*?-->', '', 'g'), '{_space}', '', 'g')"
SQL["html_table_rows"] = _cells(f"SELECT page_id, {_extract(f'{_extract(_page, chr(117) + chr(108))}[1]', 'li')} AS r FROM pages")
SQL["board_pages"] = f"""WITH {MEMBERS}
SELECT code AS "股票代码", list, CAST(row_number() OVER (PARTITION BY code, list, position // 100000 ORDER BY position) - 1 AS INTEGER) AS position,
replace(name, ' ', '') AS "姓名", duty AS "职务",
CAST(CASE WHEN duty = 'O' THEN 0 ELSE shares END AS DOUBLE) AS "持股数",
CAST(CAST('1' || CAST(salary AS VARCHAR) AS DECIMAL(20,2)) AS DOUBLE) AS "报酬", replace(term, '-', '.') AS "起止时间"
FROM members"""
_bal = "CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR)"
SQL["sheet_document"] = " UNION ALL ".join(
    f"SELECT s_suppkey AS code, '{head}' AS head, '{row}' AS row_no, {value} AS value FROM supplier"
    for head, row, value in (
        ("指标", 0, "s_name"), ("指标", 1, "'b'"), ("2023", 0, _bal), ("2023", 1, f"'1' || {_bal}"),
        ("2024预测", 0, "'0.00'"), ("2024预测", 1, "CAST(s_nationkey AS VARCHAR)")))
_verdict = """CASE WHEN contains(text, '<!DOCTYPE html') THEN 'html' WHEN NOT contains(text, 'the') THEN 'no_keyword' ELSE 'ok' END AS verdict"""
SQL["reject_bad_payload"] = f"""SELECT kind, id, {_verdict} FROM (
SELECT 'page' AS kind, page_id AS id, html AS text FROM pages UNION ALL SELECT 'document', doc_id, text FROM documents)"""
_raw = "replace(replace(replace(text, '. ', ',' || chr(13) || chr(10)), ', ', ',' || chr(9)), 'an', '--') || ','"
_cleaned = f"""replace(replace(replace(replace({_raw}, '--', '0'), ' ', ''), ',' || chr(9), ''), ',' || chr(13) || chr(10), chr(13) || chr(10))"""
SQL["clean_report_text"] = f"""SELECT doc_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS n_chars FROM (
SELECT doc_id, CASE WHEN right(c, 1) = ',' THEN left(c, length(c) - 1) ELSE c END AS t FROM (SELECT doc_id, {_cleaned} AS c FROM documents))"""
SQL["clean_dash_zero"] = """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '0' ELSE c_mktsegment END AS c_mktsegment,
CASE WHEN c_acctbal < 0 THEN '0' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey, 'a--' || c_name AS c_name FROM customer"""
SQL["try_numeric"] = """SELECT p_partkey, p_brand, CAST(p_size AS VARCHAR) AS p_size,
TRY_CAST(p_brand AS DOUBLE) AS p_brand_num, CAST(p_size AS DOUBLE) AS p_size_num FROM part"""
SQL["complete_columns"] = "SELECT doc_id, lang, n_chars FROM documents"

# ---- functions -----------------------------------------------------------------------

_dated = f"(SELECT o_orderkey, {_day} AS d, o_totalprice, o_custkey FROM orders)"
SQL["fn_any_q4"] = f"SELECT o_orderkey, d, {', '.join(f'{q4(chr(100), -k)} AS y{k}' for k in range(6))}, {q4('d', 1)} AS next FROM {_dated}"
SQL["fn_eofm"] = (f"SELECT o_orderkey, d, {', '.join(f'{month_end(chr(100), -12 * k)} AS m{k}' for k in range(6))}, "
                  f"{month_end('d', 1)} AS next, {month_end('d', -1)} AS before FROM {_dated}")
SQL["fn_safe_div"] = f"""SELECT l_orderkey, l_linenumber, CAST({div('p', 'd', 4)} AS DOUBLE) AS by_discount,
CAST({div('p', 'q', 4)} AS DOUBLE) AS by_quantity, CAST({div('q', 'p', 4)} AS DOUBLE) AS of_price
FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(20,4)) AS p, CAST(l_discount AS DECIMAL(20,4)) AS d,
CASE WHEN l_tax > 0 THEN CAST(l_quantity AS DECIMAL(20,4)) END AS q FROM lineitem)"""


def _norm(x: str) -> str:
    return f"lpad(left({x}, 6), 6, '0')"


SQL["fn_norm_code"] = f"""SELECT c_custkey, {_norm('CAST(c_custkey AS VARCHAR)')} AS padded,
{_norm("('1234' || c_custkey)")} AS joined, {_norm('c_name')} AS cut FROM customer"""
_market = "CASE WHEN left({x}, 1) = '6' THEN '{a}' ELSE '{b}' END"
SQL["fn_exchange"] = f"""SELECT c_custkey, {_market.format(x='k', a='sh', b='sz')} || k AS short_symbol,
{_market.format(x='n', a='sh', b='sz')} || n AS quote_symbol, n || {_market.format(x='n', a='01', b='02')} AS sheet_symbol
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k, {_norm("(c_custkey || '00')")} AS n FROM customer)"""
SQL["fn_pub_date"] = f"""SELECT o_orderkey, d, strftime(CAST(d AS DATE) - CAST(isodow(CAST(d AS DATE)) + 2 AS INTEGER), '%Y-%m-%d') AS published FROM {_dated}"""
SQL["sql_functions"] = f"""SELECT o_orderkey, {q4('d', -1)} AS y1, {month_end('d', -24)} AS m2,
CAST({div('t', 'c', 4)} AS DOUBLE) AS share
FROM (SELECT o_orderkey, d, CAST(o_totalprice AS DECIMAL(20,4)) AS t, CAST(o_custkey AS DECIMAL(20,4)) AS c FROM {_dated})"""
SQL["sql_over_views"] = f"""SELECT r.idst, count(*) AS n, count(r.roe) AS n_roe,
CAST(sum(CAST(s.tca AS DECIMAL(20,2))) AS DOUBLE) AS tca, max(r.rp) AS last_rp
FROM ({SQL['roe_q4']}) r JOIN ({SQL['s_q4a']}) s ON r.code = s.code GROUP BY r.idst"""
SQL["json_lookup"] = f"WITH {BASE}\n" + "\nUNION ALL\n".join(f"""SELECT '{s}' AS statement, d.code, d.rp, CAST(a.{latest} AS DOUBLE) AS latest,
CAST(b.{year_ago} AS DOUBLE) AS year_ago, CAST(NULL AS DOUBLE) AS unknown_item, CAST(NULL AS DOUBLE) AS unknown_period
FROM {NAME[s]}d d LEFT JOIN {NAME[s]} a ON a.code = d.code AND a.period = d.rp
LEFT JOIN {NAME[s]} b ON b.code = d.code AND b.period = {month_end('d.rp', -12)}""" for s, latest, year_ago in (
    ("is", "net_profit", "total_revenue"), ("bs", "total_assets", "total_equity"), ("cf", "operating_cash", "investing_cash")))

# ---- predicates and joins ------------------------------------------------------------

SQL["stale_reports"] = """SELECT code, strftime(c_date, '%Y-%m-%d') AS c_date, CAST(DATE '2001-08-01' - c_date AS INTEGER) AS age
FROM (SELECT o_custkey AS code, CAST(max(o_orderdate) AS DATE) AS c_date FROM orders GROUP BY o_custkey)
WHERE DATE '2001-08-01' - c_date >= 90"""
_expected = f"""WITH {BASE},\n{COMPANY},
expected AS (SELECT code, s AS statement FROM (SELECT code FROM company UNION SELECT c_custkey FROM customer) CROSS JOIN (VALUES ('bs'), ('is'), ('cf')) AS k(s)),
present AS ({' UNION ALL '.join(f"SELECT DISTINCT code, '{s}' AS statement FROM {NAME[s]}" for s in NAME)})"""
SQL["missing_statements"] = f"{_expected}\nSELECT code, statement FROM expected EXCEPT SELECT code, statement FROM present"
SQL["load_progress"] = f"""{_expected}
SELECT count(p.code) AS loaded, count(*) AS total
FROM expected e LEFT JOIN present p ON e.code = p.code AND e.statement = p.statement"""
r = Report("is", "bs", "cf")
for s in NAME:
    r.text(f"{s}_rp", r.rp(s))
for s, item in (("is", "net_profit"), ("bs", "total_assets"), ("cf", "operating_cash")):
    r.number(item, r.v(s, item, r.rp(s)))
SQL["join_three_statements"] = f"WITH {BASE}\n" + r.select().replace('"股票代码"', "code")
