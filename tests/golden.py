"""Hand-made documents that reach the hard paths, and plain-Python lookups on them.

Company 1: plain, latest period is a fiscal year end. 2: latest period is a quarter. 3: the
statements end at different periods. 4: a zero and a negative base. 5: a missing year and a
missing item. 6: two income documents. 7: no company row. 9: investment income differs by
year.
"""

import datetime as dt
import json
from decimal import ROUND_HALF_UP, Decimal

from quarterstone.plans.items import BALANCE, CASH_FLOW, INCOME

LABELS = {"is": INCOME, "bs": BALANCE, "cf": CASH_FLOW}
YEARS = range(2011, 2018)


def quarter_ends(last: str) -> list[str]:
    days = [f"{y}-{d}" for y in list(YEARS) + [2018] for d in ("03-31", "06-30", "09-30", "12-31")]
    return [d for d in days if d <= last]


def _document(statement: str, code: int, last: str, skip=(), without=(), values=None, seed=0):
    data = {}
    for n, (field, label) in enumerate(LABELS[statement].items()):
        if field in without:
            continue
        data[label] = {
            p: float(Decimal(((code * 37 + n * 101 + i * 53 + seed * 7) % 997) * 1013 - 200000) / 4)
            for i, p in enumerate(quarter_ends(last)) if p not in skip}
    for (field, period), value in (values or {}).items():
        data[LABELS[statement][field]][period] = value
    periods = {p for item in data.values() for p in item}
    return (code, max(periods), json.dumps(data, ensure_ascii=False))


def documents() -> dict[str, list[tuple]]:
    year_end, quarter = "2017-12-31", "2018-03-31"
    base = {
        ("net_profit", "2016-12-31"): 0.0, ("net_profit", "2014-12-31"): -8.0,
        ("net_profit", "2017-12-31"): 64.0, ("total_revenue", "2016-12-31"): 0.0}
    income = [
        _document("is", 1, year_end), _document("is", 2, quarter), _document("is", 3, quarter),
        _document("is", 4, year_end, values=base),
        _document("is", 5, year_end, skip=("2015-12-31",), without=("finance_expense",)),
        _document("is", 6, year_end), _document("is", 6, quarter, seed=5),
        _document("is", 7, year_end), _document("is", 9, year_end)]
    balance = [
        _document("bs", c, "2017-09-30" if c == 3 else year_end if c in (1, 4, 5) else quarter)
        for c in (1, 2, 3, 4, 5, 6, 7, 9)]
    cash = [_document("cf", c, "2017-06-30" if c == 3 else year_end if c in (1, 4, 5, 6) else quarter)
            for c in (1, 2, 3, 4, 5, 6, 7, 9)]
    return {"is": income, "bs": balance, "cf": cash}


class Doc:
    """A document with text lookups, as the definitions describe them."""

    def __init__(self, statement, row):
        self.code, self.rp, text = row
        self.labels, self.data = LABELS[statement], json.loads(text, parse_float=Decimal)

    def get(self, field, period):
        value = self.data.get(self.labels[field], {}).get(period)
        return None if value is None else Decimal(value)


def year_end(label: str, n: int) -> str:
    y, m, d = map(int, label.split("-"))
    return f"{y + n if (m, d) == (12, 31) else y + n - 1}-12-31"


def month_end(label: str, k: int) -> str:
    y, m, _ = map(int, label.split("-"))
    months = y * 12 + (m - 1) + k + 1
    first_of_next = dt.date(months // 12, months % 12 + 1, 1)
    return (first_of_next - dt.timedelta(days=1)).isoformat()


def rounded(value, digits):
    if value is None:
        return None
    return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def divide(a, b):
    if a is None or b is None:
        return None
    return Decimal(0) if b == 0 else a / b


def growth(a, b):
    q = divide(a, b)
    return None if q is None else rounded(q, 4) - 1


def compound(a, b):
    q = divide(a, b)
    if q is None:
        return None
    root = abs(float(q)) ** (1 / 3) * (1 if q > 0 else -1)
    return rounded(Decimal(repr(root)), 4) - 1 if q else Decimal(-1)


def add(*values):
    return None if any(v is None for v in values) else sum(values)
