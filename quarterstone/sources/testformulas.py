"""How statement items follow from sums over line items; the same text serves both engines."""

# Sums per company and quarter.
MEASURES = {
    "gross": "l_extendedprice",
    "net": "l_extendedprice * (1 - l_discount)",
    "tax": "l_extendedprice * l_tax",
    "disc": "l_extendedprice * l_discount",
    "qty": "l_quantity",
    "ret": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END",
    "acc": "CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END",
    "fin": "CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END",
    "big": "CASE WHEN l_linestatus = 'F' AND l_quantity > 40 THEN l_extendedprice ELSE 0 END",
}

# A company's fiscal quarters end so many months after the calendar's, in each statement: all of
# its periods carry the shifted label. Offsets of 3, 6 and 9 months give latest periods within a
# fiscal year, those of the balance sheet and the cash flow may differ from the income's, and
# with a single month no December end exists, so annual look-ups find nothing.
_OWN = "CASE code % 10 WHEN 3 THEN 3 WHEN 4 THEN 6 WHEN 6 THEN 9 WHEN 8 THEN 1 ELSE 0 END"
FISCAL_MONTHS = {
    "is": _OWN,
    "bs": f"{_OWN} + CASE WHEN code % 7 = 0 THEN 3 ELSE 0 END",
    "cf": f"{_OWN} + CASE WHEN code % 9 = 0 THEN 1 ELSE 0 END",
}

_COSTS = "ret + tax + disc + qty"
_BEFORE_TAX = f"net - ({_COSTS})"
_NET = f"{_BEFORE_TAX} - acc"

ITEMS = {
    "is": {
        "total_revenue": "net", "revenue": "net", "total_cost": _COSTS, "cost_of_sales": "ret",
        "admin_expense": "tax", "selling_expense": "disc", "finance_expense": "qty",
        "impairment": "acc * 0.5", "business_tax": "tax * 2", "investment_income": "qty * 2",
        "fair_value_change": "qty * 0", "non_operating_income": "qty * 3",
        "non_operating_expense": "qty", "profit_before_tax": _BEFORE_TAX, "income_tax": "tax * 3",
        "net_profit": _NET, "minority_profit": "qty * 4", "parent_net_profit": f"{_NET} - qty * 4",
        "eps": "qty * 0.01",
    },
    "bs": {
        "minority_equity": "fin - big", "other_receivables": "disc * 3",
        "other_payables": "tax * 4", "paid_in_capital": "qty * 10", "current_assets": "net",
        "non_current_assets": "gross - net", "current_liabilities": "ret", "goodwill": "big",
        "total_assets": "gross", "fixed_assets": "acc", "intangible_assets": "tax",
        "deferred_expenses": "disc", "short_term_loans": "tax * 2", "long_term_loans": "disc * 2",
        "loans_due_in_a_year": "tax * 3", "other_current_liabilities": "qty",
        "total_liabilities": "gross - fin", "parent_equity": "big", "total_equity": "fin",
    },
    "cf": {
        "operating_cash": "net - ret", "investing_cash": "-acc", "financing_cash": "disc - tax",
        "net_cash_change": "net - ret - acc + disc - tax",
        "dividends_and_interest_paid": "disc * 4", "dividends_paid_to_minority": "tax",
        "fx_effect": "qty", "capital_received": "big", "capital_from_minority": "tax",
    },
}
