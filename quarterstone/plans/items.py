"""Line items: field name in our statement rows -> label in the source reports.

The labels are fixed values: they are the keys of the source reports and must be equal
to them. All amounts are in 10,000 yuan, except earnings per share.
"""

INCOME = {
    "total_revenue": "营业总收入(万元)",
    "revenue": "营业收入(万元)",
    "total_cost": "营业总成本(万元)",
    "cost_of_sales": "营业成本(万元)",
    "admin_expense": "管理费用(万元)",
    "selling_expense": "销售费用(万元)",
    "finance_expense": "财务费用(万元)",
    "impairment": "资产减值损失(万元)",
    "business_tax": "营业税金及附加(万元)",
    "investment_income": "投资收益(万元)",
    "fair_value_change": "公允价值变动收益(万元)",
    "non_operating_income": "营业外收入(万元)",
    "non_operating_expense": "营业外支出(万元)",
    "profit_before_tax": "利润总额(万元)",
    "income_tax": "所得税费用(万元)",
    "net_profit": "净利润(万元)",
    "minority_profit": "少数股东损益(万元)",
    "parent_net_profit": "归属于母公司所有者的净利润(万元)",
    "eps": "基本每股收益",
}

BALANCE = {
    "minority_equity": "少数股东权益(万元)",
    "other_receivables": "其他应收款(万元)",
    "other_payables": "其他应付款(万元)",
    "paid_in_capital": "实收资本(或股本)(万元)",
    "current_assets": "流动资产合计(万元)",
    "non_current_assets": "非流动资产合计(万元)",
    "current_liabilities": "流动负债合计(万元)",
    "goodwill": "商誉(万元)",
    "total_assets": "资产总计(万元)",
    "fixed_assets": "固定资产净值(万元)",
    "intangible_assets": "无形资产(万元)",
    "deferred_expenses": "长期待摊费用(万元)",
    "short_term_loans": "短期借款(万元)",
    "long_term_loans": "长期借款(万元)",
    "loans_due_in_a_year": "一年内到期的非流动负债(万元)",
    "other_current_liabilities": "其他流动负债(万元)",
    "total_liabilities": "负债合计(万元)",
    "parent_equity": "归属于母公司股东权益合计(万元)",
    "total_equity": "所有者权益(或股东权益)合计(万元)",
}

CASH_FLOW = {
    "operating_cash": "经营活动产生的现金流量净额(万元)",
    "investing_cash": "投资活动产生的现金流量净额(万元)",
    "financing_cash": "筹资活动产生的现金流量净额(万元)",
    "net_cash_change": "现金及现金等价物的净增加额(万元)",
    "dividends_and_interest_paid": "分配股利、利润或偿付利息所支付的现金(万元)",
    "dividends_paid_to_minority": "其中：子公司支付给少数股东的股利、利润(万元)",
    "fx_effect": "汇率变动对现金及现金等价物的影响(万元)",
    "capital_received": "吸收投资收到的现金(万元)",
    "capital_from_minority": "其中：子公司吸收少数股东投资收到的现金(万元)",
}

STATEMENTS = {"is": INCOME, "bs": BALANCE, "cf": CASH_FLOW}

# Column heads of the income and cost reports; fixed values, in report order.
INCOME_HEADS = {
    "total_revenue": "营业总收入",
    "revenue": "营业收入",
    "total_cost": "营业总成本",
    "cost_of_sales": "营业成本",
    "admin_expense": "管理费用",
    "selling_expense": "销售费用",
    "finance_expense": "财务费用",
    "impairment": "资产减值",
    "business_tax": "营业税金",
    "investment_income": "投资收益",
    "fair_value_change": "公允价值变动",
    "non_operating_income": "营业外收入",
    "non_operating_expense": "营业外支出",
    "profit_before_tax": "利润总额",
    "income_tax": "所得税",
    "net_profit": "净利润",
    "minority_profit": "少数股东损益",
    "parent_net_profit": "归母净利润",
    "eps": "基本每股收益",
}

# Report column heads shared by several reports; fixed values.
CODE = "股票代码"
PERIOD = "报告期"
LATEST_ANNUAL = "最新年报"
LATEST_QUARTER = "最新季报"
