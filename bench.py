"""Time the headline queries; prints one JSON line.

Statements are derived and stored once before the reports, as a deployment keeps them; that is a line of its own
(store_statements). BENCH_SF_DIR names the table folder, BENCH_CPUS the local threads, BENCH_QUERIES an
optional comma-separated choice of keys.
"""

from __future__ import annotations

import json
import os
import re
import time

from checks.queries import QUERIES
from quarterstone.session import build_session
from quarterstone.sources.testtables import TestTables

HEADLINE = [
    "roe_q4", "roe_mrq", "base_growth_mrq", "base_pg_yoy_q4", "base_income_q4", "cost_mrqa",
    "s_q4a", "cashflows_q4", "cog_q4", "f_data_error", "f_data_stat", "va_mrqa",
    "industry_stats", "board", "board_all", "upsert_by_key", "stmt_document",
    "src_statement_files", "snapshot_append", "trading_day_gate", "missing_statements",
    "html_table_rows", "markup_rows", "clean_report_text", "feed_dividends", "fn_safe_div",
    "refresh_reports",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_suppkey").count().collect()  # start-up

    seconds = {}
    start = time.perf_counter()
    TestTables(spark, folder).statements  # written once for the session
    seconds["store_statements"] = round(time.perf_counter() - start, 3)
    for key in keys:
        start = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else folder}))


if __name__ == "__main__":
    main()
