"""The period and division functions under SQL names, as SQL expressions (no Python rows)."""

from __future__ import annotations

from pyspark.sql import SparkSession

_DEFINITIONS = (
    """any_q4(d STRING, n INT) RETURNS STRING
       RETURN concat(CAST(year(date_add(to_date(d), 1)) - 1 + n AS STRING), '-12-31')""",
    """eofm(d STRING, k INT) RETURNS STRING
       RETURN CAST(last_day(add_months(to_date(d), k)) AS STRING)""",
    """my_div(a DECIMAL(20,4), b DECIMAL(20,4)) RETURNS DECIMAL(38,18)
       RETURN CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN b = 0 THEN 0 ELSE a / b END""",
)


def register_functions(spark: SparkSession) -> None:
    for definition in _DEFINITIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
