"""Quote records: delimited text to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Positions inside a ``~``-delimited record (0-based) and column types; fixed values.
POSITIONS = {"code": 2, "name": 1, "price": 3, "pe_ttm": 39, "mktcap": 45, "pb": 46,
             "pctchg": 32, "turnover": 38}
TYPES = {"code": "bigint", "name": "string"}


def parse_quote_records(records: DataFrame, column: str = "record", keep: list[str] | None = None) -> DataFrame:
    """An empty field becomes NULL; text that is no number stops the job, as on loading. ``keep`` names
    columns beside the record that stay."""
    fields = records.select(F.split(column, "~").alias("f"), *(keep or []))
    return fields.select(*[
        F.nullif(F.get("f", F.lit(i)), F.lit("")).cast(TYPES.get(name, "double")).alias(name)
        for name, i in POSITIONS.items()], *(keep or []))
