"""Corporate-action feeds: JSON arrays of comma-joined strings to named columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import exploded
from quarterstone.sources.cleaning import HTML_PAGE

# Field names of the feeds in delivery order; fixed values.
UNLOCK_FIELDS = ["sn", "code", "market", "name", "date", "count", "ratio", "close", "mktvalue",
                 "shares", "c_shares", "a", "b"]
HOLDER_FIELDS = ["code", "name", "amount", "shares", "exprice", "close", "pc"]
DIVIDEND_FIELDS = ["code", "name", "method", "inshare", "divmethod", "amounts", "dps", "dpr",
                   "eps", "rps", "rps2", "rdate", "pdate", "rpdate"]
DIVIDEND_KEPT = ["code", "name", "method", "amounts", "dps", "dpr", "eps", "rps", "rps2",
                 "rdate", "rpdate"]


def _records(payload: DataFrame, strings: Column, fields: list[str], keep: list[str]) -> DataFrame:
    others = [c for c in payload.columns if c != "payload"]
    records = exploded(payload, others, strings, "record")
    parts = records.select(*others, F.split("record", ",").alias("f"))
    return parts.select(*others, *[F.get("f", F.lit(fields.index(k))).alias(k) for k in keep])


def feed_verdict(payload: Column) -> Column:
    """``html`` for an error page, ``no_array`` for what is no JSON array, else ``ok``."""
    return (F.when(F.contains(payload, F.lit(HTML_PAGE)), "html")
            .when(F.json_array_length(payload).isNull(), "no_array").otherwise("ok"))


def share_unlocks(payload: DataFrame) -> DataFrame:
    """``payload``: JSON array of records. The last two fields are dropped."""
    strings = F.from_json("payload", "array<string>")
    return _records(payload, strings, UNLOCK_FIELDS, UNLOCK_FIELDS[:-2])


def _paged(payload: DataFrame) -> Column:
    """Records of ``[page count, [records]]``."""
    return F.from_json(F.get(F.from_json("payload", "array<string>"), F.lit(1)), "array<string>")


def holder_changes(payload: DataFrame, increase: bool | None = None, since=None) -> DataFrame:
    """Shareholders' changes; the last two fields are dropped.

    Payloads may carry ``increase`` (direction) and ``day`` (publication); both can be
    restricted, which happens before any payload is parsed.
    """
    if increase is not None:
        payload = payload.where(F.col("increase") == increase)
    if since is not None:
        payload = payload.where(F.col("day") >= F.lit(since))
    return _records(payload, _paged(payload), HOLDER_FIELDS, HOLDER_FIELDS[:-2])


def profit_distribution(payload: DataFrame) -> DataFrame:
    return _records(payload, _paged(payload), DIVIDEND_FIELDS, DIVIDEND_KEPT)
