"""Reports over statement documents: which values a report reads, and the joined rows.

A document is one row per company and statement: ``id, code, rp, c_date, data`` where
``data`` is an array of ``struct<period, line items...>``, one element per period. Reports
look values up by a computed label, so a missing period or item is NULL and nothing is
shifted over gaps. Lookups are narrow; the only exchange a report needs is the join on
``code``, and none when the documents are stored bucketed by ``code``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import any_q4, eofm


class StatementSource(Protocol):
    def joined(self, needs: dict[str, list[str]]) -> DataFrame:
        """``code`` and, for each statement in ``needs``, ``<s>_rp`` and ``<s>_data``."""


class DocumentSource:
    """Statements held as document tables; joined by plain equi joins on ``code``.

    Several documents of one company multiply, as in any inner join. Items that a report
    does not read are pruned from the array's struct at the parquet scan.
    """

    def __init__(self, documents: dict[str, DataFrame]):
        self.documents = documents

    def joined(self, needs: dict[str, list[str]]) -> DataFrame:
        sides = [
            self.documents[s].select(
                "code", F.col("rp").alias(f"{s}_rp"), F.col("data").alias(f"{s}_data"))
            for s in needs
        ]
        return reduce(lambda left, right: left.join(right, "code"), sides)


class Period(NamedTuple):
    """A period to look values up at: its label, and a name that tells it from others."""

    name: str
    label: Column


class Lookup:
    """Builds value expressions; notes the items a report needs and the values it reads.

    Every value gets its own column in one projection under the report's formulas. That
    projection touches ``data`` only by field, so the scan reads just those items.
    """

    def __init__(self) -> None:
        self._needs: dict[str, dict[str, None]] = {}
        self._values: dict[tuple[str, str, str], tuple[str, Column]] = {}
        self._positions: dict[tuple[str, str], Column] = {}

    @property
    def needs(self) -> dict[str, list[str]]:
        return {s: list(items) for s, items in self._needs.items()}

    @property
    def values(self) -> list[Column]:
        return [value.alias(name) for name, value in self._values.values()]

    def rp(self, statement: str) -> Column:
        self._needs.setdefault(statement, {})
        return F.col(f"{statement}_rp")

    def value(self, statement: str, item: str, period: Period) -> Column:
        key = (statement, item, period.name)
        if key not in self._values:
            self._needs.setdefault(statement, {})[item] = None
            value = F.get(F.col(f"{statement}_data.{item}"), self._position(statement, period))
            self._values[key] = (f"v{len(self._values)}", value)
        return F.col(self._values[key][0])

    def _position(self, statement: str, period: Period) -> Column:
        key = (statement, period.name)
        if key not in self._positions:
            found = F.array_position(F.col(f"{statement}_data.period"), period.label)
            self._positions[key] = found.cast("int") - 1
        return self._positions[key]

    def annual(self, statement: str, back: int = 0) -> Period:
        """Fiscal year end ``back`` years before the statement's latest one."""
        return Period(f"{statement} year {back}", any_q4(self.rp(statement), -back))

    def month_end(self, statement: str, back: int = 0) -> Period:
        """Month end ``back`` years before the statement's latest period."""
        return Period(f"{statement} month end {back}", eofm(self.rp(statement), -12 * back))

    def latest(self, statement: str, back: int = 0) -> Period:
        """The statement's latest period itself, or the month end ``back`` years before."""
        return self.month_end(statement, back) if back else Period(f"{statement} rp", self.rp(statement))


def report(source: StatementSource, columns: Callable[[Lookup], list[Column]],
           spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The report's columns per company; ``spread`` may turn a company into several rows."""
    lookup = Lookup()
    wanted = columns(lookup)
    rows = source.joined(lookup.needs)
    rows = spread(rows) if spread else rows
    return rows.select(*[c for c in rows.columns if not c.endswith("_data")], *lookup.values).select(*wanted)
