"""Key-level table maintenance: upsert, incremental load, keep-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_by_key(stored: DataFrame, incoming: DataFrame, key: str | list[str]) -> DataFrame:
    """Stored rows whose key is not delivered again, and all incoming rows.

    A key is replaced as a whole. The anti join sees each incoming key once, so a key
    with very many incoming rows adds no weight to it.
    """
    keys = [key] if isinstance(key, str) else key
    kept = stored.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(incoming)


def append_new_keys(cached: DataFrame, listing: DataFrame, key: str | list[str]) -> DataFrame:
    """Cached rows, and those listed rows whose key is not cached yet."""
    keys = [key] if isinstance(key, str) else key
    added = listing.join(cached.select(*keys).distinct(), keys, "left_anti")
    return cached.unionByName(added)


def keep_first(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order of numbers; of rows equal in all of it, one of them.

    The smallest order of each key is found first, over keys and numbers alone: fixed-width minima are combined in a
    hash table before the shuffle, without a sort. Rows are then kept by a semi join on key and order, which spreads a
    key that holds a large part of all rows by its orders. A null order comes last; a null key is a key.
    """
    ranks = {f"_o{i}": F.col(o) if isinstance(o, str) else o for i, o in enumerate(order)}
    ranked = rows.withColumns(ranks)
    found = [f"_k{i}" for i in range(len(keys))]
    narrow = ranked.select(*[F.col(k).alias(f) for k, f in zip(keys, found)], *[F.col(r).alias(f"{r}_") for r in ranks])
    first, met = None, []
    for rank in (f"{r}_" for r in ranks):
        least = _matching(narrow, first, [*found, *met]).groupBy(*found, *met).agg(F.min(rank).alias(rank))
        first, met = least, [*met, rank]
    on = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip([*keys, *ranks], [*found, *met])]
    winners = ranked.join(first, on, "left_semi")
    return winners.dropDuplicates(keys).select(*rows.columns)


def _matching(rows: DataFrame, first: DataFrame | None, columns: list[str]) -> DataFrame:
    """Rows that have the smallest orders found so far."""
    if first is None:
        return rows
    other = first.select(*[F.col(c).alias(f"{c}_m") for c in columns])
    return rows.join(other, [F.col(c).eqNullSafe(F.col(f"{c}_m")) for c in columns], "left_semi")
