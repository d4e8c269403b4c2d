"""Tables inside downloaded markup, extracted by Spark's own pattern functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.functions import exploded


def _inside(text: Column, tag: str) -> Column:
    """Contents of every ``tag`` element: any letter case, over line ends, shortest match."""
    return F.regexp_extract_all(text, F.lit(f"(?is)<{tag}.*?>(.*?)</{tag}>"), F.lit(1))


def _cells(rows: DataFrame, keys: list[str], found_rows: Column, cell_tag: str) -> DataFrame:
    by_row = exploded(rows, keys, found_rows, "row_text", "row_no")
    cells = _inside(F.col("row_text"), cell_tag)
    return exploded(by_row, [*keys, "row_no"], cells, "cell", "cell_no")


def clean_sheet(text: Column) -> Column:
    """Spreadsheet text: drop filler, commas and line feeds; no-value marks become 0.00."""
    for old, new in (("&nbsp;", ""), ("--", "0.00"), (",", ""), ("\n", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def sheet_rows(rows: DataFrame, keys: list[str], text: str,
               row_tag: str = "row", cell_tag: str = "data") -> DataFrame:
    """Cells of spreadsheet XML: ``keys, row_no, cell_no, cell``."""
    return _cells(rows, keys, _inside(clean_sheet(F.col(text)), row_tag), cell_tag)


def _table_rows(text: str, table: int, replace: tuple[str, str], table_tag: str, row_tag: str) -> Column:
    """Rows of the ``table``-th table, after removing comments and white space."""
    page = F.replace(F.col(text), F.lit(replace[0]), F.lit(replace[1]))
    page = F.regexp_replace(page, "<!--.*?-->", "")
    page = F.regexp_replace(page, r"(?U)\s+", "")
    return _inside(F.get(_inside(page, table_tag), F.lit(table)), row_tag)


def html_table_rows(rows: DataFrame, keys: list[str], text: str, table: int = 0, *,
                    headers: bool = True, replace: tuple[str, str] = (",", ""),
                    table_tag: str = "table", row_tag: str = "tr",
                    cell_tag: str = "td", header_tag: str = "th") -> DataFrame:
    """Cells of the ``table``-th table of each page: ``keys, row_no, cell_no, cell``.

    Comments within a line and all white space are removed first. A page with too few
    tables gives no rows.
    """
    cells = f"(?:{cell_tag}|{header_tag})" if headers else cell_tag
    return _cells(rows, keys, _table_rows(text, table, replace, table_tag, row_tag), cells)


def html_records(rows: DataFrame, keys: list[str], text: str, names: list[str], table: int = 0) -> DataFrame:
    """Rows of a table as records: ``keys, row_no`` and the columns headed by ``names``.

    The first row holds the heads; a head that is missing gives NULL. One page is one
    expression, so nothing is shuffled.
    """
    found = F.transform(_table_rows(text, table, (",", ""), "table", "tr"), lambda r: _inside(r, "t(?:d|h)"))
    tables = rows.select(*keys, found.alias("found"))
    body = F.slice("found", F.lit(2), F.greatest(F.size("found") - 1, F.lit(0)))
    records = exploded(tables.select(*keys, F.get("found", F.lit(0)).alias("heads"), body.alias("body")),
                       [*keys, "heads"], "body", "cells", "row_no")
    return records.select(*keys, "row_no", *[
        F.get("cells", F.array_position("heads", F.lit(name)).cast("int") - 1).alias(name) for name in names])


def sheet_document(text: Column, row_tag: str = "row", cell_tag: str = "data") -> Column:
    """Spreadsheet XML as a document: column head -> {row number as text -> cell}.

    The first row holds the heads. Everything stays in one expression per sheet, so no
    rows are shuffled; a short row leaves NULL cells.
    """
    rows = F.transform(_inside(clean_sheet(text), row_tag), lambda r: _inside(r, cell_tag))
    heads = F.get(rows, F.lit(0))
    body = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))

    def column(head: Column, j: Column) -> Column:
        cells = F.transform(body, lambda r, i: F.struct(i.cast("string"), F.get(r, j)))
        return F.struct(head, F.map_from_entries(cells))

    return F.map_from_entries(F.transform(heads, column))
