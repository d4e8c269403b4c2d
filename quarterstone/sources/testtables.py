"""The reference-shaped inputs derived from the given test tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone.functions import exact_sum, exploded, money
from quarterstone.operators.statements import DocumentSource
from quarterstone.plans.board import board_all
from quarterstone.plans.catalog import store_statements
from quarterstone.plans.items import STATEMENTS
from quarterstone.session import shared_dir
from quarterstone.sources.testformulas import FISCAL_MONTHS, ITEMS, MEASURES

# statements already written: (session, folder) -> documents
_STORED: dict[tuple[str, str], DocumentSource] = {}


class TestTables:
    """Statements, companies, quotes, board lists and documents over one folder."""

    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[tuple[str, ...], DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if ("table", name) not in self._frames:  # opening a table costs a look at its files
            self._frames["table", name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames["table", name]

    # the inputs of the report catalog
    as_of = dt.date(2024, 6, 30)  # date of the consensus look-up

    @cached_property
    def statements(self) -> DocumentSource:
        """Documents bucketed by code, written once per session and folder, as a deployment keeps them."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _STORED:
            path = shared_dir(self.spark, "statements")
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            _STORED[key] = store_statements(self.spark, self._stored_documents(f"{path}/cells"), path, buckets)
        return _STORED[key]

    # ---- statements --------------------------------------------------------------
    @cached_property
    def cells(self) -> DataFrame:
        """Sums per company and calendar quarter ``q`` (year * 4 + quarter), over all line items.
        Partial sums keep a hot company off the shuffle."""
        day = F.col("l_shipdate")
        return (self.table("lineitem")
                .groupBy(F.col("l_suppkey").alias("code"), (F.year(day) * 4 + F.quarter(day)).alias("q"))
                .agg(*[exact_sum(F.expr(e)).alias(m) for m, e in MEASURES.items()]))

    def _stored_documents(self, path: str) -> dict[str, DataFrame]:
        """All three statements over sums that are written once."""
        self.cells.write.mode("overwrite").parquet(path)
        stored = TestTables(self.spark, self.folder)
        stored.cells = self.spark.read.parquet(path)
        return {s: stored.documents(s) for s in ITEMS}

    @staticmethod
    def _label(quarter: str, statement: str) -> Column:
        """End of the fiscal quarter that holds a calendar quarter's lines."""
        year, month = F.expr(f"CAST(({quarter} - 1) DIV 4 AS INT)"), F.expr(f"(({quarter} - 1) % 4 + 1) * 3")
        shift = F.expr(f"CAST({FISCAL_MONTHS[statement]} AS INT)")
        return F.last_day(F.add_months(F.make_date(year, month, F.lit(1)), shift)).cast("string")

    def documents(self, statement: str, items: list[str] | None = None) -> DataFrame:
        """One statement as a document table ``code, rp, data``, an element for each quarter."""
        element = F.struct("period", *self._items(statement, list(ITEMS[statement]) if items is None else items))
        return (self.cells.withColumn("period", self._label("q", statement)).groupBy("code")
                .agg(F.max("period").alias("rp"), F.collect_list(element).alias("data")))

    def long_cells(self, needs: dict[str, list[str]] = ITEMS) -> DataFrame:
        """``statement, code, item, period, value`` with the source's item labels; one scan."""
        def cell(s: str, item: str) -> Column:
            return F.struct(F.lit(s).alias("statement"), F.lit(STATEMENTS[s][item]).alias("item"),
                            self._label("q", s).alias("period"), money(F.expr(ITEMS[s][item])).alias("value"))

        reported = F.array(*[cell(s, item) for s, items in needs.items() for item in items])
        rows = exploded(self.cells, ["code"], reported, "c")
        return rows.select("c.statement", "code", "c.item", "c.period", "c.value")

    def report_texts(self, *statements: str) -> DataFrame:
        """``file, content``: each company's statement as report text, newest period first."""
        fields = {s: [F.struct(self._label("q", s).alias("period"), *self._items(s, list(ITEMS[s])))] for s in statements}
        docs = self.cells.groupBy("code").agg(*[
            F.reverse(F.array_sort(F.collect_list(element))).alias(f"{s}_data") for s, (element,) in fields.items()])

        def text(s: str) -> Column:
            def line(head: str, field: str) -> Column:
                cells = F.col(f"{s}_data.{field}").cast("array<string>")
                return F.array_join(F.concat(F.array(F.lit(head)), cells), ",")

            lines = [line("报告日期", "period")] + [line(STATEMENTS[s][f], f) for f in ITEMS[s]]
            name = F.concat(F.lit(f"{s}_"), F.format_string("%06d", "code"), F.lit(".csv"))
            return F.struct(name.alias("file"), F.array_join(F.array(*lines), "\r\n").alias("content"))

        return exploded(docs, [], F.array(*[text(s) for s in statements]), "f").select("f.*")

    def present(self) -> DataFrame:
        """``code, statement, period`` of every reported period."""
        reported = F.array(*[F.struct(F.lit(s).alias("statement"), self._label("q", s).alias("period")) for s in ITEMS])
        return exploded(self.cells, ["code"], reported, "p").select("code", "p.*")

    @cached_property
    def latest_periods(self) -> DataFrame:
        """``statement, code, rp`` of every document."""
        return self.present().groupBy("statement", "code").agg(F.max("period").alias("rp"))

    @staticmethod
    def _items(statement: str, items: list[str]) -> list[Column]:
        return [money(F.expr(ITEMS[statement][i])).alias(i) for i in items]

    # ---- other inputs ------------------------------------------------------------
    @cached_property
    def company(self) -> DataFrame:
        """All suppliers, with nation as industry and region as area."""
        listing = (self.table("supplier")
                   .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                   .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")))
        return listing.select(
            F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"),
            F.col("r_name").alias("area"), F.col("n_name").alias("industry"),
            F.col("s_acctbal").alias("outstanding"), (F.col("s_acctbal") * 2).alias("totals"),
            F.col("s_nationkey").cast("double").alias("holders"))

    @cached_property
    def quotes(self) -> DataFrame:
        """One quote per user and day of events; ``inserted`` is the day."""
        value = F.col("value")
        signed = F.when(F.col("event_type") == "error", -value).otherwise(value)
        span = F.max(value).cast("decimal(18,4)") - F.min(value).cast("decimal(18,4)")
        double = [
            F.max(value).alias("price"), exact_sum(signed).cast("double").alias("pe_ttm"),
            exact_sum(value).cast("double").alias("mktcap"), F.min(value).alias("pb"),
            span.cast("double").alias("pctchg"), F.count("*").cast("double").alias("turnover")]
        rows = (self.table("events")
                .groupBy(F.col("user_id").alias("code"), F.to_date("ts").alias("inserted")).agg(*double))
        return rows.withColumn("name", F.concat(F.lit("u"), F.col("code").cast("string")))

    @cached_property
    def quote_stamps(self) -> DataFrame:
        return self.table("events").select(F.to_date("ts").alias("inserted"))

    def calendar(self) -> DataFrame:
        days = self.quote_stamps.distinct()
        return days.select(F.col("inserted").alias("calendarDate"),
                           (F.weekday("inserted") < 5).alias("isOpen"))

    def members(self) -> DataFrame:
        """Board lists from orders: status chooses the list, the key is the position."""
        status = F.col("o_orderstatus")
        which = F.when(status == "O", "dsh").when(status == "F", "jsh").otherwise("ggc")
        amount = F.col("o_totalprice").cast("decimal(18,2)")
        return self.table("orders").select(
            F.col("o_custkey").alias("股票代码"), which.alias("list"),
            F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("姓名"),
            status.alias("职务"), amount.alias("持股数"), amount.alias("报酬"),
            F.to_date("o_orderdate").cast("string").alias("起止时间"))

    @cached_property
    def consensus(self) -> DataFrame:
        """Consensus documents per supplier; rich suppliers lack the last forecast year."""
        keys = [f"{self.as_of.year - 1}"] + [f"{self.as_of.year + k}预测" for k in range(3)]
        pairs: list[Column] = []
        for i, key in enumerate(keys):
            name = F.lit(key)
            if i == len(keys) - 1:  # the head differs, so the lookup finds nothing
                name = F.when(F.col("s_acctbal") < 7500, name).otherwise("无")
            pairs += [name, self._rows(i, 6)]
        return self.table("supplier").select(
            F.col("s_suppkey").alias("code"), F.create_map(*pairs).alias("data"))

    @cached_property
    def board_rows(self) -> DataFrame:
        return board_all(self.members())

    @cached_property
    def surveys(self) -> DataFrame:
        pairs: list[Column] = []
        for i, key in enumerate(("家数", "评级系数")):
            pairs += [F.lit(key), self._rows(i, 3)]
        return self.table("supplier").select(
            F.col("s_suppkey").alias("code"), F.create_map(*pairs).alias("data"))

    @staticmethod
    def _rows(index: int, rows: int) -> Column:
        base = F.col("s_acctbal").cast("decimal(18,2)")
        pairs: list[Column] = []
        for r in range(rows):
            pairs += [F.lit(str(r)), (base + 10 * index + r).cast("string")]
        return F.create_map(*pairs)
