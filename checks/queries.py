"""Every operator and report as a query over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone import jobs
from quarterstone.functions import (
    any_q4, eofm, exchange_prefix, exchange_suffix, norm_code, pub_date, ratio, register_functions)
from quarterstone.operators import keyed, snapshots
from quarterstone.operators.statements import Lookup, report
from quarterstone.plans import board, catalog, company, income, quality
from quarterstone.plans.items import STATEMENTS
from quarterstone.session import shared_dir, written
from quarterstone.sources import cleaning, feeds, markup, quotes, statement_files, tables
from quarterstone.sources.testtables import TestTables
from quarterstone.streaming.quotes import append_stream, read_stream

Query = Callable[[SparkSession, str], DataFrame]

LOAD_CHECK = dt.date(2001, 8, 1)  # date of the staleness check

# Query key -> relation name.
RELATIONS = {
    "base_cashflows_q4": "_cashflows_q4", "base_cog_q4a": "_cog_q4a",
    "base_cost_mrq": "_cost_mrq", "base_cost_q4a": "_cost_q4a",
    "base_growth_mrq": "_growth_report_mrq", "base_growth_q4": "_growth_report_q4",
    "base_income_mrqa": "_income_mrqa", "base_income_q4": "_income_q4",
    "base_income_q4a": "_income_q4a", "base_pg_yoy_mrq": "_pg_yoy_mrq",
    "base_pg_yoy_q4": "_pg_yoy_q4", "base_rg_yoy_mrq": "_rg_yoy_mrq",
    "base_rg_yoy_q4": "_rg_yoy_q4", "base_roa_q4": "_roa_q4", "base_roe_mrq": "_roe_mrq",
    "base_roe_q4": "_roe_q4", "base_scale_mrqa": "_s_mrqa", "base_scale_q4a": "_s_q4a",
    "data_stats": "_data_stats", "board_summary": "_bod_summ", "board": "bod",
    "cashflows_q4": "cashflows_q4", "cog_q4": "cog_q4", "cost_mrqa": "cost_mrqa",
    "cost_q4a": "cost_q4a", "cons_data": "cons_data", "cons_data_pe": "cons_data_pe",
    "inst_data": "inst_data", "f_data_error": "f_data_error", "f_data_stat": "f_data_stat",
    "inst": "inst", "inst2": "inst2", "income_mrqa": "income_mrqa", "income_q4a": "income_q4a",
    "pg_yoy_q4": "pg_yoy_q4", "rg_yoy_q4": "rg_yoy_q4", "roe_mrq": "roe_mrq",
    "roe_q4": "roe_q4", "s_mrqa": "s_mrqa", "s_q4a": "s_q4a", "va_mrqa": "va_mrqa",
    "va_q4a": "va_q4a", "industry_stats": "tdx_va_mrq",
}

QUERIES: dict[str, Query] = {}


def query(build: Callable[[TestTables], DataFrame]):
    """Register ``build`` under its name, with comparable column types."""
    QUERIES[build.__name__] = lambda spark, folder: comparable(build(TestTables(spark, folder)))
    return build


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles; dates and times as text."""
    columns = []
    for name, kind in rows.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date" or kind.startswith("timestamp"):
            column = column.cast("string")
        columns.append(column.alias(name))
    return rows.select(*columns)


def _relation(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = comparable(catalog.RELATIONS[name](TestTables(spark, folder)))
        if name == "tdx_va_mrq":  # interpolated values are compared at eight digits
            rows = rows.select(*[
                F.round(c, 8).alias(c) if kind == "double" else c for c, kind in rows.dtypes])
        return rows
    return run


QUERIES.update({key: _relation(name) for key, name in RELATIONS.items()})


@query
def base_income_q4_fixed(t):
    return income.income_years(t.statements, fix_investment=True)


# ---- sources and sinks ---------------------------------------------------------------

@query
def src_statement_files(t):
    return statement_files.report_cells(statement_files.report_files(t.report_texts("is", "bs", "cf")))


@query
def src_statement_folder(t):
    """One file per company and statement is written, and a foreign one for each company; then
    the folder is scanned."""
    path = shared_dir(t.spark, "reports")
    _write_reports(t, path)
    found = statement_files.read_statement_folder(t.spark, path)
    return statement_files.report_cells(found)


def _write_reports(t, path: str) -> None:
    files = t.report_texts("is", "bs", "cf").withColumnRenamed("content", "value")
    foreign = t.company.select(F.concat(F.lit("notes_"), F.format_string("%06d", "code"), F.lit(".csv")).alias("file"),
                               F.col("name").alias("value"))
    stray = t.company.select(F.concat(F.lit("is_n"), F.format_string("%05d", "code"), F.lit(".csv")).alias("file"),
                             F.lit("<!DOCTYPE html><p>not found</p>").alias("value"))
    # Spark's text writer would open a task's files through Hadoop's local file system, which starts a process for each
    # file's permissions; rows of one name are lines of one file
    files.unionByName(foreign).unionByName(stray).repartition("file").sortWithinPartitions("file").foreachPartition(_file_writer(path))


def _file_writer(path: str):
    """Writes a task's rows ``file, value``, ascending by file, as files of those names in 256 folders, so that no folder
    holds all names. A repeated task writes the same files again."""
    def write(rows) -> None:
        from pyarrow.fs import FileSystem

        store, root = FileSystem.from_uri(path)
        made = set()
        for file, lines in groupby(rows, lambda row: row["file"]):
            folder = f"{root}/{zlib.crc32(file.encode()) % 256:02x}"
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(f"{folder}/{file}") as out:
                out.write("".join(f"{row['value'] or ''}\n" for row in lines).encode())
    return write


@query
def load_statements_job(t):
    """The load job over a folder with foreign files and error pages, twice; then the stored documents."""
    path = shared_dir(t.spark, "delivery")
    _write_reports(t, f"{path}/reports")
    store = jobs.Store(t.spark, f"{path}/store")
    for _ in range(2):
        jobs.load_statements(store, f"{path}/reports")
    rows = None
    for s, items in STATEMENTS.items():
        docs = store.read(f"statements_{s}")
        part = docs.select(F.lit(s).alias("statement"), "code", "rp", F.explode("data").alias("e")).select(
            "statement", "code", "rp", F.col("e.period").alias("period"), *[
                F.lit(None).cast("double").alias(f"v{i}") if i >= len(items) else F.col(f"e.{list(items)[i]}").cast("double").alias(f"v{i}")
                for i in range(max(map(len, STATEMENTS.values())))])
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def replace_table(t):
    """A table is replaced by another with other columns, and read back."""
    name = f"replaced_{uuid.uuid4().hex}"
    tables.replace_table(t.table("region"), name)
    tables.replace_table(t.table("customer").select("c_custkey", "c_name"), name)
    return t.spark.table(name)


@query
def stmt_document(t):
    """Straight from report files, without a shuffle."""
    reports = statement_files.report_files(t.report_texts("is", "bs", "cf"))
    return _document_items(statement_files.file_documents(reports))


@query
def stmt_document_from_cells(t):
    return _document_items(statement_files.nested_documents(t.long_cells()))


def _document_items(docs: DataFrame) -> DataFrame:
    # outer: the plain form would compute the document twice, once for a filter
    items = docs.select("statement", "code", "rp", F.explode_outer("data").alias("item", "periods"))
    return items.select("statement", "code", "rp", "item", F.size("periods").alias("n_periods"),
                        F.col("periods")[F.col("rp")].alias("latest_value"))


@query
def stmt_latest_period(t):
    return t.latest_periods


@query
def upsert_by_key(t):
    orders = t.table("orders").select(
        F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("position"),
        F.col("o_totalprice").alias("amount"), "o_orderdate")
    split = F.lit("2001-01-01").cast("timestamp_ntz")
    stored, incoming = orders.where(F.col("o_orderdate") < split), orders.where(F.col("o_orderdate") >= split)
    return keyed.upsert_by_key(stored, incoming, "code")


@query
def full_refresh(t):
    store = jobs.Store(t.spark, shared_dir(t.spark, "companies"))
    store.publish("company", company.dim_company(t.company).withColumn("name", F.lower("name")))
    store.publish("company", company.dim_company(t.company))
    return store.read("company")


def _two_batches(t) -> str:
    """Quotes appended to a stored table as two batches; its folder."""
    path = shared_dir(t.spark, "quotes")
    day = F.col("inserted")
    for in_batch, stamp in ((day < "2024-01-16", "2024-01-15 21:10:00"),
                            (day >= "2024-01-16", "2024-01-30 21:10:00")):
        rows = t.quotes.where(in_batch).select("code", "price", day.cast("string").alias("quoted"))
        snapshots.append_snapshot(rows, path, F.lit(stamp))
    return path


@query
def snapshot_append(t):
    return t.spark.read.parquet(_two_batches(t))


@query
def latest_snapshot_stored(t):
    """Only the newest day's partition is read."""
    return snapshots.latest_snapshot(snapshots.newest_day(t.spark, _two_batches(t)))


@query
def snapshot_append_stream(t):
    path = shared_dir(t.spark, "quote-stream")
    events = f"{t.folder}/events.parquet*"  # a pattern, as the table may be one file
    rows = read_stream(t.spark, t.table("events").schema, events).select(
        F.col("user_id").alias("code"), F.col("value").alias("price"), F.col("ts").alias("inserted"),
        "event_id")
    append_stream(rows, f"{path}/table", f"{path}/state").awaitTermination()
    return t.spark.read.parquet(f"{path}/table").select(
        "event_id", "code", "price", F.col("snapshot_day").cast("string").alias("snapshot_day"))


@query
def incremental_antijoin(t):
    rows = t.table("customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("class_name"), "c_acctbal")
    cached = rows.where(F.col("c_acctbal") < 0).withColumn("origin", F.lit("cached"))
    return keyed.append_new_keys(cached, rows.withColumn("origin", F.lit("listed")), "code").drop("c_acctbal")


@query
def csv_cache_gbk(t):
    path = shared_dir(t.spark, "classes")
    rows = t.table("customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"),
        F.substring("c_mktsegment", 1, 1).alias("class_code"),
        F.concat(F.lit("行业"), "c_mktsegment").alias("class_name"),
        F.col("c_nationkey").cast("string").alias("idst_code"),
        F.concat(F.lit("门类"), F.col("c_nationkey").cast("string")).alias("idst_name"),
        *[(F.col("c_acctbal").cast("decimal(18,2)") + i).cast("decimal(18,2)").cast("string").alias(c) for i, c in enumerate(("pe", "pe_ttm", "pb", "dpr"))])
    tables.write_csv_cache(rows, path)
    schema = "code BIGINT, " + ", ".join(f"{c} STRING" for c in tables.CACHE_COLUMNS[1:])
    return tables.read_csv_cache(t.spark, path, schema)


@query
def dim_company(t):
    return company.dim_company(t.company)


@query
def parse_quote_records(t):
    value = F.col("value").cast("string")
    by_position = {
        1: F.concat(F.lit("u"), F.col("user_id").cast("string")), 2: F.col("user_id").cast("string"),
        3: value, 32: F.concat(F.lit("-"), value), 38: F.col("event_id").cast("string"), 39: value,
        45: F.when(F.col("event_type") == "error", "").otherwise(value), 46: value}
    fields = [by_position.get(i, F.lit("0")) for i in range(50)]
    return quotes.parse_quote_records(t.table("events").select(F.concat_ws("~", *fields).alias("record")))


@query
def pledge_ranked(t):
    """Sheets are written as text, each with rows above its data and empty lines, and read line by line."""
    balance, sheets = F.col("c_acctbal").cast("string"), 16
    cells = [F.lit("2018.04.06"), F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"),
             F.when(F.col("c_acctbal") < 0, "--").otherwise(balance), balance, F.concat(balance, F.lit(" x")),
             F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(balance)]
    lines = t.table("customer").select(
        F.pmod(F.xxhash64("c_custkey"), F.lit(sheets)).alias("sheet"), F.col("c_custkey").cast("bigint").alias("place"), F.concat_ws(",", *cells).alias("value"))
    above = t.spark.range(sheets * (tables.PREAMBLE_ROWS + 2)).select(
        F.pmod("id", F.lit(sheets)).alias("sheet"), (F.col("id") - (1 << 40)).alias("place"),
        F.when(F.col("id") < 2 * sheets, "").otherwise("title,of,the,sheet").alias("value"))
    path = shared_dir(t.spark, "sheets")
    (lines.unionByName(above).repartition("sheet").sortWithinPartitions("sheet", "place").drop("place")
     .write.partitionBy("sheet").text(path))
    return tables.pledge_ranked(tables.read_sheet(t.spark, path, len(tables.PLEDGE_COLUMNS)))


@query
def refresh_reports(t):
    """All stored reports are written and read back; every column of each is summed up."""
    store, result = jobs.Store(t.spark, shared_dir(t.spark, "reports")), None
    for name, rows in catalog.refresh_reports(t.spark, t.statements, store.replaced).items():
        columns = []
        for head, kind in rows.dtypes:
            column, text = F.col(f"`{head}`"), kind == "string"
            total = F.lit(None).cast("double") if text else F.sum(column.cast("decimal(24,4)")).cast("double")
            columns.append(F.struct(F.lit(name).alias("report"), F.lit(head).alias("head"), F.count("*").alias("n_rows"),
                                    F.count(column).alias("n_values"), total.alias("total"),
                                    (F.max(column) if text else F.lit(None).cast("string")).alias("largest")))
        part = rows.agg(F.array(*columns).alias("c")).select(F.explode("c").alias("c")).select("c.*")
        result = part if result is None else result.unionByName(part)
    return result


@query
def feed_unlocks(t):
    o = t.table("orders")
    record = F.concat_ws(
        ",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.to_date("o_orderdate").cast("string"), *[F.col("o_custkey")] * 6, F.lit("x"), F.lit("y"))
    other = F.concat(F.lit("0"), record)
    return feeds.share_unlocks(o.select(F.to_json(F.array(record, other)).alias("payload")))


def _paged(t, *fields):
    record = F.concat_ws(",", *fields)
    payload = F.concat(F.lit("[1,"), F.to_json(F.array(record, record)), F.lit("]"))
    return t.table("orders").select(
        payload.alias("payload"), (F.col("o_orderstatus") == "O").alias("increase"),
        F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("feed_id"))


@query
def feed_holder_changes(t):
    payload = _paged(t, "o_custkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)"),
                     "o_orderkey", F.lit("1.50"), F.lit("2.50"), F.lit("3.50"))
    return feeds.holder_changes(payload, increase=True, since="1998-01-01")


@query
def feed_dividends(t):
    payload = _paged(t, "o_custkey", "o_orderpriority", *[F.concat(F.lit(f"f{i}-"), "o_orderkey") for i in range(12)])
    return feeds.profit_distribution(payload.select("payload"))


# ---- markup and text -----------------------------------------------------------------

@query
def markup_rows(t):
    return markup.sheet_rows(t.table("pages"), ["page_id"], "html", row_tag="li", cell_tag="a")


@query
def html_table_rows(t):
    return markup.html_table_rows(t.table("pages"), ["page_id"], "html", headers=False,
                                  table_tag="ul", row_tag="li", cell_tag="a")


@query
def board_pages(t):
    """Whole boards, a page for each company, list and 100,000 order numbers, read back as members; error pages
    are left out by the guard."""
    def row(*cells):
        return F.concat(F.lit("<tr>\n"), *[F.concat(F.lit(f"<{tag} class='x'>"), c, F.lit(f"</{tag}>")) for tag, c in cells], F.lit("</tr>"))
    heads = row(*[("th" if i < 3 else "td", F.lit(h)) for i, h in enumerate(("序号", "姓 名", "职务", "起止时间", "持股数", "报酬"))])
    shares = F.when(F.col("职务") == "O", "--").otherwise(F.col("持股数").cast("string"))
    member = row(*[("td", c) for c in (F.lit("1"), F.col("姓名"), F.col("职务"), F.regexp_replace("起止时间", "-", "."), shares,
                                       F.concat(F.lit("1,"), F.col("报酬").cast("string")))])
    chunk = F.expr("position div 100000")
    boards = t.members().groupBy(F.col("股票代码").alias("code"), "list", chunk).agg(F.array_sort(F.collect_list(F.struct("position", member.alias("row")))).alias("rows"))
    pages = boards.select("code", "list", F.concat(F.lit("<html><!-- x --><table>"), heads, F.array_join("rows.row", ""), F.lit("</table></html>")).alias("html"))
    lost = t.company.select("code", F.lit("dsh").alias("list"), F.concat(F.lit("<!DOCTYPE html><table>"), heads, F.lit("</table>")).alias("html"))
    found = pages.unionByName(lost)
    return board.members_from_pages(found.where(cleaning.payload_verdict(F.col("html"), "<table") == "ok"))


@query
def sheet_document(t):
    def row(*cells):
        return F.concat(F.lit("<Row>"), *[F.concat(F.lit("<Data t=\"s\">"), c, F.lit("</Data>")) for c in cells],
                        F.lit("</Row>\n"))
    balance = F.col("s_acctbal").cast("decimal(18,2)").cast("string")
    text = F.concat(row(F.lit("指标"), F.lit("2023"), F.lit("2024预测")),
                    row(F.col("s_name"), balance, F.lit("--")),
                    row(F.lit("&nbsp;b"), F.concat(F.lit("1,"), balance), F.col("s_nationkey").cast("string")))
    docs = t.table("supplier").select(F.col("s_suppkey").alias("code"), markup.sheet_document(text).alias("data"))
    heads = docs.select("code", F.explode("data").alias("head", "cells"))
    return heads.select("code", "head", F.explode("cells").alias("row_no", "value"))


@query
def reject_bad_payload(t):
    payloads = t.table("pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    payloads = payloads.unionByName(t.table("documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"))
    return payloads.select("kind", "id", cleaning.payload_verdict(F.col("text"), "the").alias("verdict"))


@query
def clean_report_text(t):
    raw = F.replace("text", F.lit(". "), F.lit(",\r\n"))
    raw = F.replace(F.replace(raw, F.lit(", "), F.lit(",\t")), F.lit("an"), F.lit("--"))
    text = cleaning.clean_report(F.concat(raw, F.lit(",")))
    return t.table("documents").select("doc_id", F.md5(text).alias("digest"), F.length(text).alias("n_chars"))


@query
def clean_dash_zero(t):
    def marked(column):
        return F.when(F.col("c_acctbal") < 0, "--").otherwise(F.col(column).cast("string")).alias(column)
    rows = t.table("customer").select("c_custkey", marked("c_mktsegment"), marked("c_nationkey"),
                                      F.concat(F.lit("a--"), "c_name").alias("c_name"))
    return cleaning.zero_marks(rows)


@query
def try_numeric(t):
    rows = t.table("part").select("p_partkey", "p_brand", F.col("p_size").cast("string").alias("p_size"))
    return cleaning.try_numbers(rows, ["p_brand", "p_size"])


@query
def complete_columns(t):
    rows = t.table("documents").join(t.table("labels"), "doc_id", "left").select(
        "quality", "doc_id", "lang", "toxic", "n_chars", "source")
    return cleaning.complete_columns(rows, "doc_id")


# ---- functions -----------------------------------------------------------------------

def _dated(t):
    return t.table("orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("d"))


@query
def fn_any_q4(t):
    return _dated(t).select("o_orderkey", "d", *[any_q4("d", -k).alias(f"y{k}") for k in range(6)],
                            any_q4("d", 1).alias("next"))


@query
def fn_eofm(t):
    return _dated(t).select("o_orderkey", "d", *[eofm("d", -12 * k).alias(f"m{k}") for k in range(6)],
                            eofm("d", 1).alias("next"), eofm("d", -1).alias("before"))


@query
def fn_safe_div(t):
    money = "decimal(20,4)"
    price, rate = F.col("l_extendedprice").cast(money), F.col("l_discount").cast(money)
    quantity = F.when(F.col("l_tax") > 0, F.col("l_quantity")).cast(money)
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", ratio(price, rate).alias("by_discount"),
        ratio(price, quantity).alias("by_quantity"), ratio(quantity, price).alias("of_price"))


@query
def fn_norm_code(t):
    key = F.col("c_custkey").cast("string")
    return t.table("customer").select(
        "c_custkey", norm_code(key).alias("padded"), norm_code(F.concat(F.lit("1234"), key)).alias("joined"),
        norm_code("c_name").alias("cut"))


@query
def fn_exchange(t):
    code = norm_code(F.concat(F.col("c_custkey").cast("string"), F.lit("00")))
    return t.table("customer").select(
        "c_custkey", exchange_prefix(F.col("c_custkey").cast("string")).alias("short_symbol"),
        exchange_prefix(code).alias("quote_symbol"), exchange_suffix(code).alias("sheet_symbol"))


@query
def fn_pub_date(t):
    return _dated(t).select("o_orderkey", "d", pub_date(F.to_date("d")).alias("published"))


@query
def sql_functions(t):
    register_functions(t.spark)
    t.table("orders").createOrReplaceTempView("all_orders")
    return t.spark.sql("""
        SELECT o_orderkey, any_q4(CAST(o_orderdate AS STRING), -1) AS y1, eofm(CAST(o_orderdate AS STRING), -24) AS m2,
               round(my_div(CAST(o_totalprice AS DECIMAL(20,4)), CAST(o_custkey AS DECIMAL(20,4))), 4) AS share
        FROM all_orders""")


@query
def sql_over_views(t):
    catalog.register_views(t.spark, t, ["roe_q4", "s_q4a"])
    return t.spark.sql("""
        SELECT idst, count(*) AS n, count(roe) AS n_roe, sum(tca) AS tca, max(rp) AS last_rp
        FROM (SELECT r.code, r.idst, r.rp, r.roe, s.tca FROM roe_q4 r JOIN s_q4a s ON r.code = s.code)
        GROUP BY idst""")


@query
def json_lookup(t):
    """All three statements as JSON text, parsed once into VARIANT and written; values by item and period."""
    docs = statement_files.nested_documents(t.long_cells())
    text = docs.select("statement", "code", "rp", F.to_json("data").alias("data"))
    stored = written(statement_files.variant_documents(text), "variants")
    at, data, rp, statement = statement_files.document_value, F.col("data"), F.col("rp"), F.col("statement")

    def item(**fields):
        return F.coalesce(*[F.when(statement == s.rstrip("_"), STATEMENTS[s.rstrip("_")][f]) for s, f in fields.items()])
    return stored.select(
        "statement", "code", "rp", at(data, item(is_="net_profit", bs="total_assets", cf="operating_cash"), rp).alias("latest"),
        at(data, item(is_="total_revenue", bs="total_equity", cf="investing_cash"), eofm(rp, -12)).alias("year_ago"),
        at(data, "没有", rp).alias("unknown_item"), at(data, item(is_="eps", bs="goodwill", cf="fx_effect"), F.lit("1900-12-31")).alias("unknown_period"))


# ---- predicates, joins, duplicates ---------------------------------------------------

@query
def stale_reports(t):
    loads = t.table("orders").groupBy(F.col("o_custkey").alias("code")).agg(
        F.to_date(F.max("o_orderdate")).alias("c_date"))
    return quality.stale_reports(loads, LOAD_CHECK)


def _listed(t):
    """Suppliers and customers as one listing; only the former have statements."""
    return t.company.select("code").union(t.table("customer").select("c_custkey")).distinct()


@query
def missing_statements(t):
    return quality.missing_statements(_listed(t), t.present())


@query
def load_progress(t):
    return quality.load_progress(_listed(t), t.present())


@query
def trading_day_gate(t):
    return snapshots.open_day_rows(t.quotes, t.calendar(), F.col("inserted"))


@query
def latest_snapshot(t):
    return snapshots.latest_snapshot(t.quotes, t.quote_stamps)


@query
def join_three_statements(t):
    """Documents are stored bucketed by code, as a deployment keeps them, and then joined."""
    wanted = {"is": "net_profit", "bs": "total_assets", "cf": "operating_cash"}

    def columns(lk: Lookup):
        return ["code", *[lk.rp(s).alias(f"{s}_rp") for s in wanted],
                *[lk.value(s, item, lk.latest(s)).alias(item) for s, item in wanted.items()]]
    return report(t.statements, columns)


@query
def dedup_keep_first(t):
    return board.first_in_list(t.members())


@query
def board_all(t):
    return board.board_all(t.members())
