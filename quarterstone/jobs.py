"""Batch jobs for ``spark-submit``: load deliveries, refresh reports, export relations.

    python -m quarterstone.jobs load-statements --files reports/ --store store/
    python -m quarterstone.jobs refresh --store store/ --reports reports_out/

A store (``store.py``) keeps one folder per input: readers never see a half-written table, a lost job
leaves the last state in force, and a repeated run does no harm. Deliveries by company change only
the partitions that hold their companies.
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarterstone.operators.keyed import append_new_keys, keep_first
from quarterstone.operators.snapshots import newest_day, open_day_rows, replace_day
from quarterstone.operators.statements import DocumentSource
from quarterstone.plans import catalog, quality
from quarterstone.plans.board import LISTS, board_all, members_from_pages
from quarterstone.plans.company import dim_company
from quarterstone.plans.items import CODE, STATEMENTS
from quarterstone.session import build_session
from quarterstone.sources import cleaning, feeds, markup, quotes, statement_files, tables
from quarterstone.store import Store
from quarterstone.streaming.quotes import append_stream, open_day_stream, quote_stream


def load_statements(store: Store, files: str) -> dict[str, int]:
    """Report files replace the documents of their companies; of several files for one company the
    newest counts. Error pages and malformed reports go to ``rejects_statements`` with the reason and
    change nothing. Each file is opened once: the judged reports are staged, by statement, and counted on the way.
    Returns how many were accepted and rejected."""
    staged, counts = stage_reports(store, files)
    usable = staged.where(F.col("verdict") == "ok").drop("verdict")
    for statement in STATEMENTS:
        newest = statement_files.newest_reports(usable.where(F.col("statement") == statement))
        documents = statement_files.lookup_form(statement_files.file_documents(newest), statement).drop("statement")
        store.upsert(f"statements_{statement}", documents.withColumn("c_date", F.current_timestamp()))
    store.reject("statements", staged.where(F.col("verdict") != "ok"))
    store.drop_staged("statements")
    return counts


def stage_reports(store: Store, files: str) -> tuple[DataFrame, dict[str, int]]:
    """The judged reports of a folder, written once, and the numbers of accepted and rejected ones."""
    counts = Observation("reports")
    judged = statement_files.judged_reports(statement_files.read_statement_folder(store.spark, files)).observe(
        counts, F.count_if(F.col("verdict") == "ok").alias("accepted"), F.count_if(F.col("verdict") != "ok").alias("rejected"))
    path = store.staging("statements")
    # a task reads few files; without the hint each would write one for every statement
    judged.hint("rebalance", "statement").write.partitionBy("statement").parquet(path)
    return store.spark.read.schema(judged.schema).parquet(path), dict(counts.get)


def _named_files(store: Store, files: str, name: str, pattern: str, *heads: str) -> DataFrame:
    """Whole files: ``value, loaded`` and the groups of their names, the last one a code; a name that does
    not match gives a null code. Staged once, as verdicts and rows both read them."""
    file = F.col("_metadata.file_name")
    found = store.spark.read.option("recursiveFileLookup", True).text(files, wholetext=True).select(
        file.alias("file"), "value", F.col("_metadata.file_modification_time").alias("loaded"),
        *[F.regexp_extract(file, pattern, i + 1).alias(h) for i, h in enumerate(heads)],
        F.nullif(F.regexp_extract(file, pattern, len(heads) + 1), F.lit("")).try_cast("bigint").alias("code"))
    path = store.staging(name)
    found.write.parquet(path)
    return store.spark.read.schema(found.schema).parquet(path)


def _judged(found: DataFrame, *more: tuple[Column, str]) -> DataFrame:
    """With ``verdict``: an error page, a file without a code in its name, what ``more`` finds, or ok."""
    verdict = F.when(F.contains("value", F.lit(cleaning.HTML_PAGE)), "html").when(F.col("code").isNull(), "code")
    for bad, reason in more:
        verdict = verdict.when(bad, reason)
    return found.withColumn("verdict", verdict.otherwise("ok"))


def _newest_files(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Usable files, of several for one key the last modified, then the first by a hash of its text."""
    return keep_first(judged.where(F.col("verdict") == "ok"), keys, [-F.unix_micros("loaded"), F.xxhash64("value")])


def load_sheets(store: Store, name: str, files: str) -> None:
    """Consensus or survey sheets (``<code>.xls`` text files) replace their documents. Error pages and
    files without a code in their name are rejected; of several sheets of a code the newest counts."""
    judged = _judged(_named_files(store, files, name, r"(\d+)"))
    usable = _newest_files(judged, ["code"])
    store.upsert(name, usable.select("code", markup.sheet_document(F.col("value")).alias("data")))
    store.reject(name, judged.where(F.col("verdict") != "ok"))
    store.drop_staged(name)


def append_quotes(store: Store, files: str, day: dt.date, calendar: DataFrame | None = None) -> None:
    """One quote snapshot; nothing is written on a day the calendar does not open, and a repeated run
    replaces the day's own rows."""
    rows = quotes.parse_quote_records(store.spark.read.text(files), "value")
    if calendar is not None:
        rows = open_day_rows(rows, calendar, F.lit(day))
    replace_day(rows, f"{store.root}/quotes", day)


def stream_quotes(store: Store, files: str, checkpoint: str, calendar: DataFrame | None = None) -> None:
    """All quote files that arrived since the last run, each record of a code and stamp once; records
    of days that the calendar does not open are left out. A lost run goes on where it stopped."""
    rows = quote_stream(store.spark, files)
    if calendar is not None:
        rows = open_day_stream(rows, calendar)
    append_stream(rows, f"{store.root}/quotes", checkpoint).awaitTermination()


def load_board(store: Store, members: DataFrame) -> None:
    store.upsert("board", board_all(members), "股票代码")


def load_board_pages(store: Store, files: str) -> None:
    """Pages named ``<list>_<code>.html`` replace the boards of their companies. Error pages, pages without a table
    and stray names are rejected; of several pages of a company and list the newest counts."""
    pages = _named_files(store, files, "board", r"^([a-z]+)_(\d+)", "list")
    judged = _judged(pages, (~F.rlike("value", F.lit("(?i)<table")), "no_table"), (~F.col("list").isin(*LISTS), "list"))
    usable = _newest_files(judged, ["list", "code"])
    load_board(store, members_from_pages(usable.select("code", "list", F.col("value").alias("html"))))
    store.reject("board", judged.where(F.col("verdict") != "ok"))
    store.drop_staged("board")


def load_company(store: Store, files: str) -> None:
    """The company listing (CSV with a header) replaces the dimension."""
    schema = ("code BIGINT, name STRING, area STRING, industry STRING, outstanding DOUBLE, "
              "totals DOUBLE, holders DOUBLE")
    listing = store.spark.read.schema(schema).csv(files, header=True, enforceSchema=False)
    store.publish("company", dim_company(listing))


def load_classes(store: Store, files: str) -> None:
    """Industry classes of companies that are not stored yet are added; codes compare as numbers. The
    cache keeps all delivered columns, the table of classes the first ones."""
    schema = "code BIGINT, " + ", ".join(f"{c} STRING" for c in tables.CACHE_COLUMNS[1:])
    listing = cleaning.zero_marks(tables.read_csv_cache(store.spark, files, schema))
    stored = store.read("class_cache")
    store.publish("class_cache", listing if stored is None else append_new_keys(stored, listing, "code"))
    store.publish("classes", store.need("class_cache").select(*tables.CLASS_COLUMNS))


def load_feed(store: Store, kind: str, files: str) -> None:
    """Corporate-action feeds (one JSON payload a file) replace the table of their kind. Error pages and payloads
    that are no JSON array are rejected; a delivery without a usable payload changes nothing."""
    found = store.spark.read.option("recursiveFileLookup", True).text(files, wholetext=True)
    path = store.staging(f"feed_{kind}")
    (found.select("value", F.col("_metadata.file_name").alias("file"))
     .withColumn("verdict", feeds.feed_verdict(F.col("value"))).write.parquet(path))
    judged = store.spark.read.parquet(path)
    payloads = judged.where(F.col("verdict") == "ok").select(F.col("value").alias("payload"))
    if not payloads.isEmpty():
        store.publish(f"feed_{kind}", FEEDS[kind](payloads))
    store.reject(f"feed_{kind}", judged.where(F.col("verdict") != "ok"))
    store.drop_staged(f"feed_{kind}")


def load_checks(store: Store, as_of: dt.date) -> None:
    """What is stale, what is missing, and how much is loaded, as tables of the store."""
    loads = None
    for s in STATEMENTS:
        part = store.need(f"statements_{s}").select(F.lit(s).alias("statement"), "code", "rp", F.to_date("c_date").alias("c_date"))
        loads = part if loads is None else loads.unionByName(part)
    store.publish("stale_reports", quality.stale_reports(loads, as_of))
    company = store.need("company")
    store.publish("missing_statements", quality.missing_statements(company, loads))
    store.publish("load_progress", quality.load_progress(company, loads))


def load_pledges(store: Store, files: str) -> None:
    """The pledge sheets, as comma-separated text, replace the table."""
    store.publish("pledges", tables.pledge_ranked(tables.read_sheet(store.spark, files, len(tables.PLEDGE_COLUMNS))))


def refresh(store: Store, reports: Store) -> list[str]:
    """Bring all stored reports up to date; the names of those that changed.

    A report notes the folders of the documents' partitions that each of its own partitions was made from.
    Only partitions whose documents have other folders now are computed and written: those of
    companies that were delivered, added or removed since.
    """
    def update(name: str) -> str | None:
        plan, reads = catalog.STORED[name], _Reads(_Documents(store))
        plan(reads)
        used = [store.manifest(f"statements_{s}") for s in sorted(reads.statements)]
        buckets = {m.buckets for m in used}
        if len(buckets) > 1:
            raise ValueError("statements are stored in different numbers of buckets; replace them")
        now = {p: "|".join(m.parts.get(p, "") for m in used) for p in {p for m in used for p in m.parts}}
        before = reports.manifest(name)
        old = before.sources if before and {before.buckets} == buckets else {}
        changed = {p: now.get(p, "") for p in {*now, *old} if now.get(p, "") != old.get(p)}
        if changed or before is None:
            rows = plan(DocumentSource(_Documents(store, sorted(changed))))
            reports.replace_parts(name, rows, CODE, *buckets, changed)
            return name
        return None

    return [name for name in catalog.side_by_side(store.spark, update, list(catalog.STORED)) if name]


class _Reads(DocumentSource):
    """Notes which statements a report reads."""

    def joined(self, needs: dict[str, list[str]]) -> DataFrame:
        self.statements = list(needs)
        return super().joined(needs)


def remove_companies(store: Store, files: str) -> None:
    """Companies that are listed no more (CSV with a header and a column code) leave all tables kept by company; the
    next refresh drops them from the reports."""
    codes = store.spark.read.schema("code BIGINT").csv(files, header=True)
    for name in (*(f"statements_{s}" for s in STATEMENTS), "consensus", "surveys", "board"):
        store.remove(name, codes)


class StoredInputs:
    """The catalog's inputs out of a store; each is opened when a relation asks for it."""

    quote_stamps = None

    def __init__(self, store: Store, as_of: dt.date | None = None):
        self.store, self.as_of = store, as_of

    @property
    def statements(self) -> DocumentSource:
        return DocumentSource(_Documents(self.store))

    @property
    def quotes(self) -> DataFrame:
        path = f"{self.store.root}/quotes"
        try:
            return newest_day(self.store.spark, path)
        except (Py4JJavaError, AnalysisException) as error:
            raise LookupError("the store has no 'quotes' yet; append them first") from error

    @property
    def latest_periods(self) -> DataFrame:
        parts = [self.store.need(f"statements_{s}").select(F.lit(s).alias("statement"), "rp") for s in STATEMENTS]
        return reduce(DataFrame.unionByName, parts)

    company = property(lambda self: self.store.need("company"))
    board_rows = property(lambda self: self.store.need("board"))
    consensus = property(lambda self: self.store.need("consensus"))
    surveys = property(lambda self: self.store.need("surveys"))


class _Documents(dict):
    """Statement documents by name, opened on demand; only some partitions of them, where given."""

    def __init__(self, store: Store, parts: list[int] | None = None):
        super().__init__()
        self.store, self.parts = store, parts

    def __missing__(self, statement: str) -> DataFrame:
        name = f"statements_{statement}"
        return self.store.need(name) if self.parts is None else self.store.parts(name, self.parts)


def inputs(store: Store, as_of: dt.date | None = None) -> StoredInputs:
    return StoredInputs(store, as_of)


FEEDS = {"unlocks": feeds.share_unlocks, "holders": feeds.holder_changes, "dividends": feeds.profit_distribution}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quarterstone.jobs")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in ("store", *options):
            sub.add_argument(f"--{option}", required=True)
        return sub

    command("load-statements", "files")
    command("load-sheets", "files", "name")
    loaders = {"load-board": load_board_pages, "load-company": load_company,
               "load-classes": load_classes, "load-pledges": load_pledges, "remove-companies": remove_companies}
    for name in loaders:
        command(name, "files")
    command("load-feed", "files", "kind")
    command("check-loads").add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    quotes_command = command("append-quotes", "files")
    quotes_command.add_argument("--day", type=dt.date.fromisoformat, default=dt.date.today())
    quotes_command.add_argument("--calendar", help="CSV with calendarDate and isOpen; closed days write nothing")
    quotes_command.add_argument("--stream", metavar="CHECKPOINT", help="take all files that are new since the last run, days by their stamps")
    command("refresh", "reports")
    command("expire").add_argument("--keep", type=int, default=2)
    command("export", "relation", "target")
    args = parser.parse_args(arguments)

    spark = build_session(f"quarterstone {args.command}")
    store = Store(spark, args.store)
    if args.command == "load-statements":
        print("{accepted} accepted, {rejected} rejected".format(**load_statements(store, args.files)))
    elif args.command == "load-sheets":
        load_sheets(store, args.name, args.files)
    elif args.command in loaders:
        loaders[args.command](store, args.files)
    elif args.command == "load-feed":
        load_feed(store, args.kind, args.files)
    elif args.command == "check-loads":
        load_checks(store, args.as_of)
    elif args.command == "append-quotes":
        calendar = args.calendar and spark.read.schema("calendarDate DATE, isOpen BOOLEAN").csv(args.calendar, header=True)
        if args.stream:
            stream_quotes(store, args.files, args.stream, calendar)
        else:
            append_quotes(store, args.files, args.day, calendar)
    elif args.command == "refresh":
        refresh(store, Store(spark, args.reports))
    elif args.command == "expire":
        store.expire(args.keep)
    elif args.command == "export":
        catalog.RELATIONS[args.relation](inputs(store)).write.mode("overwrite").parquet(args.target)
    if arguments is None:
        spark.stop()


if __name__ == "__main__":
    main()
