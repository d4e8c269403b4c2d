"""Ingest, tables, markup, percentiles and streams on small fixtures."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from quarterstone.operators.keyed import append_new_keys, keep_first, upsert_by_key
from quarterstone.operators import percentiles
from quarterstone.operators.percentiles import exact_percentiles
from quarterstone.operators.snapshots import append_snapshot, latest_snapshot, newest_day
from quarterstone.operators.statements import DocumentSource
from quarterstone.plans import board, catalog, growth
from quarterstone.session import shared_dir, written
from quarterstone.sources import cleaning, feeds, markup, quotes, statement_files, tables
from quarterstone.sources.testtables import TestTables
from quarterstone.streaming.quotes import append_stream, open_day_stream, quote_stream, read_stream


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


# ---- statement files -------------------------------------------------------------------

@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        (tmp_path / name).write_bytes(text.encode())
    write("is_600660.csv", "报告日期,2017-12-31,2017-09-30,其他\r\n营业总收入(万元),120.5,90,1\r\n净利润(万元),-3,,2\r\n")
    write("bs_000001.csv", "报告日期,2016-12-31\n资产总计(万元),7\n")
    write("notes.csv", "a,b\n1,2\n")
    return str(tmp_path)


def test_folder_scan(spark, folder):
    cells = statement_files.report_cells(statement_files.read_statement_folder(spark, folder))
    got = sorted((r["statement"], r["code"], r["item"], r["period"], None if r["value"] is None else float(r["value"]))
                 for r in cells.collect())
    assert got == [
        ("bs", 1, "资产总计(万元)", "2016-12-31", 7.0),
        ("is", 600660, "净利润(万元)", "2017-09-30", None), ("is", 600660, "净利润(万元)", "2017-12-31", -3.0),
        ("is", 600660, "营业总收入(万元)", "2017-09-30", 90.0), ("is", 600660, "营业总收入(万元)", "2017-12-31", 120.5)]


def test_documents_from_files(spark, folder):
    cells = statement_files.report_cells(statement_files.read_statement_folder(spark, folder))
    nested = statement_files.nested_documents(cells).where("statement = 'is'").first()
    assert nested["rp"] == "2017-12-31"
    assert float(nested["data"]["营业总收入(万元)"]["2017-09-30"]) == 90
    via_nested = statement_files.lookup_form(
        statement_files.nested_documents(cells).where("statement = 'is'"), "is").select("code", "rp", "data")
    def flat(frame):
        return rows(frame.select("code", "rp", F.explode("data").alias("e")).select(
            "code", "rp", "e.period", F.coalesce("e.total_revenue", F.lit(-1)), F.coalesce("e.net_profit", F.lit(-1))))
    assert growth.growth_report(DocumentSource({"is": via_nested}), "q4").count() == 1
    reports = statement_files.read_statement_folder(spark, folder)
    documents = statement_files.file_documents(reports)
    assert "Exchange" not in documents._jdf.queryExecution().executedPlan().toString()
    mine = documents.where("statement = 'is'")
    assert mine.first()["data"] == nested["data"] and mine.first()["rp"] == nested["rp"]
    assert flat(statement_files.lookup_form(mine, "is")) == flat(via_nested)


def test_stored_documents_are_pruned_and_bucketed(spark):
    t = TestTables(spark, "/root/testdata/sf0.001")
    for s in ("is", "bs"):
        statement_files.store_documents(t.documents(s), f"stored_{s}", 4)
    source = DocumentSource({s: spark.table(f"stored_{s}") for s in ("is", "bs")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = catalog.STORED["_roe_q4"](source)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    assert "array<struct<period:string,parent_equity:decimal(20,4)>>" in plan
    direct = catalog.STORED["_roe_q4"](t.statements)
    assert rows(report.na.fill(-9)) == rows(direct.na.fill(-9))


def test_stored_statements_equal_plain_documents(spark):
    t = TestTables(spark, "/root/testdata/sf0.001")
    joined = DocumentSource({s: t.documents(s) for s in ("is", "bs", "cf")})
    for name, plan in catalog.STORED.items():
        got, want = plan(t.statements).na.fill(-9), plan(joined).na.fill(-9)
        assert rows(got) == rows(want), name


def test_statements_hold_every_line_item(spark):
    t = TestTables(spark, "/root/testdata/sf0.001")
    cells = t.long_cells({"bs": ["total_assets"]}).agg(F.sum("value")).first()[0]
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert cells == lines.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,4)"))).first()[0]
    assert catalog.RELATIONS["f_data_error"](t).count() > 0
    assert t.company.count() == spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").count()


# ---- keyed maintenance -----------------------------------------------------------------

def test_upsert_is_idempotent(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "code int, v string")
    new = spark.createDataFrame([(1, "x"), (4, "y"), (4, "z")], "code int, v string")
    once = upsert_by_key(stored, new, "code")
    assert rows(once) == [(1, "x"), (2, "c"), (3, "d"), (4, "y"), (4, "z")]
    assert rows(upsert_by_key(once, new, "code")) == rows(once)


def test_append_new_keys(spark):
    cached = spark.createDataFrame([(1, "old")], "code int, v string")
    listing = spark.createDataFrame([(1, "new"), (2, "new")], "code int, v string")
    assert rows(append_new_keys(cached, listing, "code")) == [(1, "old"), (2, "new")]


def test_keep_first(spark):
    people = spark.createDataFrame(
        [(1, "a", 2, "late"), (1, "a", 1, "early"), (1, "b", 3, None), (2, "a", 9, "x")],
        "code int, name string, pos int, note string")
    got = keep_first(people, ["code", "name"], ["pos"]).collect()
    assert {(r["code"], r["name"], r["pos"], r["note"]) for r in got} == {
        (1, "a", 1, "early"), (1, "b", 3, None), (2, "a", 9, "x")}


def test_full_refresh_and_snapshots(spark):
    path = shared_dir(spark, "t")
    batch = spark.createDataFrame([(1, 5.0), (2, 6.0)], "code long, price double")
    append_snapshot(batch, path, F.lit("2018-04-05 21:10:00"))
    append_snapshot(batch.where("code = 1"), path, F.lit("2018-04-06 21:10:00"))
    append_snapshot(batch.where("code = 2").withColumn("price", F.lit(0.5)), path)
    table = spark.read.parquet(path)
    assert table.count() == 4
    newest = latest_snapshot(newest_day(spark, path))
    scans = newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]
    assert scans and all(s.startswith("[isnotnull(snapshot_day") and "(snapshot_day" in s.split("]")[0][12:] for s in scans)
    newest = latest_snapshot(newest_day(spark, path))  # code 1 is missing from the newest batch and vanishes
    assert [(r["code"], r["price"]) for r in newest.collect()] == [(2, 0.5)]


def test_replace_table(spark):
    tables.replace_table(spark.range(3), "replaced")
    tables.replace_table(spark.createDataFrame([("x",)], "other string"), "replaced")
    assert rows(spark.table("replaced")) == [("x",)]


def test_stream_appends_new_files_once(spark, tmp_path):
    source, table, state = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "state")
    def deliver(first):
        spark.range(first, first + 5).select(
            F.col("id").alias("code"), F.lit("2018-04-06 21:10:00").cast("timestamp_ntz").alias("inserted")
        ).write.mode("append").parquet(source)
    deliver(0)
    schema = spark.read.parquet(source).schema
    append_stream(read_stream(spark, schema, source), table, state).awaitTermination()
    deliver(5)
    for _ in range(2):  # nothing new the second time
        append_stream(read_stream(spark, schema, source), table, state).awaitTermination()
    assert sorted(r["code"] for r in spark.read.parquet(table).collect()) == list(range(10))


# ---- percentiles -----------------------------------------------------------------------

def interpolated(values, p):
    values = sorted(values)
    rank = p * (len(values) - 1)
    low = int(rank)
    high = min(low + 1, len(values) - 1) if rank > low else low
    return values[low] + (values[high] - values[low]) * (rank - low)


def test_exact_percentiles_by_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        group = None if i % 17 == 0 else ("hot" if i % 3 == 0 else f"g{i % 5}")
        kind = rng.random()
        value = None if kind < 0.1 else 0.0 if kind < 0.2 else round(rng.uniform(-1, 1) * 10 ** rng.randint(-8, 9), 4)
        data.append((group, value, float(rng.randint(1, 3))))
    data += [("only null", None, 1.0), ("single", 2.5, 1.0)]
    frame = spark.createDataFrame(data, "g string, a double, b double")
    wanted = {"a50": (F.col("a"), 0.5), "a25": (F.col("a"), 0.25), "a0": (F.col("a"), 0.0),
              "a100": (F.col("a"), 1.0), "b50": (F.col("b"), 0.5),
              "pos": (F.when(F.col("a") > 0, F.col("a")), 0.9)}
    got = {r["g"]: r for r in exact_percentiles(frame, "g", wanted, "n").collect()}
    assert set(got) == {d[0] for d in data}
    for g, row in got.items():
        mine = [d for d in data if d[0] == g]
        a = [d[1] for d in mine if d[1] is not None]
        assert row["n"] == len(mine)
        for name, values, p in (("a50", a, 0.5), ("a25", a, 0.25), ("a0", a, 0.0), ("a100", a, 1.0),
                                ("b50", [d[2] for d in mine], 0.5), ("pos", [x for x in a if x > 0], 0.9)):
            if values:
                assert row[name] == pytest.approx(interpolated(values, p), rel=1e-12, abs=1e-12), (g, name)
            else:
                assert row[name] is None
    assert got["hot"]["a50"] == pytest.approx(statistics.median(d[1] for d in data if d[0] == "hot" and d[1] is not None))


# ---- text ------------------------------------------------------------------------------

def test_html_tables(spark):
    html = ("<TABLE id=a><tr><th>h</th></tr></TABLE><!-- <table>x</table> --><table>\n<tr class='x'><th> 姓 名</th><td>1,000</td></tr>"
            "<tr><td>b　c d</td></tr></table>")
    page = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id int, html string")
    assert rows(markup.html_table_rows(page, ["id"], "html", 1)) == [
        (1, 0, 0, "姓名"), (1, 0, 1, "1000"), (1, 1, 0, "bcd")]
    assert rows(markup.html_table_rows(page, ["id"], "html", 1, headers=False)) == [(1, 0, 0, "1000"), (1, 1, 0, "bcd")]


def test_sheets(spark):
    text = ("<Row a='1'><Data>指标</Data><Data>2017</Data><Data>2018预测</Data></Row>\n"
            "<row><data>x&nbsp;</data><data>1,234.5</data><data>--</data></row><row><data>y</data><data>2\n</data></row>")
    sheet = spark.createDataFrame([(1, text)], "id int, t string")
    assert rows(markup.sheet_rows(sheet, ["id"], "t"))[3:] == [
        (1, 1, 0, "x"), (1, 1, 1, "1234.5"), (1, 1, 2, "0.00"), (1, 2, 0, "y"), (1, 2, 1, "2")]
    doc = sheet.select(markup.sheet_document(F.col("t")).alias("d")).first()["d"]
    assert doc == {"指标": {"0": "x", "1": "y"}, "2017": {"0": "1234.5", "1": "2"}, "2018预测": {"0": "0.00", "1": None}}


def test_report_cleaning(spark):
    raw = "报告日期,2017-12-31,\r\n营业 收入,--,\t5,\r\n净利润,1,"
    frame = spark.createDataFrame([(raw,)], "t string")
    assert frame.select(cleaning.clean_report(F.col("t"))).first()[0] == "报告日期,2017-12-31\r\n营业收入,05\r\n净利润,1"


def test_payload_guard(spark):
    frame = spark.createDataFrame([("<!DOCTYPE html> 报告日期",), ("报告日期,1",), ("x",)], "t string")
    assert rows(frame.select("t", cleaning.payload_verdict(F.col("t"), "报告日期"))) == [
        ("<!DOCTYPE html> 报告日期", "html"), ("x", "no_keyword"), ("报告日期,1", "ok")]


def test_table_cleaning(spark, tmp_path):
    frame = spark.createDataFrame([("1", "--", "a"), ("2", "5", None)], "k string, v string, w string")
    assert rows(cleaning.zero_marks(frame.select("k", "v"))) == [("1", "0"), ("2", "5")]
    assert rows(cleaning.try_numbers(frame.select("v"), ["v"]).select("v_num").na.fill(-1)) == [(-1.0,), (5.0,)]
    assert cleaning.complete_columns(frame, "k").columns == ["k", "v"]
    cached = spark.createDataFrame([(1, "银行")], "code long, name string")
    tables.write_csv_cache(cached, str(tmp_path / "c"))
    assert rows(tables.read_csv_cache(spark, str(tmp_path / "c"), "code long, name string")) == [(1, "银行")]
    raw = b"".join(p.read_bytes() for p in (tmp_path / "c").glob("part-*"))
    assert "银行".encode("gbk") in raw


def test_quote_records(spark):
    fields = [""] * 50
    for i, v in {1: "福耀", 2: "600660", 3: "24.1", 32: "-1.5", 38: "0.4", 39: "18.2", 46: "3.1"}.items():
        fields[i] = v
    row = quotes.parse_quote_records(spark.createDataFrame([("~".join(fields),)], "record string")).first()
    assert tuple(row) == (600660, "福耀", 24.1, 18.2, None, 3.1, -1.5, 0.4)


def test_feeds(spark):
    def frame(text):
        return spark.createDataFrame([(text,)], "payload string")
    unlock = feeds.share_unlocks(frame('["1,600660,1,n,2018-01-01,5,0.1,3,4,5,6,a,b"]')).first()
    assert len(unlock) == 11 and unlock["code"] == "600660" and unlock["c_shares"] == "6"
    change = feeds.holder_changes(frame('[1,["600660,n,10,20,1.5,2,3"]]')).first()
    assert tuple(change) == ("600660", "n", "10", "20", "1.5")
    paid = feeds.profit_distribution(frame('[1,["c,n,m,i,d,a,s,r,e,p,q,x,y,z"]]')).first()
    assert tuple(paid) == ("c", "n", "m", "a", "s", "r", "e", "p", "q", "x", "z")


def test_percentiles_of_infinite_values(spark):
    inf, nan = float("inf"), float("nan")
    frame = spark.createDataFrame([("a", v) for v in (-inf, 1.0, 2.0, inf, inf)] + [("b", 1.0), ("b", nan), ("b", 2.0)], "g string, v double")
    got = {r["g"]: tuple(r)[2:] for r in exact_percentiles(frame, "g", {"p0": (F.col("v"), 0.0), "p50": (F.col("v"), 0.5), "p100": (F.col("v"), 1.0)}, "n").collect()}
    assert got["a"] == (-inf, 2.0, inf) and got["b"][:2] == (1.0, 2.0) and got["b"][2] != got["b"][2]


def test_lazy_percentiles_equal_staged_ones(spark):
    """All rounds in one plan, as a view needs, and rounds over written tables."""
    rng = random.Random(5)
    data = [(f"g{rng.randint(0, 2)}", rng.choice([rng.uniform(-3, 3), float(rng.randint(-2, 2)), rng.uniform(1, 2) * 2.0 ** rng.randint(-1074, 1000)])) for _ in range(600)]
    frame = spark.createDataFrame(data, "g string, v double")
    wanted = {f"p{k}": (F.col("v"), k / 8) for k in (0, 3, 4)}
    want = {g: [interpolated([v for h, v in data if h == g], k / 8) for k in (0, 3, 4)] for g, _ in data}
    for options in ({}, {"stage": written}, {"stage": written, "least": 5}):
        got = {r["g"]: list(r)[2:] for r in exact_percentiles(frame, "g", wanted, "n", **options).collect()}
        assert {g: pytest.approx(v) for g, v in want.items()} == got, options


def test_close_values_are_narrowed_to_small_windows(spark, monkeypatch):
    """A hundred thousand distinct values within 1.6 % of each other: no window ever holds more than the stated rows."""
    held = []
    met = percentiles._met
    monkeypatch.setattr(percentiles, "_met", lambda counted, ranks: held.append(counted) or met(counted, ranks))
    frame = spark.range(100_000).select(F.lit("hot").alias("g"), (F.lit(1000.0) + F.col("id") * 1.6e-4).alias("v"))
    wanted = {"p25": (F.col("v"), 0.25), "p50": (F.col("v"), 0.5)}
    row = exact_percentiles(frame, "g", wanted, "n", stage=written, least=1000).first()
    values = [1000.0 + i * 1.6e-4 for i in range(100_000)]
    assert tuple(row) == ("hot", 100_000, interpolated(values, 0.25), interpolated(values, 0.5))
    largest = [c.groupBy("g", "metric", "prefix").count().agg(F.max("count")).first()[0] for c in held]
    assert len(largest) > 1 and max(largest[:-1]) <= 1 << percentiles.DIGIT and largest[-1] <= 1000


def test_key_of_a_value_is_its_place(spark):
    inf, tiny = float("inf"), 5e-324
    values = [-inf, -1.7976931348623157e308, -2.0, -1.0000000000000002, -1.0, -2.2250738585072014e-308, -2.225073858507201e-308, -tiny, 0.0,
              tiny, 2 * tiny, 2.225073858507201e-308, 2.2250738585072014e-308, 0.1, 0.5, 0.9999999999999999, 1.0, 1.0000000000000002, 2.0, 3.0, 4.0,
              2.0 ** 1023, 1.7976931348623157e308, inf, float("nan")]
    values[8:8] = []
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v double").select("i", percentiles.ordered_key(F.col("v")).alias("k"))
    keys = [r["k"] for r in frame.orderBy("i").collect()]
    assert keys == sorted(set(keys))
    import struct
    draw = random.Random(9)
    bits = sorted(draw.randint(0, (2047 << 52) - 1) for _ in range(3000))
    frame = spark.createDataFrame([(b, struct.unpack("<d", struct.pack("<Q", b))[0]) for b in bits], "b long, v double")
    assert frame.where(percentiles.ordered_key(F.col("v")) != F.col("b")).count() == 0
    assert frame.where(percentiles.ordered_key(-F.col("v")) != -F.col("b")).count() == 0
    assert spark.sql("SELECT -0.0D AS v").select(percentiles.ordered_key(F.col("v"))).first()[0] == 0


def test_industry_stats_write_their_input_once(spark):
    """The report reads written frequencies only; as a view it stays a plan over the inputs."""
    t = TestTables(spark, "/root/testdata/sf0.001")
    staged = catalog.RELATIONS["tdx_va_mrq"](t)
    files = staged.inputFiles()
    assert files and all("/frequencies-" in f or "/ranks-" in f for f in files)
    view = catalog.LAZY["tdx_va_mrq"](t)
    assert any("events" in f for f in view.inputFiles())
    assert rows(staged.na.fill(-9.0)) == rows(view.na.fill(-9.0))


# ---- line numbers ----------------------------------------------------------------------

def test_sheet_lines_are_numbered_over_many_splits(spark, tmp_path):
    lines = ["", "a title", "", "another", "heads"] + [f"{i},{'x' * (i % 50)}" for i in range(3000)]
    (tmp_path / "one.csv").write_text("\n".join(lines))
    (tmp_path / "two.csv").write_bytes("\r\n".join(lines[:700]).encode())
    (tmp_path / "three.csv").write_text("")
    kept = [line for line in lines if line]
    for size in ("900b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            sheet = tables.read_sheet(spark, str(tmp_path), 2)
            tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
            got = rows(sheet.select("row_no", "c0", F.coalesce("c1", F.lit("-"))))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert (tasks > 40) == (size == "900b")
        want = [(i, *(line.split(",") if "," in line else (line, "-"))) for n in (len(kept), 698) for i, line in enumerate(kept[:n])]
        assert got == sorted(want)


# ---- keep-first, plans -------------------------------------------------------------------

def test_keep_first_with_hot_keys_ties_and_nulls(spark):
    draw = random.Random(2)
    data = [(None if draw.random() < 0.1 else draw.choice([7, 7, 7, draw.randint(0, 60)]), draw.choice("ab"), draw.choice([None, 1, 2, 3, draw.randint(0, 500)]),
             draw.randint(0, 3), draw.randint(0, 10 ** 6)) for _ in range(4000)]
    frame = spark.createDataFrame(data, "code int, name string, pos int, second int, id int")
    got = keep_first(frame, ["code", "name"], ["pos", "second"]).collect()
    best = {}
    for row in data:
        order = (row[2] is None, row[2] or 0, row[3])
        best[row[:2]] = min(best.get(row[:2], (True, 0, 9)), order)
    assert {tuple(r)[:2]: (r["pos"] is None, r["pos"] or 0, r["second"]) for r in got} == best and len(got) == len(best)
    assert {tuple(r) for r in got} <= set(data)
    assert keep_first(frame.limit(0), ["code"], ["pos"]).count() == 0


def test_keep_first_combines_before_the_shuffle_without_a_sort(spark):
    t = TestTables(spark, "/root/testdata/sf0.001")
    for build in (board.board_all, board.first_in_list):
        plan = build(t.members())._jdf.queryExecution().executedPlan().toString()
        lines = plan[plan.index("Initial Plan"):].split("\n") if "Initial Plan" in plan else plan.split("\n")
        partial = [i for i, line in enumerate(lines) if "partial_min(" in line]
        assert partial and all("HashAggregate" in lines[i] for i in partial)
        assert not any("Sort " in line or "SortAggregate" in line for i in partial for line in lines[i:i + 3])


# ---- stream of quotes --------------------------------------------------------------------

def quote_line(code, price):
    fields = [""] * 50
    fields[1], fields[2], fields[3] = f"n{code}", str(code), str(price)
    return "~".join(fields)


def test_quote_stream_stores_each_record_once_after_a_lost_batch(spark, tmp_path):
    files, table, state = tmp_path / "in", str(tmp_path / "table"), tmp_path / "state"
    files.mkdir()
    days = spark.createDataFrame([("2018-04-06", True), ("2018-04-07", False), ("2018-04-09", True)], "d string, isOpen boolean").select(
        F.to_date("d").alias("calendarDate"), "isOpen")

    def run():
        append_stream(open_day_stream(quote_stream(spark, str(files)), days), table, str(state)).awaitTermination()

    def stored():
        frame = spark.read.parquet(table)
        return sorted((r["code"], r["price"], str(r["inserted"])) for r in frame.collect())

    (files / "q_20180406211000.txt").write_text("\n".join(quote_line(c, c + 0.5) for c in (600660, 1)))
    run()
    assert stored() == [(1, 1.5, "2018-04-06 21:10:00"), (600660, 600660.5, "2018-04-06 21:10:00")]
    # the batch was written, but its commit is lost: it runs again
    last = max(int(p.name) for p in (state / "commits").iterdir() if p.name.isdigit())
    for batch in range(last + 1):
        for name in (f"{batch}", f".{batch}.crc"):
            (state / "commits" / name).unlink(missing_ok=True)
    (files / "again_20180406211000.txt").write_text("\n".join(quote_line(c, c + 0.5) for c in (600660, 2)))
    (files / "q_20180407211000.txt").write_text(quote_line(3, 3.5))  # closed
    (files / "q_20180409211000.txt").write_text(quote_line(1, 9.5))
    run()
    run()
    want = [(1, 1.5, "2018-04-06 21:10:00"), (1, 9.5, "2018-04-09 21:10:00"), (2, 2.5, "2018-04-06 21:10:00"), (600660, 600660.5, "2018-04-06 21:10:00")]
    assert stored() == want
    assert rows(newest_day(spark, table).select("code", "price")) == [(1, 9.5)]


# ---- documents as VARIANT ----------------------------------------------------------------

def test_variant_documents(spark):
    text = '{"净利润(万元)": {"2017-12-31": "12.5", "2016-12-31": 7.123456, "2015-12-31": null, "2014-12-31": "x"}, "其中：a、b": {"2017-12-31": 1}}'
    docs = statement_files.variant_documents(spark.createDataFrame([(1, text), (2, "{}"), (3, None)], "code int, data string"))
    at = statement_files.document_value
    got = docs.select("code", *[at(F.col("data"), item, F.lit(period)).cast("double").alias(f"v{n}") for n, (item, period) in enumerate(
        [("净利润(万元)", "2017-12-31"), ("净利润(万元)", "2016-12-31"), ("净利润(万元)", "2015-12-31"), ("净利润(万元)", "2014-12-31"),
         ("其中：a、b", "2017-12-31"), ("没有", "2017-12-31"), ("净利润(万元)", "1999-12-31")])])
    assert {r["code"]: tuple(r)[1:] for r in got.collect()} == {1: (12.5, 7.1235, None, None, 1.0, None, None), 2: (None,) * 7, 3: (None,) * 7}
