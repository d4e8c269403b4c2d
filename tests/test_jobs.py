"""Deliveries into a store, then reports out of it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import queries as check_queries
from quarterstone import jobs
from quarterstone.plans import catalog
from quarterstone.plans.items import BALANCE, CASH_FLOW, INCOME
from quarterstone.sources import statement_files
from quarterstone.sources.testtables import TestTables

PERIODS = [f"{y}-12-31" for y in range(2017, 2010, -1)]


def report_text(labels, base):
    lines = ["报告日期," + ",".join(PERIODS) + ","]
    for n, label in enumerate(labels.values()):
        lines.append(f"{label}," + ",".join("--" if (n, i) == (3, 2) else f" {base + 10 * n + i}" for i in range(len(PERIODS))) + ",")
    return "\r\n".join(lines)


@pytest.fixture
def store(spark, tmp_path):
    return jobs.Store(spark, str(tmp_path / "store"))


def deliver(tmp_path, name, files):
    folder = tmp_path / name
    folder.mkdir()
    for file, text in files.items():
        (folder / file).write_bytes(text.encode())
    return str(folder)


def test_deliveries_to_reports(spark, store, tmp_path):
    first = deliver(tmp_path, "first", {
        f"{s}_{code}.csv": report_text(labels, base)
        for code, base in (("600660", 100), ("000001", 500))
        for s, labels in (("is", INCOME), ("bs", BALANCE), ("cf", CASH_FLOW))})
    jobs.load_statements(store, first)
    again = deliver(tmp_path, "again", {"is_600660.csv": report_text(INCOME, 900)})
    jobs.load_statements(store, again)
    jobs.load_statements(store, again)  # a repeated load changes nothing
    income = store.read("statements_is")
    assert income.count() == 2
    assert store.read("statements_bs").count() == 2

    store.publish("company", spark.createDataFrame(
        [(600660, "福耀", "福建", "汽车", 1.0, 2.0, 3.0), (1, "平安", "深圳", "银行", 1.0, 2.0, 3.0)],
        "code bigint, name string, area string, industry string, outstanding double, totals double, holders double"))
    sheet = "<row><data>指标</data><data>2017</data><data>2018预测</data></row>" + "".join(
        f"<row><data>r{i}</data><data>{i}.123</data><data>1,00{i}</data></row>" for i in range(6))
    jobs.load_sheets(store, "consensus", deliver(tmp_path, "c", {"600660.xls": sheet, "000001.xls": "<!DOCTYPE html>"}))
    survey = "<row><data>家数</data><data>评级系数</data></row>" + "".join(
        f"<row><data>{i}</data><data>0.{i}</data></row>" for i in range(3))
    jobs.load_sheets(store, "surveys", deliver(tmp_path, "s", {"600660.xls": survey}))
    fields = [""] * 50
    for i, v in {1: "福耀", 2: "600660", 3: "24", 32: "1", 38: "2", 39: "20", 45: "9", 46: "4"}.items():
        fields[i] = v
    quotes = deliver(tmp_path, "q", {"q.txt": "~".join(fields)})
    calendar = spark.createDataFrame([(dt.date(2018, 4, 6), True), (dt.date(2018, 4, 7), False)], "calendarDate date, isOpen boolean")
    jobs.append_quotes(store, quotes, dt.date(2018, 4, 6), calendar)
    jobs.append_quotes(store, quotes, dt.date(2018, 4, 7), calendar)  # closed: no rows
    assert spark.read.parquet(f"{store.root}/quotes").count() == 1
    members = spark.createDataFrame(
        [(600660, "dsh", 1, "甲", "董事", 100, 5, "x"), (600660, "ggc", 1, "甲", "经理", 100, 5, "x"), (600660, "ggc", 2, "乙", "经理", 50, 5, "x")],
        "`股票代码` bigint, list string, position long, `姓名` string, `职务` string, `持股数` long, `报酬` long, `起止时间` string")
    jobs.load_board(store, members)

    tables = jobs.inputs(store, dt.date(2018, 6, 30))
    assert set(catalog.RELATIONS) >= {"roe_q4", "va_mrqa", "tdx_va_mrq", "inst", "bod"}
    for name, relation in catalog.RELATIONS.items():
        frame = relation(tables)
        assert frame.count() >= (0 if name == "f_data_error" else 1), name
    value = catalog.RELATIONS["va_mrqa"](tables).first()
    assert (value["code"], float(value["roe_ttm"])) == (600660, 0.2)
    outlook = catalog.RELATIONS["inst"](tables).first()
    assert (float(outlook["pg"]), float(outlook["e_pg0"]), outlook["e_pg1"], float(outlook["inst2"])) == (3.12, 1003.0, None, 1.0)
    bod = {r["code"]: r for r in catalog.RELATIONS["bod"](tables).collect()}
    assert bod[1]["mgmt_shares"] is None and bod[600660]["mgmt_shares"] is not None
    income_row = catalog.RELATIONS["income_q4a"](tables).where("code = 600660").first()
    assert float(income_row["is01"]) == 900

    stored = catalog.refresh_reports(spark, tables.statements, jobs.Store(spark, str(tmp_path / "out")).replaced)
    assert {n: r.count() for n, r in stored.items() if n != "_income_q4"} == {n: 2 for n in catalog.STORED if n != "_income_q4"}
    assert stored["_income_q4"].count() == 10


def test_other_loaders(spark, store, tmp_path):
    jobs.load_company(store, deliver(tmp_path, "co", {
        "c.csv": "code,name,area,industry,outstanding,totals,holders\n1,平安,深圳,银行,1.5,2,3\n"}))
    assert store.read("company").first()["industry"] == "银行"
    folder = tmp_path / "classes"
    folder.mkdir()
    (folder / "c.csv").write_bytes("code,name,class_code,class_name,idst_code,idst_name,pe,pe_ttm,pb,dpr\n1,平安,J,金融业,--,货币,1,2,3,--\n".encode("gbk"))
    jobs.load_classes(store, str(folder))
    (folder / "c.csv").write_bytes("code,name,class_code,class_name,idst_code,idst_name,pe,pe_ttm,pb,dpr\n000001,x,x,x,x,x,1,1,1,1\n2,万科,K,房地产,1,开发,4,5,6,7\n".encode("gbk"))
    jobs.load_classes(store, str(folder))
    assert sorted(tuple(r) for r in store.read("classes").select("code", "name", "idst_code").collect()) == [
        (1, "平安", "0"), (2, "万科", "1")]
    assert sorted(tuple(r) for r in store.read("class_cache").select("code", "pe", "dpr").collect()) == [(1, "1", "0"), (2, "4", "7")]
    sheet = "t\nt\nt\n" + "\n".join(f"2018.04.06,{c},n,1,2,3,4,{r}" for c, r in ((600660, 9.5), (1, "n/a"), (2, 0.5)))
    jobs.load_pledges(store, deliver(tmp_path, "p", {"p.csv": sheet}))
    assert [r["code"] for r in store.read("pledges").orderBy(F.col("ratio_num").asc_nulls_last()).collect()] == ["2", "600660", "1"]
    def page(*members):
        return ("<table><tr><th>姓 名</th><th>职务</th><th>起止时间</th><th>持股数</th><th>报酬</th></tr>"
                + "".join(f"<tr><td>{n}</td><td>{d}</td><td>2017</td><td>{s}</td><td>{p}</td></tr>" for n, d, s, p in members) + "</table>")
    jobs.load_board_pages(store, deliver(tmp_path, "b", {
        "dsh_1.html": page(("甲", "董事长", "1,000", "--"), ("甲", "董事", "5", "5")),
        "ggc_1.html": page(("甲", "总经理", "7", "7"), ("乙", "经理", "--", "3.5"))}))
    assert sorted((r["姓名"], r["职务"], float(r["持股数"]), float(r["报酬"])) for r in store.read("board").collect()) == [
        ("乙", "经理", 0.0, 3.5), ("甲", "董事长", 1000.0, 0.0)]


def test_views_by_name(spark):
    from quarterstone.sources.testtables import TestTables
    t = TestTables(spark, "/root/testdata/sf0.001")
    catalog.register_views(spark, t)
    assert spark.sql("SELECT count(roe) n FROM roe_q4").first()["n"] > 0
    assert spark.sql("SELECT any_q4(max(rp), 0) y FROM cost_mrqa").first()["y"].endswith("-12-31")
    assert spark.table("tdx_va_mrq").where(F.col("count") > 0).count() > 0


def test_uncommitted_version_is_not_read(spark, store):
    store.publish("t", spark.range(3))
    broken = f"{store.root}/t/99999999999999999999-lost"
    spark.range(100).write.parquet(broken)
    import os
    os.unlink(f"{broken}/_SUCCESS")
    assert store.read("t").count() == 3
    assert store.read("nothing") is None


def test_bad_files_change_nothing(spark, store, tmp_path):
    """Error page, stray names, repeated item, bad cell, no period: each rejected alone, with its reason."""
    good = report_text(INCOME, 100)
    jobs.load_statements(store, deliver(tmp_path, "good", {"is_600660.csv": good, "is_000001.csv": report_text(INCOME, 500)}))
    lines = good.split("\r\n")
    jobs.load_statements(store, deliver(tmp_path, "bad", {
        "is_600660.csv": "<!DOCTYPE html><p>busy 报告日期</p>", "is_readme.csv": "报告日期,2017-12-31", "notes.txt": "x",
        "is_000002.csv": "\r\n".join([*lines, lines[1]]), "is_000003.csv": good.replace(" 100", "n/a", 1),
        "is_000004.csv": "报告日期,\r\n净利润,", "is_000005.csv": "no head at all", "is_000006.csv": report_text(INCOME, 700)}))
    stored = {r["code"]: r for r in store.read("statements_is").collect()}
    assert sorted(stored) == [1, 6, 600660] and stored[600660]["rp"] == "2017-12-31" and len(stored[600660]["data"]) == len(PERIODS)
    reasons = {(r["code"], r["verdict"]) for r in spark.read.parquet(f"{store.root}/rejects_statements").collect()}
    assert reasons == {(600660, "html"), (None, "code"), (2, "repeated_item"), (3, "bad_cell"), (4, "no_period"), (5, "no_keyword")}


def test_newest_of_two_files_counts(spark, store, tmp_path):
    import os

    folder = deliver(tmp_path, "two", {"is_600660.csv": report_text(INCOME, 100), "is_600660_again.csv": report_text(INCOME, 900)})
    os.utime(f"{folder}/is_600660_again.csv", (2_000_000_000, 2_000_000_000))
    jobs.load_statements(store, folder)
    income = store.read("statements_is").select(F.explode("data").alias("e")).where("e.period = '2017-12-31'").collect()
    assert [float(r["e"]["total_revenue"]) for r in income] == [900.0]


def test_missing_inputs_are_named(spark, store, tmp_path):
    jobs.load_statements(store, deliver(tmp_path, "income", {"is_600660.csv": report_text(INCOME, 100)}))
    tables = jobs.inputs(store)
    assert catalog.RELATIONS["_income_q4a"](tables).count() == 1
    for relation, name in (("income_q4a", "company"), ("va_mrqa", "quotes"), ("bod", "company"), ("inst_data", "surveys")):
        with pytest.raises(LookupError, match=name):
            catalog.RELATIONS[relation](tables).count()
    with pytest.raises(LookupError, match="statements_bs"):
        catalog.RELATIONS["_roe_q4"](jobs.inputs(jobs.Store(spark, str(tmp_path / "empty")))).count()


def test_jobs_join_without_an_exchange(spark, store, tmp_path):
    jobs.load_statements(store, deliver(tmp_path, "all", {
        f"{s}_{code}.csv": report_text(labels, code) for code in (600660, 600661)
        for s, labels in (("is", INCOME), ("bs", BALANCE), ("cf", CASH_FLOW))}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, plan in catalog.STORED.items():
            text = plan(jobs.inputs(store).statements)._jdf.queryExecution().executedPlan().toString()
            # distinct years of income are the one grouping among the reports
            assert "Exchange" not in text or name == "_income_q4", name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = jobs.Store(spark, store.root)
    assert again.need("statements_bs").count() == 2


def test_quotes_feeds_and_checks_by_command(spark, store, tmp_path):
    fields = [""] * 50
    for i, v in {1: "n", 2: "600660", 3: "24", 32: "1", 38: "2", 39: "20", 45: "9", 46: "4"}.items():
        fields[i] = v
    quotes = deliver(tmp_path, "q", {"q.txt": "~".join(fields)})
    calendar = deliver(tmp_path, "cal", {"c.csv": "calendarDate,isOpen\n2018-04-06,true\n2018-04-07,false\n"})
    for day in ("2018-04-06", "2018-04-06", "2018-04-07"):
        jobs.main(["append-quotes", "--store", store.root, "--files", quotes, "--day", day, "--calendar", calendar])
    assert spark.read.parquet(f"{store.root}/quotes").count() == 1
    jobs.main(["load-feed", "--store", store.root, "--kind", "unlocks", "--files", deliver(
        tmp_path, "f", {"a.json": '["1,600660,sh,n,2018-04-06,1,2,3,4,5,6,x,y"]'})])
    assert store.read("feed_unlocks").first()["code"] == "600660"
    jobs.main(["load-statements", "--store", store.root, "--files", deliver(tmp_path, "r", {
        "is_600660.csv": report_text(INCOME, 1), "bs_600660.csv": report_text(BALANCE, 1), "cf_000001.csv": report_text(CASH_FLOW, 1)})])
    jobs.main(["load-company", "--store", store.root, "--files", deliver(
        tmp_path, "co", {"c.csv": "code,name,area,industry,outstanding,totals,holders\n1,a,b,c,1,2,3\n600660,a,b,c,1,2,3\n"})])
    jobs.main(["check-loads", "--store", store.root, "--as-of", "2099-01-01"])
    assert store.read("stale_reports").count() == 3
    assert sorted(tuple(r) for r in store.read("missing_statements").collect()) == [(1, "bs"), (1, "is"), (600660, "cf")]
    assert tuple(store.read("load_progress").first()) == (3, 6)
    jobs.main(["refresh", "--store", store.root, "--reports", str(tmp_path / "out")])
    assert jobs.Store(spark, str(tmp_path / "out")).need("_income_mrqa").count() == 1


def test_many_small_files_stay_few(spark, store, tmp_path):
    """Report files lie in few folders, and a load stages few files however many tasks read them."""
    tables = TestTables(spark, "/root/testdata/sf0.001")
    check_queries._write_reports(tables, str(tmp_path / "reports"))
    found = [p for p in (tmp_path / "reports").rglob("*.csv") if not p.name.startswith(".")]
    assert all(p.is_file() for p in found) and len({p.name for p in found}) == len(found) > 30
    assert all(p.parent.parent == tmp_path / "reports" for p in found)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a task for each file
    try:
        staged, counts = jobs.stage_reports(store, str(tmp_path / "reports"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(staged.inputFiles()) <= 12 and staged.count() == sum(counts.values())


def test_compressed_reports_are_read(spark, tmp_path):
    import gzip

    text = "报告日期,2020-12-31\r\n营业收入(万元),5\r\n"
    (tmp_path / "is_000001.csv").write_bytes(text.encode())
    (tmp_path / "is_000002.csv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "notes_000003.csv").write_bytes(text.encode())
    rows = statement_files.read_statement_folder(spark, str(tmp_path))
    assert sorted((r.statement, r.code, r.content) for r in rows.collect()) == [("is", 1, text), ("is", 2, text)]


def test_report_folder_is_listed_and_read_by_tasks(spark, tmp_path):
    """The driver holds no file's status; rows, times and ignored names are those of Spark's readers."""
    import gzip
    import os

    root = tmp_path / "given files"
    texts = {"is_000001.csv": "a", "x/y/z/w/bs_000002.csv": "b\nb", "x/cf_000003.csv/part-0-a": "p", "x/is_000009.csv": "", "x/_is/is_000004.csv": "hidden", ".is_000005.csv": "hidden",
             "x/k=1/is_n 0006.csv": "é", "_k=1/is_000007.csv": "kept", "notes.csv": "other", "x/is_000008.csv._COPYING_": "hidden", "x/is_a[b]cd.csv": "c"}
    for i, (name, text) in enumerate(texts.items()):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(text.encode())
        os.utime(root / name, ns=(0, 1_700_000_000_123_456_789 + i * 10**9))
    rows = statement_files.read_statement_folder(spark, str(root))
    assert not rows.inputFiles()
    (root / "x/is_{p}q00.csv.gz").write_bytes(gzip.compress(b"packed"))
    rows = statement_files.read_statement_folder(spark, str(root))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, statement_files._spark_read(spark, [str(root)]).collect()), key=str)
    assert rows.count() == 7 and {r.content for r in rows.collect()} == {"a", "b\nb", "p", "é", "kept", "c", "packed"}
    one = str(root / "is_000001.csv")
    assert [tuple(r)[::2] for r in statement_files.read_statement_folder(spark, one).collect()] == [("a", "is")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        statement_files.read_statement_folder(spark, str(tmp_path / "none")).collect()


def test_a_delivery_stages_one_file_a_partition(spark, store):
    rows = spark.range(200).select(F.col("id").alias("code"), F.lit("v").alias("v"))
    store.upsert("t", rows)
    kept, store.folders.remove = store.folders.remove, lambda folder: None
    try:
        store.upsert("t", rows.repartition(16))
    finally:
        store.folders.remove = kept
    staged = [f for part in store._part_names(f"{store.root}/t/staged/{store.folders.names(f'{store.root}/t/staged')[0]}").values()
              for f in store.folders.names(part) if f.endswith(".parquet")]
    assert len(staged) <= store.manifest("t").buckets and store.read("t").count() == 200
