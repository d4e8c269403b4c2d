"""Tables that change a partition at a time, and reports that follow them."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarterstone import jobs
from quarterstone.plans import catalog
from quarterstone.plans.items import BALANCE, CASH_FLOW, INCOME
from quarterstone.store import PART, Store
from tests.test_jobs import deliver, report_text


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def many_buckets(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def files_of(store, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.root, name, "data").rglob("part-*.parquet")}


def test_a_delivery_writes_only_its_partitions(spark, store, many_buckets):
    """Ten companies among 100,000."""
    companies = spark.range(100_000).select(F.col("id").alias("code"), F.concat(F.lit("old "), "id").alias("v"))
    store.upsert("t", companies)
    before, first = files_of(store, "t"), store.manifest("t")
    assert len(before) == len(first.parts) == first.buckets == 64
    codes = [5, 77, 1234, 40_000, 40_001, 99_999, 100_000, 100_001, 100_002, 100_003]
    touched = {r[0] for r in spark.createDataFrame([(c,) for c in codes], "code long").select(store.part_of("code", 64)).collect()}
    store.upsert("t", spark.createDataFrame([(c, f"new {c}") for c in codes] + [(5, "second")], "code long, v string"))
    after, second = files_of(store, "t"), store.manifest("t")
    assert {f: t for f, t in after.items() if f in before} == before
    new = set(after) - set(before)
    assert {int(f.split(f"{PART}=")[1].split("/")[0]) for f in new} == touched and len(touched) < 12
    assert {p for p in second.parts if second.parts[p] != first.parts[p]} == touched
    got = store.read("t")
    assert got.count() == 100_005 and got.columns == ["code", "v"]
    assert rows(got.where("code IN (5, 6, 100001)")) == [(100_001, "new 100001"), (5, "new 5"), (5, "second"), (6, "old 6")]
    for part, path in second.parts.items():
        assert all(int(f.rsplit("_", 1)[1].split(".")[0]) == part for f in os.listdir(path) if f.endswith(".parquet"))


def test_a_lost_job_leaves_the_last_manifest(spark, store):
    store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "code long, v string"))
    want = rows(store.read("t"))
    written, commit = store._written, store._commit

    def lost(*arguments):
        raise RuntimeError("lost")
    delivery = spark.createDataFrame([(2, "x"), (4, "y")], "code int, v string")
    for step in ("_written", "_commit"):
        setattr(store, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            store.upsert("t", delivery)
        store._written, store._commit = written, commit
        assert rows(Store(spark, store.root).read("t")) == want
    spark.range(1).write.parquet(f"{store.root}/t/manifests/99999999999999999999-half")
    os.unlink(f"{store.root}/t/manifests/99999999999999999999-half/_SUCCESS")
    for _ in range(2):
        store.upsert("t", delivery)
    assert rows(store.read("t")) == [(1, "a"), (2, "x"), (3, "c"), (4, "y")]
    assert dict(store.read("t").dtypes) == {"code": "bigint", "v": "string"}
    store.remove("t", spark.createDataFrame([(3,), (4,), (9,)], "k long"))
    assert rows(store.read("t")) == [(1, "a"), (2, "x")]
    store.remove("t", spark.createDataFrame([(1,), (2,)], "k long"))
    assert store.read("t").count() == 0 and store.manifest("t").parts == {}
    store.upsert("t", delivery)
    assert rows(store.read("t")) == [(2, "x"), (4, "y")]


def test_null_keys_empty_deliveries_and_other_names(spark, store):
    store.upsert("t", spark.createDataFrame([(None, "a"), (1, "b")], "`股票代码` long, `v w` string"), "股票代码")
    store.upsert("t", spark.createDataFrame([], "`股票代码` long, `v w` string"), "股票代码")
    store.upsert("t", spark.createDataFrame([(1, "c")], "`股票代码` long, `v w` string"), "股票代码")
    assert rows(store.read("t")) == [(1, "c"), (None, "a")]
    store.upsert("e", spark.createDataFrame([], "code long, v string"))
    assert store.read("e").count() == 0
    store.upsert("e", spark.createDataFrame([(1, "x")], "code long, v string"))
    assert rows(store.read("e")) == [(1, "x")]


def test_a_repeated_reject_is_kept_once(spark, store):
    bad = spark.createDataFrame([("a", "html"), ("b", "code"), (None, "code")], "value string, verdict string")
    for frame in (bad, bad, bad.union(spark.createDataFrame([("c", "code")], bad.schema))):
        store.reject("t", frame)
    assert rows(spark.read.parquet(f"{store.root}/rejects_t").select("value", "verdict")) == [("a", "html"), ("b", "code"), ("c", "code"), (None, "code")]


def test_expired_states_go_and_read_ones_stay(spark, store, many_buckets):
    for n in range(4):
        store.publish("plain", spark.range(n + 1))
        store.upsert("keyed", spark.createDataFrame([(k, n) for k in ((n,) if n else range(40))], "code long, v long"))
    stray = f"{store.root}/keyed/data/00000000000000000001-lost/{PART}=1"
    spark.range(1).write.parquet(stray)
    want, size = rows(store.read("keyed")), len(files_of(store, "keyed"))
    store.expire(keep=2)
    assert len(os.listdir(f"{store.root}/plain")) == 2 and len(os.listdir(f"{store.root}/keyed/manifests")) == 2
    assert len(files_of(store, "keyed")) < size and not os.path.exists(stray)
    fresh = Store(spark, store.root)
    spark.catalog.clearCache()
    assert rows(fresh.read("keyed")) == want and fresh.read("plain").count() == 4
    store.expire(keep=1)
    used = set(store.manifest("keyed").parts.values())
    assert {f.rsplit("/", 1)[0] for f in files_of(store, "keyed")} == used
    assert rows(fresh.read("keyed")) == want
    with pytest.raises(ValueError):
        store.expire(0)


STATED = (("is", INCOME), ("bs", BALANCE), ("cf", CASH_FLOW))


def texts(codes, *statements, base=0):
    return {f"{s}_{c:06d}.csv": report_text(labels, base + c) for c in codes for s, labels in STATED if not statements or s in statements}


def test_refresh_follows_changed_new_and_removed_companies(spark, store, tmp_path, many_buckets, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    some = ("_roe_q4", "_s_q4a", "_cashflows_q4", "_income_q4", "_pg_yoy_q4")
    monkeypatch.setattr(catalog, "STORED", {name: catalog.STORED[name] for name in some})
    jobs.load_statements(store, deliver(tmp_path, "first", texts(range(1, 25))))
    reports = Store(spark, str(tmp_path / "reports"))
    assert set(jobs.refresh(store, reports)) == set(catalog.STORED)
    assert jobs.refresh(store, reports) == []
    # one company changes, one comes, one goes; another delivers its income only
    jobs.load_statements(store, deliver(tmp_path, "second", texts([3], base=900) | texts([700]) | texts([9], "is", base=500)))
    jobs.remove_companies(store, deliver(tmp_path, "gone", {"gone.csv": "code\n5\n4711\n"}))
    before = reports.manifest("_s_q4a").sources
    assert set(jobs.refresh(store, reports)) == set(catalog.STORED)
    after, touched = reports.manifest("_s_q4a").sources, store.part_of("code", 16)
    assert {p for p in after if after[p] != before.get(p)} == {
        r[0] for r in spark.createDataFrame([(c,) for c in (3, 5, 9, 700)], "code long").select(touched).collect()}
    assert jobs.refresh(store, reports) == []
    whole = Store(spark, str(tmp_path / "whole"))
    jobs.refresh(store, whole)
    source = jobs.inputs(store).statements
    for name, plan in catalog.STORED.items():
        want = rows(plan(source))
        assert rows(reports.read(name)) == want == rows(whole.read(name)), name
        assert {r[0] for r in want} == {*range(1, 25), 700} - {5}
    # a balance sheet alone does not touch reports that read income
    jobs.load_statements(store, deliver(tmp_path, "third", texts([4], "bs", base=77)))
    changed = set(jobs.refresh(store, reports))
    assert "_roe_q4" in changed and not changed & {"_income_q4", "_pg_yoy_q4"}


def test_a_load_opens_its_files_once_and_counts(spark, store, tmp_path):
    folder = deliver(tmp_path, "d", texts([1, 2]) | {"is_000003.csv": "<!DOCTYPE html>", "bs_readme.csv": "x"})
    staged, counts = jobs.stage_reports(store, folder)
    assert counts == {"accepted": 6, "rejected": 2}
    assert all(store.root in f for f in staged.inputFiles()) and staged.count() == 8
    seen = []
    read = jobs.statement_files.read_statement_folder
    jobs.statement_files.read_statement_folder = lambda *a: seen.append(a) or read(*a)
    try:
        assert jobs.load_statements(store, folder) == counts
    finally:
        jobs.statement_files.read_statement_folder = read
    assert len(seen) == 1 and store.read("statements_cf").count() == 2
    assert not [n for n in os.listdir(store.root) if n.startswith("staging_")]


def test_error_pages_of_boards_and_feeds_change_nothing(spark, store, tmp_path):
    def page(name):
        return f"<table><tr><th>姓名</th><th>职务</th><th>持股数</th><th>报酬</th><th>起止时间</th></tr><tr><td>{name}</td><td>x</td><td>1</td><td>2</td><td>y</td></tr></table>"
    folder = deliver(tmp_path, "b", {"dsh_1.html": page("甲"), "dsh_2.html": "<!DOCTYPE html>" + page("乙"), "ggc_1.html": "<p>no table</p>", "x_1.html": page("丙"), "readme": "x"})
    jobs.load_board_pages(store, folder)
    assert [(r["股票代码"], r["姓名"]) for r in store.read("board").collect()] == [(1, "甲")]
    reasons = rows(spark.read.parquet(f"{store.root}/rejects_board").select("file", "verdict"))
    assert reasons == [("dsh_2.html", "html"), ("ggc_1.html", "no_table"), ("readme", "code"), ("x_1.html", "list")]
    newer = deliver(tmp_path, "n", {"dsh_1_old.html": page("旧"), "dsh_1.html": page("新")})
    os.utime(f"{newer}/dsh_1_old.html", (1_000_000_000, 1_000_000_000))
    jobs.load_board_pages(store, newer)
    assert [r["姓名"] for r in store.read("board").collect()] == ["新"]
    jobs.load_feed(store, "unlocks", deliver(tmp_path, "f", {"a.json": '["1,600660,sh,n,2018-04-06,1,2,3,4,5,6,x,y"]', "b.json": "<!DOCTYPE html>", "c.json": "{}"}))
    jobs.load_feed(store, "unlocks", deliver(tmp_path, "g", {"a.json": "busy"}))
    assert [r["code"] for r in store.read("feed_unlocks").collect()] == ["600660"]
    assert {r["verdict"] for r in spark.read.parquet(f"{store.root}/rejects_feed_unlocks").collect()} == {"html", "no_array"}


def test_quotes_by_command_as_a_stream(spark, store, tmp_path):
    from tests.test_operators import quote_line
    calendar = deliver(tmp_path, "cal", {"c.csv": "calendarDate,isOpen\n2018-04-06,true\n2018-04-07,false\n"})
    folder = deliver(tmp_path, "q", {"q_20180406211000.txt": quote_line(600660, 24), "q_20180407211000.txt": quote_line(600660, 25)})
    for _ in range(2):
        jobs.main(["append-quotes", "--store", store.root, "--files", folder, "--calendar", calendar, "--stream", str(tmp_path / "state")])
    assert [(r["code"], r["price"]) for r in jobs.inputs(store).quotes.collect()] == [(600660, 24.0)]
    jobs.main(["expire", "--store", store.root, "--keep", "1"])
    assert spark.read.parquet(f"{store.root}/quotes").count() == 1
