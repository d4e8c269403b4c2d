import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterstone.functions import (
    any_q4, compound3, eofm, exact_sum, exchange_prefix, exchange_suffix, growth, norm_code, pub_date,
    register_functions, safe_div)
from tests import golden

DAYS = st.dates(dt.date(1990, 1, 1), dt.date(2060, 12, 31)).map(dt.date.isoformat)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_any_q4_boundaries(spark):
    for day, n, want in [("2017-12-31", 0, "2017-12-31"), ("2017-12-30", 0, "2016-12-31"),
                         ("2018-03-31", -1, "2016-12-31"), ("2016-02-29", 1, "2016-12-31")]:
        assert one(spark, any_q4(F.lit(day), n)) == want
    assert one(spark, any_q4(F.lit(None).cast("string"))) is None


def test_eofm_boundaries(spark):
    for day, k, want in [("2018-02-28", -24, "2016-02-29"), ("2018-12-31", 0, "2018-12-31"),
                         ("2018-12-05", 12, "2019-12-31"), ("2018-01-31", 1, "2018-02-28"),
                         ("2018-11-30", 1, "2018-12-31"), ("2018-01-31", -1, "2017-12-31")]:
        assert one(spark, eofm(F.lit(day), k)) == want


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(DAYS, st.integers(-90, 90), st.integers(-90, 90)), min_size=300, max_size=300))
def test_period_properties(spark, cases):
    rows = spark.createDataFrame(cases, "d string, a int, b int").select(
        "d", "a", "b", eofm(eofm("d", F.col("a")), F.col("b")).alias("twice"),
        eofm("d", F.col("a") + F.col("b")).alias("once"), eofm("d", F.col("a")).alias("m"),
        any_q4("d", F.col("a")).alias("y"), any_q4("d").alias("y0")).collect()
    for r in rows:
        assert r["twice"] == r["once"]
        assert r["m"] == golden.month_end(r["d"], r["a"])
        assert r["y"] == golden.year_end(r["d"], r["a"])
        assert r["y0"].endswith("-12-31") and r["y0"] <= r["d"]


def test_safe_div_and_growth(spark):
    def dec(x):
        return F.lit(x).cast("decimal(20,4)")
    assert one(spark, safe_div(dec("1"), dec("0"))) == 0
    assert one(spark, safe_div(dec(None), dec("0"))) is None
    assert one(spark, safe_div(dec("1"), dec(None))) is None
    assert one(spark, growth(dec("5"), dec("0"))) == -1
    assert float(one(spark, compound3(dec("-8"), dec("1")))) == -3
    for sign in (1, -1):  # half away from zero
        assert float(one(spark, F.round(safe_div(dec(str(sign)), dec("20000")), 4))) == sign * 0.0001
    assert float(one(spark, growth(dec("2.0001"), dec("2")))) == 0.0001


def test_exact_sum(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (-0.3,), (123456789.1234,), (-1.5,)], "v double")
    assert str(rows.agg(exact_sum(F.col("v")).alias("s")).first()["s"]) == "123456787.6234"
    assert rows.where("false").agg(exact_sum(F.col("v")).alias("s")).first()["s"] is None


def test_codes(spark):
    for code, want in [("1", "000001"), ("600660", "600660"), ("60066012", "600660")]:
        assert one(spark, norm_code(F.lit(code))) == want
    assert one(spark, exchange_prefix(F.lit("600660"))) == "sh600660"
    assert one(spark, exchange_suffix(F.lit("000001"))) == "00000102"
    for day in ("2018-04-09", "2018-04-13", "2018-04-15"):
        assert one(spark, pub_date(F.lit(day).cast("date"))) == dt.date(2018, 4, 6)


def test_sql_names(spark):
    register_functions(spark)
    row = spark.sql("SELECT any_q4('2018-03-31', 0) a, eofm('2018-02-28', -24) b, "
                    "my_div(1.0, 0.0) c, my_div(CAST(NULL AS DECIMAL(20,4)), 0.0) d").first()
    assert (row["a"], row["b"], float(row["c"]), row["d"]) == ("2017-12-31", "2016-02-29", 0.0, None)
