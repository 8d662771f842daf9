import datetime as dt

from pyspark.sql import functions as F

from lumen.functions import calendar as cal
from lumen.functions import expressions as X


def test_bad_dates_are_null(spark):
    df = spark.createDataFrame([(2013, 2, 30), (2013, None, 1), (2013, 12, 31)], "y int, m int, d int")
    got = [r[0] for r in df.select(cal.date_from_parts("y", "m", "d")).collect()]
    assert got == [None, None, dt.date(2013, 12, 31)]


def test_year_end_iso_week_and_week_start(spark):
    days = [dt.date(2013, 12, 29) + dt.timedelta(days=i) for i in range(5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", F.weekofyear("d").alias("w"), cal.period_start("week", "d").alias("ws"),
                    cal.day_type("d").alias("t")).collect()
    assert [r.w for r in out] == [52, 1, 1, 1, 1]
    assert out[1].ws == dt.date(2013, 12, 30)          # weeks start on Monday
    assert out[0].t == "Weekend" and out[1].t == "Weekday"


def test_zero_previous_gives_null_pct(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 3.0)], "prev double, cur double")
    got = [r[0] for r in df.select(X.pct_change("cur", "prev")).collect()]
    assert got == [None, 50.0]


def test_level_position_absent_is_null(spark):
    df = spark.createDataFrame([("Fair",), ("Ideal",), ("Other",)], "c string")
    got = [r[0] for r in df.select(X.level_position("c", ["Fair", "Good", "Ideal"])).collect()]
    assert got == [1, 3, None]


def test_rate_where_and_safe_ratio(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (10,)], "d int")
    (r,) = df.agg(X.rate_where(F.col("d") <= 0).alias("r")).collect()
    assert r.r == 50.0
    assert df.select(X.safe_ratio(F.lit(1), F.lit(0))).first()[0] is None
