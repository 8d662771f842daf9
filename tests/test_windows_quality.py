import datetime as dt

import pytest
from pyspark.sql import functions as F

from lumen.operators import chartprep as C
from lumen.operators import quality as Q
from lumen.operators import timeseries as TS
from lumen.operators import windows as W


def test_rows_vs_range_running_total(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "k int, x int")
    rows = W.running_total(df, "x", ["k", "x"], name="r", frame="rows")
    rng = W.running_total(df, "x", ["k"], name="r", frame="range")
    assert sorted(r.r for r in rows.collect()) == [10, 30, 35]
    assert sorted(r.r for r in rng.collect()) == [30, 30, 35]     # peers share


def test_moving_average_counts_rows_not_days(spark):
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 10)]
    df = spark.createDataFrame(list(zip(days, [1.0, 2.0, 3.0])), "d date, x double")
    out = {r.d: r.m for r in W.moving_average(df, "x", ["d"], rows=2, name="m").collect()}
    assert out[dt.date(2020, 1, 10)] == 2.5        # the gap does not shrink the window


def test_group_mean_beside_with_null_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), (None, 7)], "g string, v int")
    out = {r.v: (r.g, r.m) for r in W.group_mean_beside(df, ["g"], "v", "m").collect()}
    assert out == {1: ("a", 2.0), 3: ("a", 2.0), 5: (None, 6.0), 7: (None, 6.0)}


def test_first_last_and_topn(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), ("a", 3, 3), ("b", 2, 4)], "g string, v int, id int")
    fl = {r.id: (r.f, r.l) for r in W.first_last_beside(df, ["g"], "v", [("v", True)], ["id"], "f", "l").collect()}
    assert fl[1] == (1, 3) and fl[4] == (2, 2)
    top = W.top_n_per_group(df, ["g"], [("v", False)], ["id"], 1).collect()
    assert sorted(r.id for r in top) == [1, 4]      # tie on v=3 broken by id


def test_period_change_zero_prev(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 4.0), (3, 6.0)], "p int, x double")
    out = {r.p: (r.prev_x, r.pc) for r in TS.period_change(df, "p", ["x"], pct_names={"x": "pc"}).collect()}
    assert out[1] == (None, None) and out[2] == (0.0, None) and out[3] == (4.0, 50.0)


def test_missing_and_outliers_null_false(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "x double")
    (m,) = Q.missing_summary(df, ["x"]).collect()
    assert abs(m.pct_missing_x - 100.0 / 6) < 1e-9
    flagged = Q.outlier_flag(df, "x", Q.iqr_bounds(df, "x"))
    got = {r.x: r.is_outlier for r in flagged.collect()}
    assert got[100.0] is True and got[None] is False and got[3.0] is False


def report(df, keys):
    return tuple(Q.dedup_report(df, keys).first())


def test_dedup_report_holds_no_table_of_keys(spark):
    """Nearly all keys differ: no task may hash them all; a hot key leaves a task merged."""
    df = spark.range(40000).selectExpr("IF(id < 15000, -1, id) AS a", "CAST(id % 7 AS string) AS b", "1 AS c").repartition(3)
    got = Q.dedup_report(df, ["a", "c"])
    assert tuple(got.first()) == (40000, 25001, 14999)
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" in final and final.count("HashAggregate(") == final.count("HashAggregate(keys=[],") == 2
    merged = Q.count_in_batches(df.select("a"))
    assert merged.agg(F.sum("n")).first()[0] == 40000 and merged.where("a = -1").count() <= 6


def test_dedup_report_equals_drop_duplicates(spark):
    nan, other = float("nan"), [float("inf"), 0.0, -0.0, 1.5, None]
    rows = [(x, s, d, t) for x in [nan, nan, *other, *other] for s in ["a", "A", "", None]
            for d in [dt.date(2020, 1, 1), None] for t in [dt.datetime(2020, 1, 1, 2), None]]
    df = spark.createDataFrame(rows, "`x` double, `s.s` string, d date, t timestamp").repartition(3)
    df = df.selectExpr("*", "CAST(x IS NULL AS decimal(9, 2)) AS n", "struct(x) AS inner", "array(d) AS days",
                       "`s.s` COLLATE UTF8_LCASE AS low", "CAST(`s.s` AS binary) AS b")
    for keys in (["x"], ["`s.s`", "d"], ["x", "`s.s`", "d", "t", "n", "b"], ["d", "t"], ["inner"], ["days", "x"], ["low"]):
        want = df.select(*keys).distinct().count()
        assert report(df, keys) == (len(rows), want, len(rows) - want), keys
    assert report(df.limit(0), ["x", "d"]) == (0, 0, 0)


def test_dedup_deterministic_and_impute_cast(spark):
    df = spark.createDataFrame([("k", 2, -3), ("k", 1, None), ("j", 1, -1), ("i", 1, -2)],
                               "key string, o int, d int")
    ded = Q.dedup_by_key(df, ["key"], [F.col("o")])
    assert sorted((r.key, r.o) for r in ded.collect()) == [("i", 1), ("j", 1), ("k", 1)]
    # median of (-3, -1, -2) ignoring NULL = -2; of (-1, -2) = -1.5 → int fill truncates to -1
    filled = Q.impute_median(ded, "d")
    assert {r.key: r.d for r in filled.collect()}["k"] == -1


def test_validation_report(spark):
    df = spark.createDataFrame([("a", 1, 5), (None, None, -1)], "carrier string, dep int, air int")
    out = {r.rule: (r.observed, r.status) for r in Q.validation_report(df, 1, ["carrier", "dep"], ["air"]).collect()}
    assert out["row count > 1"] == (2, "PASS")
    assert out["no NULL carrier"] == (1, "FAIL") and out["no negative air"] == (1, "FAIL")


def test_one_value_histogram_and_density(spark):
    df = spark.createDataFrame([("g", 5.0), ("g", 5.0)], "g string, x double")
    h = C.histogram(df, "x", 4).collect()
    assert sorted((r.bin, r["count"]) for r in h) == [(0, 2), (1, 0), (2, 0), (3, 0)]
    (s,) = df.agg(F.stddev_samp(F.col("x")).alias("s")).collect()
    assert s.s == 0.0
    dens = C.violin_density(df, "x", "g", grid=5).collect()
    assert all(r.density is None for r in dens)       # bandwidth 0


def test_count_plot_absent_level(spark):
    df = spark.createDataFrame([("Fair",), ("Fair",), ("Ideal",)], "cut string")
    out = [(r.level_order, r.cut, r["count"]) for r in C.count_plot(df, "cut", ["Fair", "Good", "Ideal"]).collect()]
    assert sorted(out) == [(1, "Fair", 2), (2, "Good", 0), (3, "Ideal", 1)]


def test_box_stats_whiskers(spark):
    data = [("a", float(x)) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]]
    (r,) = C.box_stats(spark.createDataFrame(data, "g string, v double"), "v", "g").collect()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert r.whisker_low == 1.0 and r.whisker_high == 8.0 and r.outliers == 1


def test_single_row_stddev_is_null(spark):
    df = spark.createDataFrame([("g", 5.0)], "g string, x double")
    (r,) = df.groupBy("g").agg(F.stddev_samp("x").alias("s")).collect()
    assert r.s is None


def test_approx_quantiles_rank_error_bound(spark):
    """percentile_approx with accuracy 100 stays within 1 % rank error."""
    import random

    from lumen.operators.aggregates import approx_quantiles
    rnd = random.Random(11)
    xs = [rnd.gauss(0, 1) for _ in range(20000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    (r,) = approx_quantiles(df, "x", {"q1": 0.25, "med": 0.5, "q3": 0.75}, accuracy=100).collect()
    srt = sorted(xs)
    n = len(srt)
    for p, v in ((0.25, r.q1), (0.5, r.med), (0.75, r.q3)):
        rank = sum(1 for x in srt if x <= v)
        assert abs(rank - p * n) <= 0.01 * n


def test_first_last_desc_numeric_and_string(spark):
    df = spark.createDataFrame([("a", 3, 1, "x"), ("a", 1, 2, "y"), ("b", 2, 3, "z")], "g string, v int, id int, s string")
    fl = {r.id: (r.f, r.l) for r in W.first_last_beside(df, ["g"], "id", [("v", False)], ["id"], "f", "l").collect()}
    assert fl[1] == (1, 2) and fl[3] == (3, 3)
    fl = {r.id: (r.f, r.l) for r in W.first_last_beside(df, ["g"], "id", [("s", False)], ["id"], "f", "l").collect()}
    assert fl[1] == (2, 1) and fl[3] == (3, 3)


def test_first_last_descending_puts_nulls_last_and_nan_first(spark):
    from lumen.operators import windows as W
    df = spark.createDataFrame([("a", 5, 5.0, 1), ("a", None, None, 2), ("a", 9, 9.0, 3), ("b", -2**31, float("nan"), 4),
                                ("b", 0, 1.0, 5)], "g string, v int, x double, id int")
    for col, want in (("v", {"a": (3, 2), "b": (5, 4)}), ("x", {"a": (3, 2), "b": (4, 5)})):
        got = W.first_last_beside(df, ["g"], "id", [(col, False)], ["id"], "first", "last")
        assert {r["g"]: (r["first"], r["last"]) for r in got.collect()} == want


def test_box_stats_with_one_bound(spark):
    from lumen.operators import chartprep as C
    df = spark.createDataFrame([("a", i) for i in range(10)], "g string, v int")
    assert C.box_stats(df, "v", "g", lo=5).first()["n"] == 5
    assert C.box_stats(df, "v", "g", hi=2).first()["n"] == 3


def test_cluster_without_shared_folder_raises():
    import types

    from lumen.session import checkpoint_dir
    context = types.SimpleNamespace(master="spark://host:7077", applicationId="x", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        checkpoint_dir(session)
