"""Cells of every order type, neighbours at any offset, frames over raw rows,
bracketed quantiles, salted joins, and how often the final plans read their input."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from lumen.operators import aggregates as A
from lumen.operators import chartprep as C
from lumen.operators import joins as J
from lumen.operators import quality as Q
from lumen.operators import windows as W
from lumen.operators.ordered import _cells, rank_within

Q_ALL = E.queries()


def _rows(df, cols):
    return sorted((repr(tuple(r)) for r in df.select(*cols).collect()))


def _ref(df, by, order, tiebreak, offset):
    sort = [F.col(c).asc() if a else F.col(c).desc() for c, a in order]
    w, wr = Window.partitionBy(*by).orderBy(*sort, *tiebreak), Window.partitionBy(*by).orderBy(*sort)
    return df.select("*", F.row_number().over(w).alias("row_number"), F.rank().over(wr).alias("rank"),
                     F.dense_rank().over(wr).alias("dense_rank"), F.lag("id", offset).over(w).alias("prev_id"),
                     F.lead("id", offset).over(w).alias("next_id"))


@pytest.fixture
def new_york(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", was)


@pytest.mark.parametrize("asc", [True, False])
def test_timestamps_without_zone_where_clocks_change(new_york, asc):
    times = ["2024-03-10 01:30", "2024-03-10 02:30", "2024-03-10 02:30", "2024-03-10 03:30", "2024-03-10 03:30",
             "2024-11-03 01:10", "2024-11-03 01:50", "2024-11-03 01:50", "2024-11-03 02:10"] * 30
    df = new_york.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, t string").selectExpr(
        "id", "1 AS g", "cast(t AS timestamp_ntz) AS t")
    outputs = ("row_number", "rank", "dense_rank")
    got = rank_within(df, ["g"], [("t", asc)], ["id"], outputs=outputs, lag=["id"], lead=["id"], ranges=4)
    cols = ["id", *outputs, "prev_id", "next_id"]
    assert _rows(got, cols) == _rows(_ref(df, ["g"], [("t", asc)], ["id"], 1), cols)


def test_the_smallest_case_of_a_skipped_hour(new_york):
    df = new_york.createDataFrame([(0, "2024-03-10 00:10"), (1, "2024-03-10 02:30"), (2, "2024-03-10 02:30"),
                                   (3, "2024-03-10 03:30"), (4, "2024-03-10 03:30")], "id int, t string").selectExpr(
        "id", "'a' AS g", "cast(t AS timestamp_ntz) AS t")
    got = sorted((r["id"], r["rank"], r["dense_rank"]) for r in W.value_ranks(df, ["g"], "t", True, ["id"]).collect())
    assert [g[1] for g in got] == [1, 2, 2, 4, 4] and [g[2] for g in got] == [1, 2, 2, 3, 3]


def test_columns_of_any_name_pass_unchanged(spark):
    names = ["_pos", "_sub", "_one", "_b", "_rn", "_before", "_n", "__x", "_k_g", "_fine", "_start", "_step", "_cnt"]
    df = spark.createDataFrame([(i % 2, i % 5, i, *range(100, 100 + len(names))) for i in range(200)],
                               "g int, v int, id int, " + ", ".join(f"`{n}` int" for n in names))
    outputs = ("row_number", "rank", "dense_rank", "group_size")
    got = rank_within(df, ["g"], [("v", True)], ["id"], outputs=outputs, lag=["id"], lead=["id"], running=["v"], moving=["v"], ranges=5)
    assert got.columns[:len(df.columns)] == df.columns
    for r in got.collect():
        assert [r[n] for n in names] == list(range(100, 100 + len(names)))
    for made in (W.group_mean_beside(df, ["g"], "v", "m"), W.first_last_beside(df, ["g"], "v", [("id", True)], [], "f", "l"),
                 W.running_sum_rows(df, ["g"], [("v", True)], ["id"], "v", frame="range"), Q.impute_median(df, "v"),
                 Q.outlier_flag(df, "v", Q.iqr_bounds(df, "v")), Q.clean_columns(df, "v", "id")):
        assert all([r[n] for n in names] == list(range(100, 100 + len(names))) for r in made.collect())
    with pytest.raises(ValueError):
        rank_within(df.withColumnRenamed("v", "rank"), ["g"], [("id", True)], [], outputs=("rank",))


def _mixed(spark, n=600, seed=11):
    rnd = random.Random(seed)
    words = [None, "", "a", "ab", "Zeta", "émile", "日本", "zz"] + [f"w{i}" for i in range(40)]
    data = []
    for i in range(n):
        s = "hot" if rnd.random() < 0.4 else rnd.choice(words)
        data.append(("g" if rnd.random() < 0.7 else f"g{i % 9}", s, rnd.choice([None, True, False]), bytes([i % 7]) * (i % 3),
                     dt.datetime(2020, 1, 1) + dt.timedelta(hours=i % 50), i))
    return spark.createDataFrame(data, "g string, s string, b boolean, y binary, t timestamp, id int")


@pytest.mark.parametrize("order", [[("s", True)], [("s", False)], [("b", False), ("s", True)], [("y", True), ("t", False)], [("t", False)]])
@pytest.mark.parametrize("offset", [1, 4])
def test_every_order_type_equals_windows(spark, order, offset):
    df = _mixed(spark)
    outputs = ("row_number", "rank", "dense_rank")
    got = rank_within(df, ["g"], order, ["id"], outputs=outputs, lag=["id"], lead=["id"], ranges=9, offset=offset)
    cols = ["id", *outputs, "prev_id", "next_id"]
    assert _rows(got, cols) == _rows(_ref(df, ["g"], order, ["id"], offset), cols)


def test_a_hot_group_ordered_by_a_string_is_cut(spark):
    df = _mixed(spark, n=6000)
    most = _cells(df, ["g"], [("s", True), ("id", True)], 12).groupBy("g", "_pos").count().agg(F.max("count")).first()[0]
    assert most < 2 * 6000 / 12


@pytest.mark.parametrize("offset", [1, 2, 7, 20, 50])
def test_neighbours_over_cells_shorter_than_the_offset(spark, offset):
    rnd = random.Random(offset)
    df = spark.createDataFrame([(rnd.choice("aaab"), rnd.choice([None, *range(30)]), i, rnd.choice([None, i])) for i in range(400)],
                               "g string, v int, id int, x int")
    got = rank_within(df, ["g"], [("v", True)], ["id"], outputs=(), lag=["x", "id"], lead=["x"], ranges=60, offset=offset)
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.select("id", F.lag("x", offset).over(w).alias("prev_x"), F.lag("id", offset).over(w).alias("prev_id"),
                    F.lead("x", offset).over(w).alias("next_x"))
    assert _rows(got, ref.columns) == _rows(ref, ref.columns)


@pytest.mark.parametrize("kind", ["int", "double", "decimal(12,3)"])
@pytest.mark.parametrize("rows", [1, 3, 7, 40])
def test_frames_over_raw_rows_equal_windows(spark, kind, rows):
    rnd = random.Random(rows)
    data = [("hot" if i % 3 else f"g{i % 4}", i % 11, i, rnd.choice([None, -5, 3, 8, -40])) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, id int, x int").withColumn("x", F.col("x").cast(kind))
    got = rank_within(df, ["g"], [("k", False)], ["id"], outputs=("row_number",), running=["x"], moving=["x"], rows=rows, ranges=40)
    w = Window.partitionBy("g").orderBy(F.desc("k"), "id")
    ref = df.select("id", F.row_number().over(w).alias("row_number"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("sum_x"),
                    F.round(F.avg(F.col("x").cast("double")).over(w.rowsBetween(1 - rows, 0)), 9).alias("mean_x"))
    got = got.select("id", "row_number", F.col("sum_x").cast("double").alias("sum_x"), F.round("mean_x", 9).alias("mean_x"))
    assert _rows(got, ref.columns) == _rows(ref, ref.columns)
    peers = W.running_sum_rows(df, ["g"], [("k", False)], [], "x", name="r", frame="range")
    wr = Window.partitionBy("g").orderBy(F.desc("k")).rangeBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("x").over(wr).cast("double").alias("r"))
    assert _rows(peers.select("id", F.col("r").cast("double").alias("r")), ["id", "r"]) == _rows(ref, ["id", "r"])


def test_first_last_of_descending_dates_and_strings(spark):
    df = _mixed(spark, n=300)
    for order in ([("t", False)], [("s", False), ("t", True)], [("s", True), ("b", False)]):
        sort = [F.col(c).asc() if a else F.col(c).desc() for c, a in order]
        w = Window.partitionBy("g").orderBy(*sort, "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ref = df.select("id", F.first("s").over(w).alias("f"), F.last("s").over(w).alias("l"))
        got = W.first_last_beside(df, ["g"], "s", order, ["id"], "f", "l")
        assert _rows(got, ref.columns) == _rows(ref, ref.columns)


def _quantile_columns():
    r = np.random.default_rng(4)
    return {"continuous": r.normal(size=20_000), "constant": np.full(9_000, 3.5),
            "hot": np.where(r.random(20_000) < 0.6, 7.0, r.normal(size=20_000) * 100), "two": np.repeat([1.0, 2.0], 5_000),
            "few": np.array([5.0, 1.0, 4.0]), "long": (r.integers(0, 10**6, 15_000) ** 2).astype(float), "one": np.array([2.0])}


@pytest.mark.parametrize("name", _quantile_columns())
def test_bracketed_quantiles_equal_numpy(spark, name):
    x = _quantile_columns()[name]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 5, "x double")
    probs = {"lo": 0.0, "p1": 0.01, "q1": 0.25, "m": 0.5, "m2": 0.5005, "q3": 0.75, "p99": 0.99, "hi": 1.0}
    (got,) = A.exact_quantiles(df, "x", probs, also={"mean": F.avg("x"), "n": F.count("x")}).collect()
    assert np.allclose([got[p] for p in probs], np.quantile(x, list(probs.values())), rtol=1e-12)
    assert got["n"] == len(x) and abs(got["mean"] - x.mean()) <= 1e-9 * max(1, abs(x.mean()))


def test_bracketed_quantiles_by_group_and_column(spark):
    cols = _quantile_columns()
    df = spark.createDataFrame([(n, float(v)) for n, x in cols.items() for v in x] + [(None, 1.0), ("none", None)], "g string, x double")
    got = {r["g"]: (r["a"], r["b"]) for r in A.exact_quantiles(df, "x", {"a": 0.3, "b": 0.9}, by=["g"]).collect()}
    assert set(got) == {*cols, None}
    for n, x in cols.items():
        assert np.allclose(got[n], np.quantile(x, [0.3, 0.9]), rtol=1e-12)
    nan = spark.createDataFrame([(float("nan"),)] * 3 + [(float("inf"),)] + [(float(i),) for i in range(6)], "x double")
    (r,) = A.exact_quantiles(nan, "x", {"m": 4 / 9, "top": 1.0}).collect()
    assert r["m"] == 4.0 and np.isnan(r["top"])
    wide = spark.createDataFrame([(i, None if i % 3 else i * 2.0, i % 5) for i in range(9000)], "a int, b double, c long")
    by = {r["column"]: r for r in A.column_quantiles(wide, ["a", "b", "c"], {"m": 0.5},
                                                     {c: {"n": F.count(c)} for c in "abc"}).collect()}
    assert (by["a"]["m"], by["b"]["m"], by["c"]["m"], by["b"]["n"]) == (4499.5, 8997.0, 2.0, 3000)
    empty = A.column_quantiles(wide.limit(0), ["a", "b"], {"m": 0.5}).collect()
    assert [(r["column"], r["m"]) for r in sorted(empty)] == [("a", None), ("b", None)]


def test_cleaning_two_columns_equals_one_at_a_time(spark):
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, rnd.choice([None, 1, 2, 9]), rnd.choice([None, *range(20), 500])) for i in range(700)], "id int, d int, a int")
    one = Q.outlier_flag(Q.impute_median(df, "d"), "a", Q.iqr_bounds(df, "a"))
    assert _rows(Q.clean_columns(df, "d", "a"), one.columns) == _rows(one, one.columns)


def test_box_stats_with_weights(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice("ab"), rnd.choice([1, 2, 3, 50, -40]), rnd.randrange(1, 6)) for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    each = df.select("g", "v", F.explode(F.sequence(F.lit(1), "n")))
    a, b = C.box_stats(df, "v", "g", weight="n"), C.box_stats(each, "v", "g")
    assert _rows(a, b.columns) == _rows(b, b.columns)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_a_hot_key(spark, how):
    rows = [(7 if i % 3 else i % 50, i) for i in range(3000)] + [(None, -1)]
    fact = spark.createDataFrame(rows, "dest int, id int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(40)] + [(7, "again"), (None, "null")], "faa int, name string")
    got = J.join_salted(fact, dim, "dest", "faa", how, salts=5)
    ref = fact.join(dim, F.col("dest") == F.col("faa"), how)
    assert _rows(got, ["dest", "id", "name"]) == _rows(ref, ["dest", "id", "name"])
    same = J.join_salted(fact, dim.withColumnRenamed("faa", "dest"), "dest", "dest", how, salts=5)
    assert same.columns == ["dest", "id", "name"] and _rows(same, same.columns) == _rows(ref, same.columns)
    parts = J.join_salted(fact, dim, "dest", "faa", how, salts=5)
    assert "Generate explode" in parts._jdf.queryExecution().optimizedPlan().toString()


def _scans(df, table):
    """How often the plan that ran reads a table (a reused exchange is printed without its input)."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    return len(re.findall(rf"FileScan parquet[^\n]*{table}\.parquet", final))


@pytest.mark.parametrize("key, most", [("win_row_number", 1), ("win_rank", 1), ("win_dense_rank", 1), ("win_lag", 1), ("win_lag_5", 1),
                                       ("running_total_rows", 1), ("moving_average_rows", 1), ("mean_vs_median", 2),
                                       ("box_stats", 1), ("dashboard_panels", 1)])
def test_how_often_lineitem_is_read(spark, key, most):
    assert _scans(Q_ALL[key](spark, SMALL), "lineitem") <= most


def test_stored_sketches_answer_any_span(spark, tmp_path):
    from lumen.operators import sketches as SK
    r = np.random.default_rng(3)
    data = [(m, "ab"[i % 2], float(x)) for m in range(6) for i, x in enumerate(r.normal(m, 1 + m, size=4000))]
    data += [(2, "a", None), (2, "b", float("nan"))]
    df = spark.createDataFrame(data, "month int, g string, x double")
    path = f"file://{tmp_path}/sketches"
    SK.save_periods(SK.period_sketches(df.where("month < 5"), "x", "month", ["g"]), path, "month")
    SK.save_periods(SK.period_sketches(df.where("month = 4"), "x", "month", ["g"]), path, "month")  # delivered again
    SK.save_periods(SK.period_sketches(df.where("month = 5"), "x", "month", ["g"]), path, "month")
    stored = SK.read_periods(spark, path)
    probs = {"a": 0.01, "m": 0.5, "z": 0.95}
    for lo, hi in ((0, 5), (2, 3), (4, 4), (1, 5)):
        span = stored.where(F.col("month").between(lo, hi))
        for g in "ab":
            x = np.sort([v for m, k, v in data if lo <= m <= hi and k == g and v is not None and v == v])
            (got,) = SK.span_quantiles(span.where(F.col("g") == g), probs).collect()
            assert got["n"] == len(x)
            for name, p in probs.items():
                below, upto = np.searchsorted(x, got[name], "left") / len(x), np.searchsorted(x, got[name], "right") / len(x)
                assert below - 0.01 <= p <= upto + 0.01
    assert SK.span_quantiles(stored.limit(0), probs, by=["g"]).collect() == []


def test_results_do_not_rest_on_reused_exchanges(spark):
    """Cells are cut by values alone, so plans that evaluate the input again agree."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.exchange.reuse")}
    try:
        for k in was:
            spark.conf.set(k, "false")
        df = _mixed(spark, n=2000).withColumn("id", F.col("id") * 7 % 2003)
        got = rank_within(df, ["g"], [("s", True)], ["id"], outputs=("row_number", "rank", "dense_rank"), lag=["id"], lead=["id"],
                          ranges=9, offset=3)
        ref = _ref(df, ["g"], [("s", True)], ["id"], 3)
        cols = ["id", "row_number", "rank", "dense_rank", "prev_id", "next_id"]
        assert "ReusedExchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert _rows(got, cols) == _rows(ref, cols)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_verified_top_k(spark):
    rnd = random.Random(5)
    skewed = [int(rnd.paretovariate(0.7)) % 50_000 for _ in range(20_000)]
    flat = list(range(15_000)) * 2
    tied = [i % 40 for i in range(4_000)] + [None] * 500
    few = [1, 1, 2]
    for data, k in ((skewed, 7), (flat, 5), (tied, 6), (few, 4), ([], 3)):
        df = spark.createDataFrame([(x,) for x in data], "key int")
        got = [(r["key"], r["count"]) for r in J.top_k_verified(df, "key", k).collect()]
        counts = {}
        for x in data:
            if x is not None:
                counts[x] = counts.get(x, 0) + 1
        assert sorted(got) == sorted(sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k])


def test_a_proved_top_k_does_not_count_all_keys(spark):
    df = Q_ALL["value_counts_top"](spark, SMALL)
    assert _scans(df, "lineitem") <= 2
