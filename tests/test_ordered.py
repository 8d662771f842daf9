"""rank_within / exact_quantiles against Spark's own windows and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumen.operators.aggregates import exact_quantiles
from lumen.operators.ordered import ntile_from_rank, rank_within


def _frame(spark, n=400, groups=("a", "b", "c", None), seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        g = rnd.choice(groups)
        if rnd.random() < 0.5:
            g = groups[0]                  # one hot group holding about half the rows
        v = rnd.choice([None, 1, 2, 2, 3, 5, 5, 5, 8])
        data.append((g, v, i))
    return spark.createDataFrame(data, "g string, v int, id int")


@pytest.mark.parametrize("parts", [2, 3, 16])
@pytest.mark.parametrize("asc", [True, False])
def test_matches_windows(spark, parts, asc):
    df = _frame(spark)
    r = rank_within(df, ["g"], [("v", asc)], ["id"],
                    outputs=("row_number", "rank", "dense_rank", "group_size"),
                    lag=["v"], lead=["id"], ranges=parts)
    o = F.col("v").asc() if asc else F.col("v").desc()
    w = Window.partitionBy("g").orderBy(o, "id")
    wr = Window.partitionBy("g").orderBy(o)
    ref = df.select("g", "v", "id", F.row_number().over(w).alias("row_number"),
                    F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_size"),
                    F.lag("v").over(w).alias("prev_v"), F.lead("id").over(w).alias("next_id"))
    cols = ["g", "v", "id", "row_number", "rank", "dense_rank", "group_size", "prev_v", "next_id"]
    got = sorted((tuple(x) for x in r.select(*cols).collect()), key=repr)
    exp = sorted((tuple(x) for x in ref.select(*cols).collect()), key=repr)
    assert got == exp


def test_no_groups_and_ties_rank(spark):
    df = spark.createDataFrame([("x", 10, 1), ("x", 10, 2), ("x", 7, 3), ("y", 10, 4)], "g string, k int, id int")
    r = rank_within(df, [], [("k", False)], ["id"], outputs=("row_number", "rank", "dense_rank"),
                    ranges=3)
    got = sorted((x.id, x.row_number, x.rank, x.dense_rank) for x in r.collect())
    assert got == [(1, 1, 1, 1), (2, 2, 1, 1), (3, 4, 4, 2), (4, 3, 1, 1)]


def test_ntile_matches_spark(spark):
    df = _frame(spark, n=301)
    r = rank_within(df, ["g"], [("v", True)], ["id"], outputs=("row_number", "group_size"))
    r = r.withColumn("nt", ntile_from_rank("row_number", "group_size", 4))
    ref = df.withColumn("nt", F.ntile(4).over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted((tuple(x) for x in r.select("id", "nt").collect()), key=repr) == \
        sorted((tuple(x) for x in ref.select("id", "nt").collect()), key=repr)


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("pq"), float(rnd.randint(-50, 50)) if rnd.random() > 0.1 else None) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: (r.q1, r.med, r.q3) for r in
           exact_quantiles(df, "x", {"q1": 0.25, "med": 0.5, "q3": 0.75}, by=["g"]).collect()}
    for g in "pq":
        xs = np.array([x for k, x in data if k == g and x is not None])
        exp = np.quantile(xs, [0.25, 0.5, 0.75])  # linear interpolation
        assert np.allclose(got[g], exp)


def test_weighted_single_value_hot_group(spark):
    # one value repeated many times: compressed to a single weighted row
    df = spark.createDataFrame([(1.0,)] * 1000 + [(2.0,), (3.0,)], "x double")
    (r,) = exact_quantiles(df, "x", {"med": 0.5, "top": 1.0}).collect()
    assert r.med == 1.0 and r.top == 3.0


def test_hot_group_and_hot_value_are_cut(spark):
    """No cell holds much more than its share of a hot group or of a hot value in it."""
    from lumen.operators.ordered import _cells
    n = 6000
    data = [("hot" if i % 10 < 7 else f"g{i % 10}", 5 if i % 3 else i % 97, i) for i in range(n)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    cells = _cells(df, ["g"], [("v", False), ("id", True)], 12).groupBy("g", "_pos", "_sub").count()
    assert cells.agg(F.max("count")).first()[0] < 2 * n / 12
    got = rank_within(df, ["g"], [("v", False)], ["id"], outputs=("row_number", "dense_rank"), ranges=12)
    hot = got.where(F.col("g") == "hot").agg(F.max("row_number").alias("m"), F.max("dense_rank").alias("d")).first()
    assert hot.m == 4200 and hot.d == df.where("g = 'hot'").select("v").distinct().count()


@pytest.mark.parametrize("asc", [True, False])
def test_nan_null_and_wide_integers_pass_unchanged(spark, asc):
    nan, wide = float("nan"), 9007199254740995
    vals = [nan, None, 1.5, nan, -0.5, None, 1.5, float("inf")] * 6
    df = spark.createDataFrame([("a", v, i, None if i % 5 == 0 else wide + i) for i, v in enumerate(vals)],
                               "g string, v double, id int, big long")
    o = F.col("v").asc() if asc else F.col("v").desc()
    w, wr = Window.partitionBy("g").orderBy(o, "id"), Window.partitionBy("g").orderBy(o)
    ref = df.select("id", "v", "big", F.row_number().over(w).alias("row_number"), F.rank().over(wr).alias("rank"),
                    F.dense_rank().over(wr).alias("dense_rank"), F.lag("big").over(w).alias("prev_big"),
                    F.lead("v").over(w).alias("next_v"))
    got = rank_within(df, ["g"], [("v", asc)], ["id"], outputs=("row_number", "rank", "dense_rank"), lag=["big"],
                      lead=["v"], ranges=4).select(*ref.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, ref.collect()))


def test_several_order_columns_dates_and_strings(spark):
    import datetime as dt
    data = [("a", dt.date(2020, 1, 1 + i % 3), i % 4, f"s{i % 5}", i) for i in range(200)]
    df = spark.createDataFrame(data, "g string, d date, k int, s string, id int")
    for order in ([("d", True), ("k", False)], [("s", False)], [("d", False), ("s", True)]):
        sort = [F.col(c).asc() if a else F.col(c).desc() for c, a in order]
        w, wr = Window.partitionBy("g").orderBy(*sort, "id"), Window.partitionBy("g").orderBy(*sort)
        ref = df.select("id", F.row_number().over(w).alias("row_number"), F.rank().over(wr).alias("rank"),
                        F.dense_rank().over(wr).alias("dense_rank"), F.lag("id").over(w).alias("prev_id"))
        got = rank_within(df, ["g"], order, ["id"], outputs=("row_number", "rank", "dense_rank"), lag=["id"], ranges=5)
        assert sorted(map(tuple, got.select(*ref.columns).collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)


@pytest.mark.parametrize("asc", [True, False])
def test_value_ranks_match_windows(spark, asc):
    from lumen.operators import windows as W
    df = _frame(spark, n=300)
    r = W.value_ranks(df, ["g"], "v", asc, ["id"])
    o = F.col("v").asc() if asc else F.col("v").desc()
    wr = Window.partitionBy("g").orderBy(o)
    ref = df.select("g", "v", "id", F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"))
    cols = ["g", "v", "id", "rank", "dense_rank"]
    got = sorted((tuple(x) for x in r.select(*cols).collect()), key=repr)
    exp = sorted((tuple(x) for x in ref.select(*cols).collect()), key=repr)
    assert got == exp



@pytest.mark.parametrize("asc", [True, False])
def test_row_numbers_match_windows(spark, asc):
    from lumen.operators import windows as W
    df = _frame(spark, n=300)
    r = W.row_numbers(df, ["g"], "v", asc, ["id"], outputs=("row_number", "group_size"))
    o = F.col("v").asc() if asc else F.col("v").desc()
    ref = df.select("g", "v", "id",
                    F.row_number().over(Window.partitionBy("g").orderBy(o, "id")).alias("row_number"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_size"))
    cols = ["g", "v", "id", "row_number", "group_size"]
    got = sorted((tuple(x) for x in r.select(*cols).collect()), key=repr)
    exp = sorted((tuple(x) for x in ref.select(*cols).collect()), key=repr)
    assert got == exp


@pytest.mark.parametrize("asc", [True, False])
def test_lag_lead_match_windows(spark, asc):
    from lumen.operators import windows as W
    df = _frame(spark, n=300)
    r = W.lag_lead(df, ["g"], [("v", asc)], ["id"], lag=["id", "v"], lead=["id"])
    o = F.col("v").asc() if asc else F.col("v").desc()
    w = Window.partitionBy("g").orderBy(o, "id")
    ref = df.select("g", "v", "id", F.lag("id").over(w).alias("prev_id"), F.lag("v").over(w).alias("prev_v"),
                    F.lead("id").over(w).alias("next_id"))
    cols = ["g", "v", "id", "prev_id", "prev_v", "next_id"]
    got = sorted((tuple(x) for x in r.select(*cols).collect()), key=repr)
    exp = sorted((tuple(x) for x in ref.select(*cols).collect()), key=repr)
    assert got == exp
