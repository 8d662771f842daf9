"""Property test: the skew-safe ordered operators equal Spark's own windows on
random frames (random groups, ties, NULLs, range counts)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumen.operators import windows as W
from lumen.operators.ordered import rank_within

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                             st.one_of(st.none(), st.integers(-3, 3))),
                   min_size=1, max_size=60)


def _df(spark, rows):
    return spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v int, id int")


def _sorted(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, ranges=st.integers(2, 9), asc=st.booleans())
def test_rank_within_equals_windows(spark, rows, ranges, asc):
    df = _df(spark, rows)
    o = F.col("v").asc() if asc else F.col("v").desc()
    w = Window.partitionBy("g").orderBy(o, "id")
    wr = Window.partitionBy("g").orderBy(o)
    ref = df.select("g", "v", "id", F.row_number().over(w).alias("row_number"),
                    F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"),
                    F.lag("v").over(w).alias("prev_v"), F.lead("id").over(w).alias("next_id"))
    got = rank_within(df, ["g"], [("v", asc)], ["id"], outputs=("row_number", "rank", "dense_rank"),
                      lag=["v"], lead=["id"], ranges=ranges)
    cols = ["g", "v", "id", "row_number", "rank", "dense_rank", "prev_v", "next_id"]
    assert _sorted(got, cols) == _sorted(ref, cols)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, asc=st.booleans())
def test_row_numbers_and_lag_lead_equal_windows(spark, rows, asc):
    df = _df(spark, rows)
    o = F.col("v").asc() if asc else F.col("v").desc()
    w = Window.partitionBy("g").orderBy(o, "id")
    ref = df.select("g", "v", "id", F.row_number().over(w).alias("row_number"),
                    F.lag("id").over(w).alias("prev_id"), F.lead("v").over(w).alias("next_v"))
    rn = W.row_numbers(df, ["g"], "v", asc, ["id"])
    ll = W.lag_lead(df, ["g"], [("v", asc)], ["id"], lag=["id"], lead=["v"])
    got = rn.join(ll.select("id", "prev_id", "next_v"), "id")
    cols = ["g", "v", "id", "row_number", "prev_id", "next_v"]
    assert _sorted(got, cols) == _sorted(ref, cols)
