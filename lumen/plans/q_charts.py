"""Chart data preparation queries (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumen.functions import expressions as X
from lumen.operators import chartprep as C
from lumen.plans import roles as R
from lumen.plans.oracle_roles import (AIRLINES, DIAMONDS, IRIS, SUPPLIER_AIRLINE, TRIPS, USARRESTS, with_)
from lumen.plans.q_basic import CUT_LEVELS, _levels_sql, trips_with_airline
from lumen.plans.registry import query

_AIRLINE_JOIN = ("FROM trips f JOIN supplier_airline s ON f.dest = s.dest "
                 "JOIN airlines a ON s.carrier_code = a.carrier_code WHERE f.arr_delay IS NOT NULL")


@query("chart_bar", with_(TRIPS) + "SELECT carrier, count(*) AS flight_count FROM trips GROUP BY carrier")
def chart_bar(spark, sf):
    return C.bar_values(R.trips(spark, sf), "carrier", {"flight_count": F.count(F.lit(1))}, "flight_count")


@query("chart_bar_colored", with_(TRIPS, SUPPLIER_AIRLINE, AIRLINES) +
       "SELECT a.name, count(*) AS flights, round(avg(f.arr_delay), 1) AS avg_delay " + _AIRLINE_JOIN +
       " GROUP BY a.name")
def chart_bar_colored(spark, sf):
    t = trips_with_airline(spark, sf).where(F.col("arr_delay").isNotNull())
    return C.bar_values(t, "name", {"flights": F.count(F.lit(1)),
                                    "avg_delay": F.round(F.avg("arr_delay"), 1)}, "flights")


@query("chart_ontime_by_airline", with_(TRIPS, SUPPLIER_AIRLINE, AIRLINES) +
       "SELECT a.name, count(*) AS total_flights, round(100.0 * sum(CASE WHEN f.arr_delay <= 0 THEN 1 ELSE 0 END) "
       "/ count(*), 1) AS ontime_pct " + _AIRLINE_JOIN + " GROUP BY a.name")
def chart_ontime_by_airline(spark, sf):
    t = trips_with_airline(spark, sf).where(F.col("arr_delay").isNotNull())
    return C.bar_values(t, "name", {"total_flights": F.count(F.lit(1)),
                                    "ontime_pct": F.round(X.rate_where(F.col("arr_delay") <= 0), 1)},
                        "ontime_pct", ascending=True)


@query("chart_error_bar", with_(DIAMONDS) +
       f"SELECT cut, round(avg(price / carat), 4) AS avg_ppc, round(stddev_samp(price / carat), 4) AS std_ppc, "
       f"{_levels_sql('cut', CUT_LEVELS)} AS level_order FROM diamonds GROUP BY cut")
def chart_error_bar(spark, sf):
    d = R.diamonds(spark, sf).withColumn("_ppc", X.safe_ratio("price", "carat"))
    return C.ordered_category_stats(d, "cut", CUT_LEVELS, {"avg_ppc": F.round(F.avg("_ppc"), 4),
                                                           "std_ppc": F.round(F.stddev_samp("_ppc"), 4)})


@query("chart_line", with_(TRIPS) +
       "SELECT month, round(avg(dep_delay), 4) AS avg_dep_delay, round(avg(arr_delay), 4) AS avg_arr_delay "
       "FROM trips WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL GROUP BY month")
def chart_line(spark, sf):
    t = R.trips(spark, sf).where(F.col("dep_delay").isNotNull() & F.col("arr_delay").isNotNull())
    return t.groupBy("month").agg(F.round(F.avg("dep_delay"), 4).alias("avg_dep_delay"),
                                  F.round(F.avg("arr_delay"), 4).alias("avg_arr_delay")).orderBy("month")


@query("chart_line_by_series", with_(TRIPS) +
       "SELECT carrier, month, round(avg(arr_delay), 1) AS avg_delay FROM trips WHERE arr_delay IS NOT NULL "
       "GROUP BY carrier, month")
def chart_line_by_series(spark, sf):
    t = R.trips(spark, sf).where(F.col("arr_delay").isNotNull())
    return t.groupBy("carrier", "month").agg(F.round(F.avg("arr_delay"), 1).alias("avg_delay")).orderBy(
        "carrier", "month")


def _hist_sql(src: str, value: str, bins: int, where: str = "") -> str:
    return (f", d AS (SELECT CAST({value} AS DOUBLE) AS x FROM {src} WHERE {value} IS NOT NULL {where}), "
            f"st AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM d), "
            f"b AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), {bins - 1}) END AS INTEGER) "
            f"AS bin FROM d, st), c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin) "
            f"SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_start, lo + (g.bin + 1) * w AS bin_end, "
            f"coalesce(c.n, 0) AS count FROM st, range(0, {bins}) g(bin) LEFT JOIN c ON c.bin = g.bin "
            f"WHERE st.lo IS NOT NULL")


@query("histogram", "WITH " + DIAMONDS + _hist_sql("diamonds", "price", 50))
def histogram(spark, sf):
    return C.histogram(R.diamonds(spark, sf), "price", 50)


@query("histogram_filtered", "WITH " + TRIPS + _hist_sql("trips", "dep_delay", 40,
                                                        "AND dep_delay BETWEEN -60 AND 120"))
def histogram_filtered(spark, sf):
    return C.histogram(R.trips(spark, sf, with_orders=False), "dep_delay", 40, lo=-60, hi=120)


@query("histogram_by_group", with_(DIAMONDS) +
       ", d AS (SELECT cut, CAST(price AS DOUBLE) AS x FROM diamonds WHERE price IS NOT NULL), "
       "st AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM d), "
       "b AS (SELECT cut, lo, w, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), 49) END AS INTEGER) AS bin "
       "FROM d, st) SELECT cut, bin, count(*) AS count, min(lo + bin * w) AS bin_start FROM b GROUP BY cut, bin")
def histogram_by_group(spark, sf):
    return C.histogram_by_group(R.diamonds(spark, sf), "price", "cut", 50)


def _box_sql(src_cte: str, src: str, value: str, group: str, where: str = "") -> str:
    return (with_(*src_cte) +
            f", d AS (SELECT {group} AS g, {value} AS v FROM {src} WHERE {value} IS NOT NULL AND {group} IS NOT NULL "
            f"{where}), q AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
            f"quantile_cont(v, 0.75) AS q3 FROM d GROUP BY g), j AS (SELECT d.g, d.v, q.q1, q.median, q.q3, "
            f"q.q1 - 1.5 * (q.q3 - q.q1) AS lf, q.q3 + 1.5 * (q.q3 - q.q1) AS uf FROM d JOIN q USING (g)) "
            f"SELECT g AS {group}, count(*) AS n, min(q1) AS q1, min(median) AS median, min(q3) AS q3, "
            f"CAST(min(CASE WHEN v >= lf AND v <= uf THEN v END) AS DOUBLE) AS whisker_low, "
            f"CAST(max(CASE WHEN v >= lf AND v <= uf THEN v END) AS DOUBLE) AS whisker_high, "
            f"CAST(count_if(NOT (v >= lf AND v <= uf)) AS BIGINT) AS outliers FROM j GROUP BY g")


def _round_box(df):
    return df.select(df.columns[0], "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                     "whisker_low", "whisker_high", "outliers")


def _round_box_sql(sql: str, group: str) -> str:
    return (f"SELECT {group}, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
            f"whisker_low, whisker_high, outliers FROM ({sql})")


@query("box_stats", _round_box_sql(_box_sql([TRIPS], "trips", "arr_delay", "carrier",
                                            "AND arr_delay BETWEEN -60 AND 120"), "carrier"))
def box_stats(spark, sf):
    """Arrival-delay box statistics per carrier, range-filtered as the reference does."""
    return _round_box(C.box_stats(R.trips(spark, sf), "arr_delay", "carrier", lo=-60, hi=120))


@query("box_stats_topk", _round_box_sql(_box_sql(
    [DIAMONDS], "diamonds", "price", "color",
    "AND color IN (SELECT color FROM diamonds GROUP BY color ORDER BY count(*) DESC, color LIMIT 5)"), "color"))
def box_stats_topk(spark, sf):
    """Price box statistics for the five most frequent colors."""
    return _round_box(C.box_stats_topk(R.diamonds(spark, sf), "price", "color", 5))


@query("violin_density", with_(DIAMONDS) +
       ", d AS (SELECT cut, price FROM diamonds WHERE price IS NOT NULL AND cut IS NOT NULL), "
       "st AS (SELECT cut, count(*) AS n, stddev_samp(price) * pow(count(*), -0.2) AS bw, min(price) AS mn, "
       "max(price) AS mx FROM d GROUP BY cut), st2 AS (SELECT cut, n, bw, mn - 2.0 * bw AS g0, "
       "(mx - mn + 2 * 2.0 * bw) / 99 AS step FROM st), grid AS (SELECT cut, n, bw, g0, step, p FROM st2, "
       "range(0, 100) r(p)) SELECT grid.cut, CAST(p AS INTEGER) AS point, round(g0 + p * step, 9) AS x, "
       "round(sum(exp(-0.5 * ((g0 + p * step - d.price) / bw) * ((g0 + p * step - d.price) / bw))) "
       "* (1.0 / sqrt(2 * pi())) / (n * bw), 9) AS density FROM grid JOIN d ON grid.cut = d.cut "
       "GROUP BY grid.cut, p, n, bw, g0, step")
def violin_density(spark, sf):
    return C.violin_density(R.diamonds(spark, sf), "price", "cut")


# Heatmap columns (months).
MONTHS = list(range(1, 13))


@query("heatmap_matrix", with_(TRIPS, SUPPLIER_AIRLINE, AIRLINES) +
       ", h AS (SELECT a.name AS airline, f.month, round(avg(f.arr_delay), 1) AS avg_delay " + _AIRLINE_JOIN +
       " GROUP BY a.name, f.month) SELECT airline, " +
       ", ".join(f"avg(CASE WHEN month = {m} THEN avg_delay END) AS \"{m}\"" for m in MONTHS) +
       " FROM h GROUP BY airline")
def heatmap_matrix(spark, sf):
    """Rounded mean delay per (airline, month), pivoted to an airline × month matrix."""
    t = trips_with_airline(spark, sf).where(F.col("arr_delay").isNotNull())
    cells = t.groupBy(F.col("name").alias("airline"), "month").agg(
        F.round(F.avg("arr_delay"), 1).alias("avg_delay"))
    return cells.groupBy("airline").pivot("month", MONTHS).agg(F.avg("avg_delay"))


@query("count_plot", with_(DIAMONDS) +
       ", lv AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(CUT_LEVELS, 1)) +
       ") t(level_order, cut)) SELECT CAST(lv.level_order AS INTEGER) AS level_order, lv.cut, "
       "count(d.cut) AS count FROM lv LEFT JOIN diamonds d ON d.cut = lv.cut GROUP BY lv.level_order, lv.cut")
def count_plot(spark, sf):
    return C.count_plot(R.diamonds(spark, sf), "cut", CUT_LEVELS)


def _pair_sql() -> str:
    cols = R.IRIS_MEASURES
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    bins = 10

    def b(c):
        return (f"CAST(CASE WHEN ({c}_hi - {c}_lo) = 0 THEN 0 ELSE least(floor(({c} - {c}_lo) / "
                f"(({c}_hi - {c}_lo) / {bins})), {bins - 1}) END AS INTEGER)")
    st = ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}_lo, CAST(max({c}) AS DOUBLE) AS {c}_hi" for c in cols)
    parts = []
    for a, c in pairs:
        yb = b(c) if a != c else "CAST(NULL AS INTEGER)"
        parts.append(f"SELECT '{a}' AS x_dim, '{c}' AS y_dim, species, {b(a)} AS x_bin, {yb} AS y_bin "
                     f"FROM iris, st WHERE {a} IS NOT NULL")
    return (with_(IRIS) + f", st AS (SELECT {st} FROM iris), cells AS ({' UNION ALL '.join(parts)}) "
            "SELECT x_dim, y_dim, species, x_bin, y_bin, count(*) AS count FROM cells "
            "GROUP BY x_dim, y_dim, species, x_bin, y_bin")


@query("pair_grid", _pair_sql())
def pair_grid(spark, sf):
    return C.pair_grid(R.iris(spark, sf), R.IRIS_MEASURES, "species", bins=10)


@query("scatter_points", with_(DIAMONDS) +
       "SELECT carat AS x, price AS y, cut AS color, carat AS size, clarity, color AS diamond_color FROM diamonds")
def scatter_points(spark, sf):
    d = R.diamonds(spark, sf).withColumnRenamed("color", "diamond_color")
    return C.scatter_points(d, "carat", "price", color="cut", size="carat", hover=["clarity", "diamond_color"])


@query("scatter_binned", with_(DIAMONDS) +
       ", st AS (SELECT CAST(min(carat) AS DOUBLE) AS xl, (CAST(max(carat) AS DOUBLE) - min(carat)) / 20 AS xw, "
       "min(price) AS yl, (max(price) - min(price)) / 20 AS yw FROM diamonds) "
       "SELECT cut, CAST(CASE WHEN xw = 0 THEN 0 ELSE least(floor((carat - xl) / xw), 19) END AS INTEGER) AS x_bin, "
       "CAST(CASE WHEN yw = 0 THEN 0 ELSE least(floor((price - yl) / yw), 19) END AS INTEGER) AS y_bin, "
       "count(*) AS count FROM diamonds, st WHERE carat IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2, 3")
def scatter_binned(spark, sf):
    return C.binned_2d(R.diamonds(spark, sf), "carat", "price", 20, by=["cut"])


@query("dashboard_panels", with_(TRIPS) +
       ", carriers AS (SELECT carrier, count(*) AS n FROM trips WHERE carrier IS NOT NULL GROUP BY carrier), "
       "top5 AS (SELECT carrier FROM carriers ORDER BY n DESC, carrier LIMIT 5), "
       "d AS (SELECT CAST(dep_delay AS DOUBLE) AS x FROM trips WHERE dep_delay BETWEEN -60 AND 120), "
       "st AS (SELECT min(x) AS lo, (max(x) - min(x)) / 40 AS w FROM d), "
       "hb AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), 39) END AS INTEGER) AS bin "
       "FROM d, st), "
       "bx AS (SELECT carrier AS g, arr_delay AS v FROM trips WHERE arr_delay IS NOT NULL AND carrier IN "
       "(SELECT carrier FROM top5)), bq AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, "
       "quantile_cont(v, 0.75) AS q3 FROM bx GROUP BY g), "
       "bw AS (SELECT bx.g, any_value(q1) AS q1, any_value(med) AS med, any_value(q3) AS q3, "
       "min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS lo, "
       "max(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS hi, "
       "count(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outs "
       "FROM bx JOIN bq ON bx.g = bq.g GROUP BY bx.g) "
       "SELECT 'flights_per_carrier' AS panel, carrier AS label, CAST(n AS DOUBLE) AS value FROM carriers "
       "UNION ALL SELECT 'mean_dep_delay_by_month', CAST(month AS VARCHAR), round(avg(dep_delay), 6) FROM trips "
       "WHERE month IS NOT NULL GROUP BY month "
       "UNION ALL SELECT 'dep_delay_histogram', CAST(bin AS VARCHAR), CAST(count(*) AS DOUBLE) FROM hb GROUP BY bin "
       "UNION ALL SELECT 'arr_delay_q1_top5', g, round(q1, 6) FROM bw "
       "UNION ALL SELECT 'arr_delay_median_top5', g, round(med, 6) FROM bw "
       "UNION ALL SELECT 'arr_delay_q3_top5', g, round(q3, 6) FROM bw "
       "UNION ALL SELECT 'arr_delay_whisker_low_top5', g, CAST(lo AS DOUBLE) FROM bw "
       "UNION ALL SELECT 'arr_delay_whisker_high_top5', g, CAST(hi AS DOUBLE) FROM bw "
       "UNION ALL SELECT 'arr_delay_outliers_top5', g, CAST(outs AS DOUBLE) FROM bw")
def dashboard_panels(spark, sf):
    """The four dashboard panels, tagged and unioned (tidy long form): one table of
    counts by carrier, month and the two delays feeds them all, so the fact is read
    once and its rows are shuffled only as counts."""
    joint = C.joint_counts(R.trips(spark, sf), ["carrier", "month", "dep_delay", "arr_delay"], "n")
    per = joint.where("carrier IS NOT NULL").groupBy("carrier").agg(F.sum("n").alias("n"))
    p1 = per.select(F.lit("flights_per_carrier").alias("panel"), F.col("carrier").alias("label"),
                    F.col("n").cast("double").alias("value"))
    mean = F.try_divide(F.sum(F.col("dep_delay") * F.col("n")).cast("double"),
                        F.sum(F.when(F.col("dep_delay").isNotNull(), F.col("n"))).cast("double"))
    p2 = joint.where("month IS NOT NULL").groupBy("month").agg(mean.alias("m")).select(
        F.lit("mean_dep_delay_by_month").alias("panel"), F.col("month").cast("string").alias("label"),
        F.round("m", 6).alias("value"))
    h = C.histogram(joint, "dep_delay", 40, lo=-60, hi=120, weight="n").where(F.col("count") > 0)
    p3 = h.select(F.lit("dep_delay_histogram").alias("panel"), F.col("bin").cast("string").alias("label"),
                  F.col("count").cast("double").alias("value"))
    top5 = per.orderBy(F.desc("n"), "carrier").limit(5).select("carrier")
    known = joint.where("arr_delay IS NOT NULL").join(F.broadcast(top5), "carrier", "left_semi")
    box = C.box_stats(known, "arr_delay", "carrier", weight="n")
    names = ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
    p4 = box.select(F.col("carrier").alias("label"), F.inline(F.array(*[
        F.struct(F.lit(f"arr_delay_{n}_top5").alias("panel"), F.round(F.col(n).cast("double"), 6).alias("value"))
        for n in names]))).select("panel", "label", "value")
    return p1.unionByName(p2).unionByName(p3).unionByName(p4)


@query("top_states_bar", with_(USARRESTS) +
       "SELECT state, Murder FROM usarrests ORDER BY Murder DESC, state LIMIT 10")
def top_states_bar(spark, sf):
    """Top 10 rows by a measure, labelled by the first column (a bar chart's data)."""
    u = R.usarrests(spark, sf)
    return u.orderBy(F.desc("Murder"), X.first_column(u)).limit(10).select(X.first_column(u), "Murder")


@query("mean_price_by_cut", with_(DIAMONDS) +
       "SELECT cut, round(avg(price), 6) AS price FROM diamonds WHERE cut IS NOT NULL GROUP BY cut")
def mean_price_by_cut(spark, sf):
    """pandas-style ``groupby(cut)[price].mean()`` for a bar chart."""
    from lumen.operators import aggregates as A
    m = A.mean_by(R.diamonds(spark, sf), "cut", "price")
    return m.withColumn("price", F.round("price", 6))



def _pair_diag_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT species, '{c}' AS dim, {c} AS value FROM iris" for c in R.IRIS_MEASURES)
    return (with_(IRIS) +
            f", d AS (SELECT * FROM ({parts}) WHERE value IS NOT NULL AND species IS NOT NULL), "
            "st AS (SELECT dim, species, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS bw, "
            "min(value) AS mn, max(value) AS mx FROM d GROUP BY dim, species), "
            "st2 AS (SELECT dim, species, n, bw, mn - 2.0 * bw AS g0, (mx - mn + 2 * 2.0 * bw) / 99 AS step FROM st), "
            "grid AS (SELECT dim, species, n, bw, g0, step, p FROM st2, range(0, 100) r(p)) "
            "SELECT grid.dim, grid.species, CAST(p AS INTEGER) AS point, round(g0 + p * step, 9) AS x, "
            "round(sum(exp(-0.5 * ((g0 + p * step - d.value) / bw) * ((g0 + p * step - d.value) / bw))) "
            "* (1.0 / sqrt(2 * pi())) / (n * bw), 9) AS density FROM grid JOIN d ON grid.dim = d.dim "
            "AND grid.species = d.species GROUP BY grid.dim, grid.species, p, n, bw, g0, step")


@query("pair_grid_diagonal", _pair_diag_sql())
def pair_grid_diagonal(spark, sf):
    """Pair plot diagonal: per-(column, species) kernel density on a 100-point grid."""
    return C.pair_grid_diagonal(R.iris(spark, sf), R.IRIS_MEASURES, "species")
