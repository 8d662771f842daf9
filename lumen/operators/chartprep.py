"""Chart data preparation.

Drawing happens on one machine; what a chart computes from the rows is a
Spark job.  Each function returns a small tidy DataFrame a charting client
can draw after collecting it.  Per-group statistics are partial aggregates;
grids and bins are generated from one-row (or one-row-per-group) statistics
with ``sequence``/``explode`` — never from a driver-side list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.functions.expressions import level_position
from lumen.operators.joins import attach_scalars, keep_top_k
from lumen.operators.ordered import free_prefix, rank_within, spread


def joint_counts(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Rows counted by ``cols``, spread by all of them: whatever reads the counts
    reads the same exchange, so several panels cost one pass over the rows."""
    return spread(df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name)))


def bar_values(df: DataFrame, category: str, aggs: dict[str, Column],
               sort_by: str, ascending: bool = False) -> DataFrame:
    """One bar per category (one or more measures), sorted by a measure."""
    out = df.groupBy(category).agg(*[c.alias(n) for n, c in aggs.items()])
    key = F.col(sort_by).asc() if ascending else F.col(sort_by).desc()
    return out.orderBy(key, F.col(category))


def ordered_category_stats(df: DataFrame, category: str, levels: Sequence[str],
                           aggs: dict[str, Column], keep_unlisted: bool = True) -> DataFrame:
    """Aggregates per category sorted by a given level order (unlisted last)."""
    out = df.groupBy(category).agg(*[c.alias(n) for n, c in aggs.items()])
    out = out.withColumn("level_order", level_position(category, levels))
    if not keep_unlisted:
        out = out.where(F.col("level_order").isNotNull())
    return out.orderBy(F.col("level_order").asc_nulls_last(), F.col(category))


def count_plot(df: DataFrame, category: str, levels: Sequence[str]) -> DataFrame:
    """Counts for each listed level, in the listed order (absent levels count 0)."""
    counts = (df.where(F.col(category).isin(*levels))
              .groupBy(category).agg(F.count(F.lit(1)).alias("count")))
    lv = (counts.sparkSession.range(1)
          .select(F.posexplode(F.array(*[F.lit(v) for v in levels])).alias("pos", category)))
    return (lv.join(F.broadcast(counts), category, "left")
            .select((F.col("pos") + 1).cast("int").alias("level_order"), category,
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def _bin_expr(x: Column, lo: Column, width: Column, bins: int) -> Column:
    """Equal-width bin of x over [lo, lo + bins·width]; the last bin is closed.
    A zero width (constant column) puts every value in bin 0."""
    raw = F.floor(F.try_divide(x - lo, width))
    return F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, value: str, bins: int, lo: float | None = None,
              hi: float | None = None, weight: str | None = None) -> DataFrame:
    """Equal-width histogram (matplotlib ``hist``): all ``bins`` bins, empty ones 0.

    With ``lo``/``hi`` rows outside the closed range are filtered first.
    ``weight``: a column of counts, for rows that stand for several.
    Output: bin, bin_start, bin_end, count.
    """
    w = F.col(weight) if weight else F.lit(1)
    d = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_x"), w.alias("_w1"))
    if lo is not None:
        d = d.where(F.col("_x") >= lo)
    if hi is not None:
        d = d.where(F.col("_x") <= hi)
    stats = d.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).withColumn(
        "_w", (F.col("_hi") - F.col("_lo")) / bins)
    binned = attach_scalars(d, stats).withColumn(
        "bin", _bin_expr(F.col("_x"), F.col("_lo"), F.col("_w"), bins))
    counts = binned.groupBy("bin").agg(F.sum("_w1").alias("count"))
    grid = stats.where(F.col("_lo").isNotNull()).select(
        "_lo", "_w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def histogram_by_group(df: DataFrame, value: str, group: str, bins: int) -> DataFrame:
    """Counts per (group, bin) over bins shared by all groups (non-empty cells)."""
    d = df.where(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_x"))
    stats = d.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).withColumn(
        "_w", (F.col("_hi") - F.col("_lo")) / bins)
    binned = attach_scalars(d, stats).withColumn(
        "bin", _bin_expr(F.col("_x"), F.col("_lo"), F.col("_w"), bins))
    return binned.groupBy(group, "bin").agg(
        F.count(F.lit(1)).alias("count"),
        F.first(F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"))


def box_stats(df: DataFrame, value: str, group: str, lo: float | None = None,
              hi: float | None = None, whisker: float = 1.5, weight: str | None = None) -> DataFrame:
    """Box-plot statistics per group: Q1, median, Q3 (linear interpolation),
    whiskers at the furthest data within ``whisker``·IQR, outlier count.

    One read: the rows become (group, value, count) with cumulative counts per
    group, and that table answers the quantiles and then the whiskers and
    outliers.  ``weight``: a column of counts, for rows that stand for several.
    """
    d = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    if lo is not None:
        d = d.where(F.col(value) >= lo)
    if hi is not None:
        d = d.where(F.col(value) <= hi)
    p = free_prefix([value, group])
    x, w = F.col(f"{p}x"), F.col(f"{p}w")
    counts = d.groupBy(F.col(group).alias(f"{p}g"), F.col(value).alias(f"{p}x")).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias(f"{p}w"))
    r = rank_within(counts, [f"{p}g"], [(f"{p}x", True)], [], outputs=("row_number", "group_size"), weight=f"{p}w",
                    aggregate=True)
    upto, n = F.col("row_number"), F.col("group_size")
    picks, wanted = [F.first(n).alias("n")], F.lit(False)
    for name, prob in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        h = (n - 1) * F.lit(prob)
        for side, k in (("lo", F.floor(h) + 1), ("hi", F.ceil(h) + 1)):
            here = (upto - w < k) & (k <= upto)
            wanted = wanted | here
            picks.append(F.max(F.when(here, x.cast("double"))).alias(f"{side}_{name}"))
        picks.append(F.max(h - F.floor(h)).alias(f"fr_{name}"))
    q = r.where(wanted).groupBy(F.col(f"{p}g").alias(f"{p}of")).agg(*picks).select(f"{p}of", "n", *[
        (F.col(f"lo_{s}") + F.col(f"fr_{s}") * (F.col(f"hi_{s}") - F.col(f"lo_{s}"))).alias(s) for s in ("q1", "median", "q3")])
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    j = r.select(f"{p}g", f"{p}x", f"{p}w").join(q, F.col(f"{p}g") == F.col(f"{p}of"))
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    return j.groupBy(F.col(f"{p}g").alias(group)).agg(
        F.first("n").alias("n"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, x)).cast("double").alias("whisker_low"),
        F.max(F.when(inside, x)).cast("double").alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(w)).alias("outliers"))


def box_stats_topk(df: DataFrame, value: str, group: str, k: int) -> DataFrame:
    """Box statistics for the k most frequent groups only."""
    return box_stats(keep_top_k(df, group, k), value, group)


def violin_density(df: DataFrame, value: str, group: str | Sequence[str], grid: int = 100,
                   cut: float = 2.0) -> DataFrame:
    """Gaussian kernel density per group on a ``grid``-point support.

    Bandwidth = sample stddev · n^(−1/5) (Scott's rule); the support runs from
    min − cut·bw to max + cut·bw.  Values are compressed to (group, value,
    count); each compressed row is then spread over the grid points inside the
    stage that sums per (group, point) before its shuffle, so grid × value
    pairs are neither stored nor sent.  A constant group (bandwidth 0) gets
    NULL densities.
    """
    gs = [group] if isinstance(group, str) else list(group)
    ok = F.col(value).isNotNull()
    for g in gs:
        ok = ok & F.col(g).isNotNull()
    p = free_prefix(gs, [value])
    d = df.where(ok)
    comp = d.groupBy(*gs, F.col(value).alias(f"{p}x")).agg(F.count(F.lit(1)).alias(f"{p}w"))
    st = d.groupBy(*gs).agg(F.count(F.lit(1)).alias(f"{p}n"), F.stddev_samp(value).alias(f"{p}sd"),
                            F.min(value).alias(f"{p}min"), F.max(value).alias(f"{p}max"))
    bw, least, most = F.col(f"{p}bw"), F.col(f"{p}min"), F.col(f"{p}max")
    st = (st.withColumn(f"{p}bw", F.col(f"{p}sd") * F.pow(F.col(f"{p}n").cast("double"), F.lit(-0.2)))
            .withColumn(f"{p}g0", least - cut * bw)
            .withColumn(f"{p}step", (most - least + 2 * cut * bw) / (grid - 1)))
    at = F.col(f"{p}g0") + F.col("point") * F.col(f"{p}step")
    u = F.try_divide(at - F.col(f"{p}x"), bw)
    sums = (comp.join(st.select(*gs, f"{p}g0", f"{p}step", f"{p}bw"), gs, "inner")
            .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
            .groupBy(*gs, "point").agg(F.sum(F.col(f"{p}w") * F.exp(F.lit(-0.5) * u * u)).alias(f"{p}s")))
    norm = 1.0 / math.sqrt(2 * math.pi)
    return sums.join(st, gs, "inner").select(
        *gs, F.col("point").cast("int").alias("point"),
        F.round(at, 9).alias("x"),
        F.round(F.try_divide(F.col(f"{p}s") * norm, F.col(f"{p}n") * bw), 9).alias("density"))


def scatter_points(df: DataFrame, x: str, y: str, color: str | None = None,
                   size: str | None = None, hover: Sequence[str] = ()) -> DataFrame:
    """The encodings of a scatter plot, every row (a projection)."""
    cols = [F.col(x).alias("x"), F.col(y).alias("y")]
    if color:
        cols.append(F.col(color).alias("color"))
    if size:
        cols.append(F.col(size).alias("size"))
    cols += [F.col(h) for h in hover]
    return df.select(*cols)


def sample_by_key(df: DataFrame, key: str, fraction_tenths: int = 1) -> DataFrame:
    """Reproducible sample of about ``fraction_tenths``/10 of the rows, chosen
    by a hash of ``key`` (same rows on every run and in SQL)."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("int") % 10
    return df.where(h < fraction_tenths)


def binned_2d(df: DataFrame, x: str, y: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """2-D equal-width bin counts (the scalable form of a dense scatter)."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    st = d.agg(F.min("_x").alias("_xl"), F.max("_x").alias("_xh"),
               F.min("_y").alias("_yl"), F.max("_y").alias("_yh"))
    st = (st.withColumn("_xw", (F.col("_xh") - F.col("_xl")) / bins)
            .withColumn("_yw", (F.col("_yh") - F.col("_yl")) / bins))
    j = attach_scalars(d, st)
    return (j.withColumn("x_bin", _bin_expr(F.col("_x"), F.col("_xl"), F.col("_xw"), bins))
             .withColumn("y_bin", _bin_expr(F.col("_y"), F.col("_yl"), F.col("_yw"), bins))
             .groupBy(*by, "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count")))


def pair_grid(df: DataFrame, cols: Sequence[str], hue: str, bins: int = 10) -> DataFrame:
    """Pair-plot data: for each pair of columns (i < j) 2-D bin counts per hue;
    on the diagonal (i = j) 1-D bin counts per hue.  Bins are per column,
    shared by all hues.  Output: x_dim, y_dim, hue, x_bin, y_bin, count
    (y_bin is NULL on the diagonal)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    st = df.agg(*[F.min(c).cast("double").alias(f"_lo_{c}") for c in cols],
                *[F.max(c).cast("double").alias(f"_hi_{c}") for c in cols])
    j = attach_scalars(df.select(hue, *cols), st)

    def b(c):
        lo, w = F.col(f"_lo_{c}"), (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) / bins
        return F.when(F.col(c).isNotNull(), _bin_expr(F.col(c).cast("double"), lo, w, bins))

    # the rows are counted once by all their bins; the panels are sums of those counts
    p = free_prefix(df.columns)
    joint = j.groupBy(hue, *[b(c).alias(f"{p}b{i}") for i, c in enumerate(cols)]).agg(F.count(F.lit(1)).alias(f"{p}n"))
    at = {c: F.col(f"{p}b{i}") for i, c in enumerate(cols)}
    panels = F.inline(F.array(*[
        F.struct(F.lit(a).alias("x_dim"), F.lit(c).alias("y_dim"), at[a].alias("x_bin"),
                 (at[c] if a != c else F.lit(None).cast("int")).alias("y_bin"))
        for a, c in pairs]))
    e = joint.select(hue, f"{p}n", panels).where(F.col("x_bin").isNotNull())
    return e.groupBy("x_dim", "y_dim", hue, "x_bin", "y_bin").agg(F.sum(f"{p}n").alias("count"))


def pair_grid_diagonal(df: DataFrame, cols: Sequence[str], hue: str, grid: int = 100) -> DataFrame:
    """The pair plot's diagonal: a kernel density of each column per hue
    (the columns unpivoted to (dim, value), then ``violin_density`` per
    (dim, hue))."""
    long = df.select(hue, F.explode(F.array(*[
        F.struct(F.lit(c).alias("dim"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv"))
    long = long.select(hue, "kv.dim", "kv.value")
    return violin_density(long, "value", ["dim", hue], grid=grid)
