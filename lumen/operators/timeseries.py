"""Time-series compositions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumen.functions.expressions import pct_change


def period_change(series: DataFrame, period: str, measures: Sequence[str],
                  by: Sequence[str] = (), prev_names: dict | None = None,
                  abs_names: dict | None = None, pct_names: dict | None = None,
                  round_to: int = 2) -> DataFrame:
    """Previous value, absolute change and percent change per measure.

    ``series`` is one row per (by, period) — an aggregate — so the window is
    over a bounded series.  The LAG is computed once per measure and reused;
    the percent change is NULL when the previous value is 0 or missing.
    """
    w = Window.partitionBy(*by).orderBy(period)
    out = series
    for m in measures:
        prev = (prev_names or {}).get(m, f"prev_{m}")
        out = out.withColumn(prev, F.lag(m, 1).over(w))
        if abs_names and m in abs_names:
            out = out.withColumn(abs_names[m], F.round(F.col(m) - F.col(prev), round_to))
        if pct_names and m in pct_names:
            out = out.withColumn(pct_names[m], F.round(pct_change(m, prev), round_to))
    return out


def deviation_from_group(df: DataFrame, by: Sequence[str], value: str, keep: Sequence[str],
                         tiebreak: Sequence[str], avg_name: str = "group_avg",
                         dev_name: str = "vs_avg", top: int | None = 20,
                         only_above: bool = False, round_to: int = 2) -> DataFrame:
    """Each row's difference from its group mean, worst first.

    The group means are a partial/final aggregate (a hot group is
    pre-aggregated per task) joined back: no full-table sort by group.  ``vs_avg`` is taken from
    the unrounded mean, then rounded.  ``top`` keeps the k largest deviations
    (a top-k report: ``TakeOrderedAndProject``); ``only_above`` keeps only
    rows above their group mean.
    """
    d = df.where(F.col(value).isNotNull())
    means = d.groupBy(*by).agg(F.avg(value).alias("_mean"))
    j = d.join(means, list(by), "inner")
    if only_above:
        j = j.where(F.col(value) > F.col("_mean"))
    out = j.select(*keep,
                   F.round("_mean", round_to).alias(avg_name),
                   F.round(F.col(value) - F.col("_mean"), round_to).alias(dev_name),
                   *[F.col(t).alias(f"_tb_{t}") for t in tiebreak if t not in keep])
    order = [F.col(dev_name).desc()] + [F.col(t if t in keep else f"_tb_{t}") for t in tiebreak]
    out = out.orderBy(*order)
    if top is not None:
        out = out.limit(top)
    return out.select(*keep, avg_name, dev_name)


def rank_in_period(stats: DataFrame, period: Sequence[str], metric: str, ascending: bool = False,
                   name: str = "rank") -> DataFrame:
    """DENSE_RANK of groups by a metric inside each period (an aggregate table)."""
    w = Window.partitionBy(*period).orderBy(F.col(metric).asc() if ascending else F.col(metric).desc())
    return stats.withColumn(name, F.dense_rank().over(w))
