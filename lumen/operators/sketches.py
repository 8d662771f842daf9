"""Stored quantile sketches (A17): one mergeable sketch per period.

The fact is read once per period; quantiles of any span of periods are then
answered from the stored sketches alone, by merging them.  The sketches are KLL
sketches of ``K`` = 800: the rank of an answer is within 1 % of the one asked for
(the error of a merge is that of a single sketch over all rows), whatever the
number of rows.  Merging needs no order, so periods can be
appended, replaced and re-read in any.  NULL and NaN are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 800


def period_sketches(df: DataFrame, value: str, period: str, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, ``period``, sketch): a partial aggregate, a few kilobytes a group."""
    x = F.col(value).cast("double")
    return (df.where(F.col(value).isNotNull() & ~F.isnan(x)).groupBy(*by, period)
            .agg(F.kll_sketch_agg_double(x, F.lit(K)).alias("sketch")))


def save_periods(sketches: DataFrame, path: str, period: str) -> None:
    """Store sketches under ``path``, partitioned by period.  Periods that are stored
    already are replaced, others stay, so a period can be delivered again."""
    (sketches.write.partitionBy(period).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def span_quantiles(sketches: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, n, one column per name in ``probs``): the sketches of each group merged."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(K)).alias("sketch"))
    return merged.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()])
