"""Data quality and cleaning.

Each statistic is a one-row aggregate attached to the rows by a broadcast join,
so no operator runs a job or passes a value through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumen.operators.aggregates import approx_quantiles, column_quantiles, exact_quantiles
from lumen.operators.joins import attach_scalars
from lumen.operators.ordered import free_prefix


def missing_summary(df: DataFrame, cols: Sequence[str], prefix: str = "pct_missing_") -> DataFrame:
    """Percent of NULLs per column, all columns in one pass, one row."""
    n = F.count(F.lit(1)).cast("double")
    return df.agg(*[(F.lit(100.0) * F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), n))
                    .alias(f"{prefix}{c}") for c in cols])


def quantiles(df: DataFrame, value: str, probs: dict, exact: bool = True,
              accuracy: int = 100) -> DataFrame:
    """One-row quantiles: exact (bracketed selection) or approximate (sketch,
    rank error 1/accuracy, like ``approxQuantile(..., 0.01)``)."""
    if exact:
        return exact_quantiles(df, value, probs)
    return approx_quantiles(df, value, probs, accuracy=accuracy)


def mean_vs_median(df: DataFrame, value: str, exact: bool = True) -> DataFrame:
    """Mean and median of one column (NULLs skipped), one row."""
    if exact:  # the mean comes with the first of the median's two reads
        return exact_quantiles(df, value, {"median": 0.5}, also={"mean": F.avg(value)}).select("mean", "median")
    return attach_scalars(df.agg(F.avg(value).alias("mean")), quantiles(df, value, {"median": 0.5}, exact=False))


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first row under ``order`` (deterministic).

    The rows are brought together by key once and the first of each key is
    kept by ``row_number``; Spark limits each task's groups before the sort.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    rn = f"{free_prefix(df.columns)}rn"
    return df.repartition(*keys).withColumn(rn, F.row_number().over(first)).where(F.col(rn) == 1).drop(rn)


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after de-duplication on ``keys``, one row.

    One pass: equal keys are counted together batch by batch, so a hot key leaves a
    task in few rows, then brought together once and numbered in sorted order (NULL-keyed
    rows count as a key, as ``dropDuplicates`` keeps them).  A task holds no table of its
    keys, often nearly as many as its rows: it sorts them, and a sort spills.  The hash in
    front only makes the sort cheap.  Keys of other than ``BATCH_KEYS`` are aggregated.
    """
    rows = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    names = rows.columns
    if not names or not all(isinstance(t, BATCH_KEYS) or t == T.StringType() for t in (f.dataType for f in rows.schema)):
        by_key = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("first"))
    else:
        same = Window.partitionBy("h", *names).orderBy("n")
        by_key = (count_in_batches(rows).repartition(*names).withColumn("h", F.xxhash64(*names))
                  .select("n", (F.row_number().over(same) == 1).alias("first")))
    return (by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count_if("first").alias("rows_after"))
            .withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after")))


# Types, beside plain strings, that Arrow groups; it may keep apart what Spark takes for equal, never the reverse.
BATCH_KEYS = (T.NumericType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def count_in_batches(rows: DataFrame) -> DataFrame:
    """The rows and a count ``n``: equal rows of one Arrow batch as one; a task holds one batch."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(names, use_threads=False).aggregate([([], "count_all")])
            yield from t.select([*names, "count_all"]).rename_columns([*names, "n"]).to_batches()

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("n", T.LongType())]))


def impute_median(df: DataFrame, value: str, median_of: DataFrame | None = None,
                  exact: bool = True) -> DataFrame:
    """Fill NULLs of ``value`` with its median (of ``median_of``, default ``df``).

    Like ``fillna``, the fill value is cast to the column's type (an int
    column gets the median truncated toward zero).
    """
    src = median_of if median_of is not None else df
    name = f"{free_prefix(df.columns)}median"
    return fill_with(df, value, quantiles(src, value, {name: 0.5}, exact=exact), name)


def fill_with(df: DataFrame, value: str, one_row: DataFrame, name: str) -> DataFrame:
    """NULLs of ``value`` filled with column ``name`` of a one-row table, cast to its type."""
    p = free_prefix(df.columns)
    j = attach_scalars(df, one_row.select(F.col(name).alias(f"{p}fill")))
    return j.withColumn(value, F.coalesce(F.col(value), F.col(f"{p}fill").cast(df.schema[value].dataType))).drop(f"{p}fill")


def iqr_bounds(df: DataFrame, value: str, k: float = 1.5, exact: bool = True) -> DataFrame:
    """Q1, Q3, IQR and the fences Q1 − k·IQR, Q3 + k·IQR, one row."""
    return fences(quantiles(df, value, {"q1": 0.25, "q3": 0.75}, exact=exact), k)


def fences(q: DataFrame, k: float = 1.5) -> DataFrame:
    """``q1`` and ``q3`` with the IQR and the fences."""
    return (q.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lower_bound", F.col("q1") - F.lit(k) * F.col("iqr"))
             .withColumn("upper_bound", F.col("q3") + F.lit(k) * F.col("iqr")))


def outlier_flag(df: DataFrame, value: str, bounds: DataFrame, name: str = "is_outlier") -> DataFrame:
    """Strictly outside the fences → true; inside or NULL → false (never NULL)."""
    p = free_prefix(df.columns)
    low, high = f"{p}low", f"{p}high"
    j = attach_scalars(df, bounds.select(F.col("lower_bound").alias(low), F.col("upper_bound").alias(high)))
    flag = F.when((F.col(value) < F.col(low)) | (F.col(value) > F.col(high)), F.lit(True)).otherwise(F.lit(False))
    return j.withColumn(name, flag).drop(low, high)


def clean_columns(df: DataFrame, fill: str, flag: str, name: str = "is_outlier", k: float = 1.5) -> DataFrame:
    """``impute_median`` of ``fill`` and ``outlier_flag`` of ``flag`` (another column) together:
    the median and the quartiles of both columns come from the same two reads of ``df``."""
    if fill == flag:
        raise ValueError("the fences of the filled column depend on its median; use the two operators")
    q = column_quantiles(df, [fill, flag], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    of = lambda col, stat: F.max(F.when(F.col("column") == col, F.col(stat))).alias(stat)
    one = fences(q.agg(of(fill, "median"), of(flag, "q1"), of(flag, "q3")), k)
    p = free_prefix(df.columns)
    median, low, high = f"{p}median", f"{p}low", f"{p}high"
    j = attach_scalars(df, one.select(F.col("median").alias(median), F.col("lower_bound").alias(low), F.col("upper_bound").alias(high)))
    out = F.when((F.col(flag) < F.col(low)) | (F.col(flag) > F.col(high)), F.lit(True)).otherwise(F.lit(False))
    return j.withColumns({fill: F.coalesce(F.col(fill), F.col(median).cast(df.schema[fill].dataType)), name: out}).drop(
        median, low, high)


def outlier_count(flagged: DataFrame, name: str = "is_outlier") -> DataFrame:
    return flagged.agg(F.count_if(F.col(name)).alias("outlier_count"))


def validation_report(df: DataFrame, min_rows: int, not_null: Sequence[str],
                      non_negative: Sequence[str]) -> DataFrame:
    """All rules in one aggregate, unpivoted to (rule, observed, status)."""
    aggs = [F.count(F.lit(1)).alias("r0")]
    rules = [(f"row count > {min_rows}", "r0", f"r0 > {min_rows}")]
    for i, c in enumerate(not_null, start=1):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        rules.append((f"no NULL {c}", f"n{i}", f"n{i} = 0"))
    for i, c in enumerate(non_negative, start=1):
        aggs.append(F.count_if(F.col(c) < 0).alias(f"g{i}"))
        rules.append((f"no negative {c}", f"g{i}", f"g{i} = 0"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(label).alias("rule"), F.col(col).alias("observed"),
                              F.when(F.expr(cond), "PASS").otherwise("FAIL").alias("status"))
                     for label, col, cond in rules])
    return one.select(F.explode(rows).alias("r")).select("r.*")
