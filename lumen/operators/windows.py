"""Ranking and analytic windows.

Two execution shapes:

* raw fact rows ranked inside a few large groups (carriers, cuts) go through
  ``rank_within``, which cuts groups into ranges, so none is funnelled into one task;
* top-n per group keeps Spark's window form: Catalyst inserts a partial
  ``WindowGroupLimit`` before the shuffle, so each task ships at most n rows
  per group whatever the skew;
* running sums and moving means over raw rows go through ``rank_within`` too; the
  series forms (``running_total``, ``moving_average``, ``cumulative_share``) take an
  already aggregated series (days, weeks, months), bounded by the calendar.

ROW_NUMBER, LAG, LEAD and NTILE always get a unique tie-break so results are
reproducible; RANK and DENSE_RANK never do (ties are the point).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumen.functions.expressions import pct
from lumen.operators.ordered import free_prefix, ntile_from_rank, rank_within, spread


def _order_cols(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def rankings(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
             tiebreak: Sequence[str], names=("row_num", "rank", "dense_rank")) -> DataFrame:
    """ROW_NUMBER, RANK, DENSE_RANK per group, skew-safe."""
    r = rank_within(df, by, order, tiebreak, outputs=("row_number", "rank", "dense_rank"))
    rn, rk, dr = names
    return r.withColumnsRenamed({"row_number": rn, "rank": rk, "dense_rank": dr})


def value_ranks(df: DataFrame, by: Sequence[str], value: str, ascending: bool,
                tiebreak: Sequence[str], kinds=("rank", "dense_rank")) -> DataFrame:
    """RANK / DENSE_RANK per group, skew-safe."""
    return rank_within(df, by, [(value, ascending)], tiebreak, outputs=kinds)


def row_numbers(df: DataFrame, by: Sequence[str], value: str, ascending: bool,
                tiebreak: Sequence[str], outputs=("row_number",)) -> DataFrame:
    """ROW_NUMBER (and group size) per group under (value, tiebreak) order, skew-safe."""
    return rank_within(df, by, [(value, ascending)], tiebreak, outputs=outputs)


def ntile(df: DataFrame, k: int, by: Sequence[str], order: Sequence[tuple[str, bool]],
          tiebreak: Sequence[str], name: str = "ntile") -> DataFrame:
    """NTILE(k) per group (first n % k buckets one row larger), skew-safe."""
    r = rank_within(df, by, order, tiebreak, outputs=("row_number", "group_size"))
    return r.withColumn(name, ntile_from_rank("row_number", "group_size", k)).drop("row_number", "group_size")


def lag_lead(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
             tiebreak: Sequence[str], lag: Sequence[str] = (), lead: Sequence[str] = (), offset: int = 1) -> DataFrame:
    """Value ``offset`` rows before / after within the group, as prev_<c> / next_<c>, skew-safe."""
    return rank_within(df, by, order, tiebreak, outputs=(), lag=lag, lead=lead, offset=offset)


def running_sum_rows(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]], tiebreak: Sequence[str],
                     value: str, name: str = "running_total", frame: str = "rows") -> DataFrame:
    """Cumulative SUM over raw rows, skew-safe: ``frame="rows"`` steps row by row in
    (order, tiebreak); ``frame="range"`` (SQL's default frame) gives peers in ``order``
    the same sum, so the rows are summed by order value first."""
    if frame == "rows":
        return rank_within(df, by, order, tiebreak, outputs=(), running=[value]).withColumnRenamed(f"sum_{value}", name)
    p = free_prefix(df.columns, [name])
    keys = list(dict.fromkeys([*by, *[c for c, _ in order]]))
    steps = df.groupBy(*[F.col(k).alias(f"{p}k_{k}") for k in keys]).agg(F.sum(value).alias(f"{p}v"))
    steps = rank_within(steps, [f"{p}k_{k}" for k in by], [(f"{p}k_{c}", asc) for c, asc in order], [], outputs=(),
                        running=[f"{p}v"], aggregate=True).withColumnRenamed(f"sum_{p}v", name)
    return _join_back(df, steps, keys, [name], p)


def moving_mean_rows(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]], tiebreak: Sequence[str],
                     value: str, rows: int = 7, name: str = "moving_avg") -> DataFrame:
    """Mean of the last ``rows`` raw rows of the group (NULLs skipped), skew-safe."""
    return rank_within(df, by, order, tiebreak, outputs=(), moving=[value], rows=rows).withColumnRenamed(f"mean_{value}", name)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
                    tiebreak: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """Rows with ROW_NUMBER <= n per group (``WindowGroupLimit`` partial + final)."""
    w = Window.partitionBy(*by).orderBy(*_order_cols(order), *[F.col(t) for t in tiebreak])
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def group_mean_beside(df: DataFrame, by: Sequence[str], value: str, name: str,
                      round_to: int | None = 2) -> DataFrame:
    """``AVG(value) OVER (PARTITION BY by)`` beside every row.

    Planned as a partial/final aggregate joined back on the keys, so no group
    is sorted in one task; Spark broadcasts the group table if it is small.
    Rows whose key is NULL get the NULL group's mean, as the window would.
    """
    keys, p = list(by), free_prefix(df.columns, [name])
    means = df.groupBy(*[F.col(k).alias(f"{p}k_{k}") for k in keys]).agg(F.avg(value).alias(name))
    if round_to is not None:
        means = means.withColumn(name, F.round(name, round_to))
    return _join_back(df, means, keys, [name], p)


def _join_back(df: DataFrame, per_group: DataFrame, keys: Sequence[str], cols: Sequence[str], p: str) -> DataFrame:
    """Attach per-group columns (keyed ``<p>k_<key>``) to the rows, NULL-safe."""
    cond = [F.col(k).eqNullSafe(F.col(f"{p}k_{k}")) for k in keys]
    return df.join(per_group, cond, "left").select(*df.columns, *cols)


def first_last_beside(df: DataFrame, by: Sequence[str], value: str, order: Sequence[tuple[str, bool]],
                      tiebreak: Sequence[str], first_name: str, last_name: str) -> DataFrame:
    """FIRST_VALUE / LAST_VALUE over the whole ordered group, beside each row.

    Ascending keys and descending numbers: ``min_by`` / ``max_by`` on (order,
    tiebreak), a partial aggregate.  Other descending keys: the first row of each
    group in the order and in its reverse (``WindowGroupLimit`` keeps one row per
    group and task).  Either is joined back on the group keys.
    """
    p = free_prefix(df.columns, [first_name, last_name])
    group = [F.col(k).alias(f"{p}k_{k}") for k in by]
    if any(not asc and not isinstance(df.schema[c].dataType, T.NumericType) for c, asc in order):
        rows = spread(df)  # read by all three plans below
        forth = [*order, *[(t, True) for t in tiebreak]]

        def end(keys, name):
            first = Window.partitionBy(*by).orderBy(*_order_cols(keys))
            return rows.withColumn(f"{p}rn", F.row_number().over(first)).where(F.col(f"{p}rn") == 1).select(
                *group, F.col(value).alias(name))

        out = _join_back(rows, end(forth, first_name), by, [first_name], p)
        return _join_back(out, end([(c, not asc) for c, asc in forth], last_name), by, [last_name], p)
    # A descending number is turned ascending by negation inside the sort struct;
    # NULLs then go last and NaN first, as DESC has them.
    parts = []
    for c, asc in order:
        kind = df.schema[c].dataType
        if asc:
            parts.append(F.col(c))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            parts += [F.col(c).isNull().alias(f"n_{c}"), (~F.isnan(c)).alias(f"f_{c}"), (-F.col(c)).alias(f"d_{c}")]
        else:
            wide = F.col(c) if isinstance(kind, T.DecimalType) else F.col(c).cast("decimal(20,0)")
            parts += [F.col(c).isNull().alias(f"n_{c}"), (-wide).alias(f"d_{c}")]
    key = F.struct(*parts, *[F.col(t) for t in tiebreak])
    ends = df.groupBy(*group).agg(F.min_by(value, key).alias(first_name), F.max_by(value, key).alias(last_name))
    return _join_back(df, ends, by, [first_name, last_name], p)


def running_total(series: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (),
                  name: str = "running_total", frame: str = "rows") -> DataFrame:
    """Cumulative SUM over an aggregated series.

    ``frame="rows"`` — ROWS UNBOUNDED PRECEDING..CURRENT ROW (every row its own step);
    ``frame="range"`` — the SQL default frame: peers (equal order keys) share the value.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    w = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if frame == "rows"
         else w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return series.withColumn(name, F.sum(value).over(w))


def moving_average(series: DataFrame, value: str, order: Sequence[str], rows: int = 7,
                   by: Sequence[str] = (), name: str = "moving_avg", round_to: int | None = 2) -> DataFrame:
    """Trailing mean over ``rows`` rows (not days: gaps widen the span)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(rows - 1), Window.currentRow)
    c = F.avg(value).over(w)
    if round_to is not None:
        c = F.round(c, round_to)
    return series.withColumn(name, c)


def cumulative_share(series: DataFrame, value: str, order: str, cum_name: str = "cumulative",
                     pct_name: str = "cumulative_pct", round_to: int = 2) -> DataFrame:
    """Running total (RANGE frame) and its percent of the grand total.

    ``series`` is an aggregated series (one row per period), so the
    un-partitioned windows run over at most a calendar's worth of rows.
    """
    w = Window.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = series.withColumn(cum_name, F.sum(value).over(w))
    out = out.withColumn("_grand", F.sum(value).over(Window.partitionBy()))
    return out.withColumn(pct_name, F.round(pct(cum_name, "_grand"), round_to)).drop("_grand")
