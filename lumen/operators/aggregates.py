"""Grouped statistics.

Every aggregate here is planned as partial (map-side) + final hash
aggregation, so a hot group key is pre-aggregated in every task before the
shuffle and never lands whole in one task.  Exact quantiles read their input
twice: a sketch brackets each wanted rank, then the rows are counted by zone and
only the values inside a bracket are kept apart and ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.operators.ordered import free_prefix, rank_within


def grouped(df: DataFrame, keys: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    """``GROUP BY keys`` with named aggregates."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def global_agg(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates over the whole table: one row."""
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def value_counts(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """pandas ``value_counts``: counts per non-NULL value, largest first."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(key).asc()))


def mean_by(df: DataFrame, key: str, value: str, name: str | None = None) -> DataFrame:
    """pandas ``groupby(key)[value].mean()``: NULL keys dropped, NULL values skipped."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.avg(value).alias(name or value)))


# Of the quantile sketch: a bracket reaches twice its proven rank error (1 / SKETCH)
# beyond the wanted rank on either side.
SKETCH = 1_000
MARGIN = 2 / SKETCH


def _sketch(x: Column, probs: Sequence[float]) -> Column:
    """Bracket ends of every probability, as one array; NaN counts as the largest value."""
    ends = [min(1.0, max(0.0, p + s)) for p in probs for s in (-MARGIN, MARGIN)]
    return F.percentile_approx(F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x), ends, SKETCH)


def _bracket(sketch: Column, n: Column, probs: Sequence[float], i: int) -> tuple[Column, Column]:
    """(low, high) that enclose the two order statistics around probability ``i``.
    Where the margin is only a few ranks wide, the bracket takes in everything."""
    few, p = n * F.lit(MARGIN) < 6, probs[i]
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    return (low if p - MARGIN <= 0 else F.when(few, low).otherwise(sketch[2 * i]),
            high if p + MARGIN >= 1 else F.when(few, high).otherwise(sketch[2 * i + 1]))


def _select_ranks(rows: DataFrame, by: list[str], probs: Mapping[str, float], p: str) -> DataFrame:
    """One row a group: the interpolated quantiles.  ``rows`` has the value ``<p>x``
    and its group's ``<p>sketch`` and ``<p>size`` on every row; columns that
    start with ``<p>also`` are the same in a group and are kept."""
    x, names = F.col(f"{p}x"), sorted(probs, key=probs.get)
    sorted_probs = [float(probs[n]) for n in names]
    ends = [_bracket(F.col(f"{p}sketch"), F.col(f"{p}size"), sorted_probs, i) for i in range(len(names))]
    past = [~((x <= high) | (high == float("inf"))) for _, high in ends]
    inside = reduce(lambda a, b: a | b, [(x >= low) & ~gone for (low, _), gone in zip(ends, past)])
    zone = reduce(lambda a, b: a + b, [gone.cast("int") for gone in past])
    also = [c for c in rows.columns if c.startswith(f"{p}also")]
    zoned = rows.select(*by, *also, x, zone.alias(f"{p}zone"), inside.alias(f"{p}in"))
    # all rows between two brackets become one row, which stands where they lie
    comp = zoned.groupBy(*by, f"{p}zone", f"{p}in", F.when(F.col(f"{p}in"), x).alias(f"{p}value")).agg(
        F.count(F.lit(1)).alias(f"{p}w"), F.min(x).alias(f"{p}x"), *[F.first(c).alias(c) for c in also])
    r = rank_within(comp.drop(f"{p}zone", f"{p}value"), by, [(f"{p}x", True)], [], outputs=("row_number", "group_size"), weight=f"{p}w",
                    aggregate=True)
    upto, below, n = F.col("row_number"), F.col("row_number") - F.col(f"{p}w"), F.col("group_size")
    exact = F.when(F.col(f"{p}in"), x).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
    picks, wanted = [F.first(c).alias(c) for c in also], F.lit(False)
    for name, prob in probs.items():
        h = (n - 1) * F.lit(float(prob))
        for side, k in (("lo", F.floor(h) + 1), ("hi", F.ceil(h) + 1)):
            here = (below < k) & (k <= upto)
            wanted = wanted | here
            picks.append(F.max(F.when(here, exact)).alias(f"{p}{side}_{name}"))
        picks.append(F.max(h - F.floor(h)).alias(f"{p}fr_{name}"))
    sel = r.where(wanted).groupBy(*by).agg(*picks)
    lo, hi, fr = ({n: F.col(f"{p}{side}_{n}") for n in probs} for side in ("lo", "hi", "fr"))
    return sel.select(*by, *also, *[(lo[n] + fr[n] * (hi[n] - lo[n])).alias(n) for n in probs])


def exact_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                    by: Sequence[str] = (), also: Mapping[str, Column] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (``percentile`` / ``quantile_cont``)
    by bracketed selection, in two reads of ``df``.

    The first read sketches each group's values and gives a bracket around every
    wanted rank; the second counts the rows between the brackets and compresses
    the values inside them to (value, count), so what is ordered is a small
    share of the rows, and a value repeated a billion times is one row.  NULL
    values are ignored; NaN comes last.  A sketch that broke its proven error would
    raise, never give another value.

    ``also``: further aggregates of the rows with a value, taken in the first read.
    Output: ``by`` columns + one column per name in ``probs`` and in ``also``.
    """
    by, also = list(by), dict(also or {})
    p = free_prefix(df.columns, by, probs, also)
    base = df.where(F.col(value).isNotNull()).withColumn(f"{p}x", F.col(value).cast("double"))
    names = sorted(probs, key=probs.get)
    stats = base.groupBy(*[F.col(b).alias(f"{p}k_{b}") for b in by]).agg(
        _sketch(F.col(f"{p}x"), [float(probs[n]) for n in names]).alias(f"{p}sketch"), F.count(F.lit(1)).alias(f"{p}size"),
        *[c.alias(f"{p}also_{n}") for n, c in also.items()])
    rows = base.select(*by, f"{p}x")
    if by:
        cond = [F.col(b).eqNullSafe(F.col(f"{p}k_{b}")) for b in by]
        rows = rows.join(stats, cond, "inner").drop(*[f"{p}k_{b}" for b in by])
    else:
        rows = rows.crossJoin(F.broadcast(stats))  # one row
    got = _select_ranks(rows, by, probs, p)
    return got.select(*by, *probs, *[F.col(f"{p}also_{n}").alias(n) for n in also])


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float],
                     also: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """(column, its quantiles by name, its further aggregates by name): one row per
    column, all columns together in two reads of ``df``; a column without values
    gives NULLs.  ``also``: per column, the same names."""
    also = also or {}
    more = list(next(iter(also.values()), {}))
    p = free_prefix(df.columns, probs, more)
    ps = sorted(map(float, probs.values()))
    d = {c: F.col(c).cast("double") for c in cols}
    # side by side: the first read repeats no row
    one = df.agg(*[_sketch(d[c], ps).alias(f"{p}s{i}") for i, c in enumerate(cols)],
                 *[F.count(c).alias(f"{p}n{i}") for i, c in enumerate(cols)],
                 *[also[c][m].alias(f"{p}a{i}_{k}") for i, c in enumerate(cols) for k, m in enumerate(more)])
    stats = one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias(f"{p}of"), F.col(f"{p}s{i}").alias(f"{p}sketch"), F.col(f"{p}n{i}").alias(f"{p}size"),
        *[F.col(f"{p}a{i}_{k}").alias(f"{p}m{k}") for k in range(len(more))]) for i, c in enumerate(cols)])))
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), d[c].alias(f"{p}x")) for c in cols])))
    rows = long.where(F.col(f"{p}x").isNotNull()).join(
        F.broadcast(stats.select(f"{p}of", f"{p}sketch", f"{p}size")), F.col("column") == F.col(f"{p}of")).drop(f"{p}of")
    got = _select_ranks(rows, ["column"], probs, p)
    return stats.join(F.broadcast(got), F.col("column") == F.col(f"{p}of"), "left").select(  # a row a column
        F.col(f"{p}of").alias("column"), *probs, *[F.col(f"{p}m{k}").alias(m) for k, m in enumerate(more)])


def approx_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                     by: Sequence[str] = (), accuracy: int = 100) -> DataFrame:
    """Approximate quantiles (``approxQuantile(col, probs, 1/accuracy)``),
    one bounded-size sketch per group, lazy and joinable."""
    arr = F.percentile_approx(value, [float(p) for p in probs.values()], accuracy)
    agg = df.groupBy(*by).agg(arr.alias("_q"))
    return agg.select(*by, *[F.col("_q")[i].cast("double").alias(n)
                             for i, n in enumerate(probs)])


def profile_describe(df: DataFrame, cols: Sequence[str], round_to: int = 6) -> DataFrame:
    """pandas ``describe()`` in long form: one row per numeric column with
    count, mean, std, min, 25%, 50%, 75%, max (exact quartiles)."""
    also = {c: {"count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(F.col(c).cast("double")),
                "min": F.min(c).cast("double"), "max": F.max(c).cast("double")} for c in cols}
    got = column_quantiles(df, cols, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, also)
    return got.select(
        "column", "count",
        *[F.round(c, round_to).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def pivot_mean(df: DataFrame, index: str, column: str, value: str,
               levels: Sequence, round_to: int | None = None) -> DataFrame:
    """``pivot_table(index, columns, values)`` with mean, for explicit column
    levels (no extra job to discover them; result width is bounded by them)."""
    agg = F.avg(value)
    if round_to is not None:
        agg = F.round(agg, round_to)
    return df.groupBy(index).pivot(column, list(levels)).agg(agg)
