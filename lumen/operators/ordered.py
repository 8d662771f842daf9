"""Ordered statistics per group whose rows need not fit one task.

``Window.partitionBy(group)`` sends a whole group to one task.  Here each group
is cut into cells, ranges of its rows in the full order (order columns, then
tie-break), so that a hot group and a hot value in it are cut alike:

1. the input is spread once by a hash of its columns; everything below reads
   that one exchange, so the input is evaluated once however dear it is;
2. a sample of about ``SAMPLE`` rows a cell, the rows whose hash lies below a
   bound, gives the cell bounds.  It is taken over all groups, so the sample and
   the bounds are bounded by the number of cells and a small group has none.
   Which rows are in it follows from their values alone: a recomputed task finds
   the same bounds;
3. the rows are shuffled by cell and Spark's own windows run inside the cells;
4. counts, edge rows and totals of the cells (a small table) give the offsets.

Bounds are compared column by column in each column's own order, so every type
that Spark can sort can be cut: numbers, dates, timestamps with or without a
zone, strings.  The same plan of built-in functions runs at every size, and
nothing runs while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 32  # sampled rows a cell
_HASH_BITS = 40


def free_prefix(*column_lists: Sequence[str]) -> str:
    """A prefix with which no given column starts."""
    taken = [c.lower() for cols in column_lists for c in cols]
    prefix = "_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def _holds(kind: T.DataType, unfit: tuple) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, unfit)
    if isinstance(kind, T.StructType):
        return any(_holds(f.dataType, unfit) for f in kind)
    return isinstance(kind, unfit)


def sortable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash and sort (all but maps and variants)."""
    return [f.name for f in df.schema if not _holds(f.dataType, (T.MapType, T.VariantType))]


def _attach(df: DataFrame, table: DataFrame, keys: Sequence[str], p: str) -> DataFrame:
    """Columns of ``table`` (keyed ``<p>k_<key>``) beside the rows, NULL-safe."""
    if not keys:
        return df.crossJoin(F.broadcast(table))  # one row
    cond = [F.col(k).eqNullSafe(F.col(f"{p}k_{k}")) for k in keys]
    return df.join(table, cond, "left").drop(*[f"{p}k_{k}" for k in keys])


def _keyed(keys: Sequence[str], p: str) -> list[Column]:
    return [F.col(k).alias(f"{p}k_{k}") for k in keys]


def _sorts(keys: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in keys]


def comes_before(bound: Column, keys: Sequence[tuple[str, bool]]) -> Column:
    """Whether a bound comes before the row: by the first column in which they
    differ; NULLs come first ascending and last descending, as in windows."""
    out = F.lit(False)
    for i, (c, asc) in reversed(list(enumerate(keys))):
        b, v = bound[f"k{i}"], F.col(c)
        if asc:
            less = F.coalesce(b < v, b.isNull() & v.isNotNull())
        else:
            less = F.coalesce(b > v, v.isNull() & b.isNotNull())
        out = less | (b.eqNullSafe(v) & out)
    return out


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly by a hash of their columns, behind a generator that needs
    all of them: no filter or pruning of a plan above reaches below it, so all
    such plans have the same exchange and Spark runs it once."""
    return shared(df.repartition(*sortable(df)) if sortable(df) else df)


def shared(df: DataFrame) -> DataFrame:
    """``df`` behind the generator alone: for an input that ends in an exchange
    already, such as an aggregate."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _cells(df: DataFrame, by: list[str], keys: list[tuple[str, bool]], ranges: int, p: str | None = None,
           aggregate: bool = False) -> DataFrame:
    """The rows with ``<p>pos``, the place of their cell in the group."""
    p = p or free_prefix(df.columns)
    rows = shared(df) if aggregate else spread(df)
    total = rows.agg(F.count(F.lit(1)).alias(f"{p}total"))
    chance = F.lit(float(SAMPLE * ranges * (1 << _HASH_BITS))) / F.col(f"{p}total")
    drawn = F.pmod(F.xxhash64(*(sortable(df) or [F.lit(0)])), F.lit(1 << _HASH_BITS)) < chance
    sample = rows.crossJoin(F.broadcast(total)).where(drawn)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*_sorts(keys)))
    picked = sample.select(*by, *{c: None for c, _ in keys if c not in by}, place.alias(f"{p}place")).where(
        F.col(f"{p}place") % SAMPLE == 0)
    key = F.struct(F.col(f"{p}place").alias("place"), *[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(keys)])
    bounds = picked.groupBy(*_keyed(by, p)).agg(F.sort_array(F.collect_list(key)).alias(f"{p}fine"))
    # two levels, so that a row is compared with few of its group's bounds
    step = F.ceil(F.sqrt(F.size(f"{p}fine"))).cast("int")
    bounds = bounds.withColumn(f"{p}step", F.greatest(step, F.lit(1))).withColumn(
        f"{p}coarse", F.filter(f"{p}fine", lambda b, i: (i + 1) % F.col(f"{p}step") == 0))

    def passed(array):
        return F.size(F.filter(array, lambda b: comes_before(b, keys)))

    joined = _attach(rows, F.broadcast(bounds), by, p)  # about ``ranges`` bounds in all
    start = passed(F.col(f"{p}coarse")) * F.col(f"{p}step")
    joined = joined.withColumn(f"{p}start", start)
    rest = F.slice(F.col(f"{p}fine"), F.col(f"{p}start") + 1, F.col(f"{p}step"))
    pos = F.when(F.col(f"{p}fine").isNull(), F.lit(0)).otherwise(F.col(f"{p}start") + passed(rest))
    return joined.withColumns({f"{p}pos": pos.cast("int"), f"{p}sub": F.lit(0)}).select(*df.columns, f"{p}pos", f"{p}sub")


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
                tiebreak: Sequence[str], outputs: Sequence[str] = ("row_number",),
                lag: Sequence[str] = (), lead: Sequence[str] = (), weight: str | None = None,
                ranges: int | None = None, offset: int = 1, running: Sequence[str] = (),
                moving: Sequence[str] = (), rows: int = 7, aggregate: bool = False) -> DataFrame:
    """Add ordered statistics per group of ``by``.

    ``order``: (column, ascending) pairs - the ranking order (ascending puts
    NULLs first, descending puts them last, as in SQL/Spark windows).
    ``tiebreak``: columns that make (by, order, tiebreak) unique; they fix
    ROW_NUMBER / LAG / LEAD among peers but never affect RANK / DENSE_RANK.
    ``outputs``: any of row_number, rank, dense_rank, group_size.
    ``lag`` / ``lead``: columns whose value ``offset`` rows before / after in
    the group is added as ``prev_<c>`` / ``next_<c>``.
    ``running``: columns whose sum over the group's rows up to this one is added
    as ``sum_<c>`` (values of any sign; NULL before the first value).
    ``moving``: columns whose mean over the last ``rows`` rows is added as ``mean_<c>``.
    ``weight``: a non-negative count column; ``row_number`` then becomes the
    cumulative weight through the row and ``group_size`` the group's total.
    ``ranges``: cells all rows are cut into (default: the shuffle partitions).
    ``aggregate``: ``df`` is an aggregate, so its rows come from an exchange that can
    be read again and need not be spread first.

    Other columns pass unchanged; an input column with the name of an output raises.
    """
    by, outputs, order = list(by), list(outputs), list(order)
    names = [*outputs, *[f"prev_{c}" for c in lag], *[f"next_{c}" for c in lead], *[f"sum_{c}" for c in running],
             *[f"mean_{c}" for c in moving]]
    if clash := {c.lower() for c in df.columns} & set(names):
        raise ValueError(f"the input already has {sorted(clash)}")
    if offset < 1 or rows < 1:
        raise ValueError("offset and rows are at least 1")
    ranges = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    p = free_prefix(df.columns)
    keys = [*order, *[(t, True) for t in tiebreak]]
    cut = _cells(df, by, keys, ranges, p, aggregate)
    cell = [*by, f"{p}pos"]
    c_ = lambda name: F.col(p + name)

    # Sorting by the other columns too changes no order (the keys are unique); it keeps
    # them in the exchange below, so the cell table and the rows share that exchange.
    used = {c for c, _ in keys} | set(by)
    sorts = [*_sorts(keys), *[F.col(c) for c in sortable(df) if c not in used]]
    w = Window.partitionBy(*cell).orderBy(*sorts)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = offset if lag or lead else 0
    kept = max(edge, max(1, rows - 1) if moving else 0)  # rows a cell shows to its neighbours
    local = {"rn": F.row_number().over(w)}
    if weight:
        local["cum"] = F.sum(weight).over(upto)
    ranks = [o for o in ("rank", "dense_rank") if o in outputs]
    if ranks:
        local |= {f"was{i}": F.lag(c).over(w) for i, (c, _) in enumerate(order)}
    if kept:
        local["cnt"] = F.count(F.lit(1)).over(Window.partitionBy(*cell))
    local |= {f"in_prev_{c}": F.lag(c, offset).over(w) for c in lag} | {f"in_next_{c}": F.lead(c, offset).over(w) for c in lead}
    local |= {f"in_sum_{c}": F.sum(c).over(upto) for c in running}
    span = w.rowsBetween(-(rows - 1), Window.currentRow)
    for c in moving:
        local |= {f"in_total_{c}": F.sum(c).over(span), f"in_n_{c}": F.count(c).over(span)}
    inside = cut.select("*", *[c.alias(p + n) for n, c in local.items()])
    if ranks:
        same = reduce(lambda a, b: a & b, [c_(f"was{i}").eqNullSafe(F.col(c)) for i, (c, _) in enumerate(order)], F.lit(True))
        inside = inside.withColumn(f"{p}new", (c_("rn") == 1) | ~same).select(
            "*", F.sum(c_("new").cast("int")).over(upto).alias(f"{p}dr"),
            F.max(F.when(c_("new"), c_("rn"))).over(upto).alias(f"{p}rk"))

    # one row a cell
    total = F.sum(weight) if weight else F.count(F.lit(1))
    aggs = [total.alias(f"{p}n")]
    if ranks:
        aggs += [F.max(c_("dr")).alias(f"{p}values"), F.max(c_("rk")).alias(f"{p}last_rk")]
        aggs += [f(c, c_("rn")).alias(f"{p}{n}{i}") for i, (c, _) in enumerate(order) for n, f in (("first", F.min_by), ("last", F.max_by))]

    def ends(cols, where, name):
        return [F.sort_array(F.collect_list(F.when(where, F.struct(c_("rn").alias("rn"), F.col(c).alias("v"))))).alias(f"{p}{name}_{c}")
                for c in cols]

    before = list(dict.fromkeys([*lag, *moving]))
    if kept:
        aggs += ends(before, c_("rn") > c_("cnt") - kept, "tail") + ends(lead, c_("rn") <= offset, "head")
    aggs += [F.sum(c).alias(f"{p}all_{c}") for c in running]
    # counts and sums alone need no window below them and are pre-aggregated in each task
    cells = (inside if ranks or kept else cut).groupBy(*cell).agg(*aggs)
    g = Window.partitionBy(*by).orderBy(f"{p}pos")
    whole, past = Window.partitionBy(*by), g.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn(f"{p}before", F.coalesce(F.sum(c_("n")).over(past), F.lit(0)))
    out = [c_("before"), F.sum(c_("n")).over(whole).alias(f"{p}size")]
    if ranks:
        goes_on = reduce(lambda a, b: a & b, [c_(f"first{i}").eqNullSafe(F.lag(c_(f"last{i}")).over(g)) for i in range(len(order))], F.lit(True))
        cells = cells.withColumn(f"{p}on", (F.row_number().over(g) > 1) & goes_on)
        # where the cell's last peers began; a cell all of one run that goes on began earlier
        began = F.when(~(c_("on") & (c_("values") == 1)), c_("before") + c_("last_rk"))
        cells = cells.withColumns({
            f"{p}values_before": F.coalesce(F.sum(c_("values")).over(past), F.lit(0))
            - F.sum(c_("on").cast("int")).over(g.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            f"{p}run": F.last(began, ignorenulls=True).over(past)})
        out += [c_("on"), c_("values_before"), c_("run")]
    def joined(name, frame, last):
        flat = F.flatten(F.collect_list(c_(name)).over(frame))
        return F.when(F.size(flat) <= kept, flat).otherwise(F.slice(flat, -kept if last else 1, kept)).alias(p + name)

    if kept:
        out += [joined(f"tail_{c}", g.rowsBetween(-kept, -1), True) for c in before]
        out += [joined(f"head_{c}", g.rowsBetween(1, kept), False) for c in lead]
    out += [F.sum(c_(f"all_{c}")).over(past).alias(f"{p}past_{c}") for c in running]
    j = _attach(inside, cells.select(*_keyed(cell, p), *out), cell, p)

    made = {}
    if "row_number" in outputs:
        made["row_number"] = (c_("before") + (c_("cum") if weight else c_("rn"))).cast("long" if weight else "int")
    if "rank" in outputs:
        made["rank"] = F.when(c_("on") & (c_("dr") == 1), c_("run")).otherwise(c_("before") + c_("rk")).cast("int")
    if "dense_rank" in outputs:
        made["dense_rank"] = (c_("values_before") + c_("dr")).cast("int")
    if "group_size" in outputs:
        made["group_size"] = c_("size")
    for c in lag:
        there = F.try_element_at(c_(f"tail_{c}"), (c_("rn") - 1 - offset).cast("int"))["v"]
        made[f"prev_{c}"] = F.when(c_("rn") <= offset, there).otherwise(c_(f"in_prev_{c}"))
    for c in lead:
        there = F.try_element_at(c_(f"head_{c}"), (offset - (c_("cnt") - c_("rn"))).cast("int"))["v"]
        made[f"next_{c}"] = F.when(c_("cnt") - c_("rn") < offset, there).otherwise(c_(f"in_next_{c}"))
    for c in running:
        a, b = c_(f"past_{c}"), c_(f"in_sum_{c}")
        made[f"sum_{c}"] = F.coalesce(a + b, a, b)
    for c in moving:
        tail = c_(f"tail_{c}")
        wanted = F.least(F.lit(rows) - c_("rn"), F.size(tail))
        part = F.when(wanted > 0, F.slice(tail, F.size(tail) - wanted + 1, wanted))
        total = _array_sum(part, _sum_type(df, c))
        count = F.size(F.filter(part, lambda e: e["v"].isNotNull()))
        number = c_(f"in_n_{c}") + F.coalesce(count, F.lit(0))
        made[f"mean_{c}"] = F.try_divide((F.coalesce(c_(f"in_total_{c}"), F.lit(0)) + F.coalesce(total, F.lit(0))).cast("double"), number)
    return j.select(*df.columns, *[c.alias(n) for n, c in made.items()])


def _array_sum(array: Column, kind: T.DataType) -> Column:
    return F.aggregate(array, F.lit(0).cast(kind), lambda s, e: (s + F.coalesce(e["v"], F.lit(0))).cast(kind))


def _sum_type(df: DataFrame, name: str) -> T.DataType:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()


def ntile_from_rank(rn: str, size: str, k: int):
    """NTILE(k) from ROW_NUMBER and group size (first n % k buckets get one more)."""
    r = F.col(rn).cast("long")
    n = F.col(size).cast("long")
    q = F.floor(n / k)
    rem = n - q * k
    big = rem * (q + 1)
    return F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor(F.try_divide(r - 1 - big, q)) + 1).cast("int")
