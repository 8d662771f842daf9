"""Join helpers (J1–J3): dimension joins, hot keys and semi-join membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.operators.ordered import free_prefix, shared, sortable
from lumen.session import scratch_dir

def materialize_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: the plan runs once and later jobs start from the files (lineage
    cut; lost executors recompute nothing)."""
    path = scratch_dir(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact × dimension join.  Nothing is hinted: Spark broadcasts the dimension
    where its size in bytes, estimated from the files or measured by AQE at its
    exchange, is within ``spark.sql.autoBroadcastJoinThreshold``, else both sides are
    shuffled and AQE splits partitions that a hot key fills."""
    return fact.join(dim, on, how)


def join_salted(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner",
                heavy: int = 64, share: float = 0.01, salts: int = 16) -> DataFrame:
    """Fact × dimension join for a dimension too large to broadcast and a fact with hot keys.

    A frequent-items sketch of the fact's key (``approx_top_k``) names at most
    ``heavy`` keys that hold more than ``share`` of the rows.  Rows with such a key are
    dealt over ``salts`` partitions by a hash of the row, and the dimension's
    rows with it are repeated for each; all other rows join on the key alone.
    The sketch only decides where rows go, so its errors cannot change the
    result.  ``how``: inner or left.  Nothing runs while the plan is built.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_salted is for inner and left joins")
    p = free_prefix(fact.columns, dim.columns)
    top = fact.agg(F.expr(f"approx_top_k(`{fact_key}`, {heavy})").alias("top"), F.count(F.lit(1)).alias("n"))
    hot = F.transform(F.filter("top", lambda t: t["count"] > F.col("n") * share), lambda t: t["item"])
    hot = top.select(F.coalesce(hot, F.array().cast(f"array<{fact.schema[fact_key].dataType.simpleString()}>")).alias(f"{p}hot"))
    is_hot = lambda key: F.coalesce(F.array_contains(f"{p}hot", F.col(key)), F.lit(False))
    deal = F.pmod(F.xxhash64(*sortable(fact)), F.lit(salts)).cast("int")
    rows = fact.crossJoin(F.broadcast(hot)).withColumn(  # one row
        f"{p}salt", F.when(is_hot(fact_key), deal).otherwise(F.lit(0))).drop(f"{p}hot")
    every = F.sequence(F.lit(0), F.when(is_hot(dim_key), F.lit(salts - 1)).otherwise(F.lit(0)))
    side = dim.crossJoin(F.broadcast(hot)).withColumn(f"{p}at", F.explode(every)).drop(f"{p}hot")
    cond = (F.col(fact_key) == F.col(dim_key)) if fact_key != dim_key else (rows[fact_key] == side[dim_key])
    out = rows.join(side, cond & (F.col(f"{p}salt") == F.col(f"{p}at")), how).drop(f"{p}salt", f"{p}at")
    return out if fact_key != dim_key else out.drop(side[dim_key])


def top_k_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-NULL values of ``key`` (ties by key value).

    Partial counts per task, one shuffle of (key, count) pairs, then a
    ``TakeOrderedAndProject`` of k rows: the result has at most k rows.
    """
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.col("_n").desc(), F.col(key).asc())
            .limit(k)
            .select(key))


# Of the frequent-items sketch, and what it proves: its error is at most 3.5 / map size of
# the rows, the map is larger than TRACKED / 0.75, and a key that is not returned may
# have twice the error.
TRACKED = 10_000
UNSEEN = 2 * 3.5 * 0.75 / TRACKED


def top_k_verified(df: DataFrame, key: str, k: int, name: str = "count") -> DataFrame:
    """``top_k_keys`` with exact counts, for keys too many to shuffle.

    A frequent-items sketch names at most ``TRACKED`` candidates; a second read
    counts those exactly, in partial aggregates that hold only candidates.  No other
    key can occur in more than ``UNSEEN`` of the rows, so a k-th candidate with more
    proves the result.  Where it does not (flat distributions, fewer candidates than
    ``k``), all keys are counted instead: that branch joins a table that is empty
    once the result is proved, and Spark then drops it unread.
    """
    p = free_prefix(df.columns, [name])
    rows = df.where(F.col(key).isNotNull()).select(key)
    sketch = shared(rows.agg(F.expr(f"approx_top_k(`{key}`, {TRACKED}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")))
    wanted = sketch.select(F.explode("top.item").alias(f"{p}wanted"))
    counted = (rows.join(F.broadcast(wanted), F.col(key) == F.col(f"{p}wanted"), "left_semi")  # at most TRACKED
               .groupBy(key).agg(F.count(F.lit(1)).alias(name)))
    best = shared(counted.orderBy(F.desc(name), key).limit(k))
    proof = best.agg(F.count(F.lit(1)).alias("found"), F.min(name).alias("least")).crossJoin(F.broadcast(sketch.select("n"))).select(
        ((F.col("found") == k) & (F.col("least") > F.col("n") * UNSEEN)).alias(f"{p}proved"))
    proved = best.crossJoin(F.broadcast(proof)).where(f"{p}proved").select(key, name)
    every = (rows.crossJoin(F.broadcast(proof.where(f"NOT coalesce({p}proved, false)"))).groupBy(key)
             .agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key).limit(k))
    return proved.unionByName(every)


def keep_top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose ``key`` is among the k most frequent (``isin`` of a top-k list),
    as a left-semi join against a broadcast of at most k keys."""
    return df.join(F.broadcast(top_k_keys(df, key, k)), key, "left_semi")


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    The one-row side is broadcast (its size is one row by construction).
    """
    return df.crossJoin(F.broadcast(one_row))
