"""The reference's input tables, re-derived from the provided parquet tables.

The reference queries flights / airlines / airports / diamonds / usarrests /
iris tables; the test data is a TPC-H-like star schema.  Each function below
builds the role table lazily from the given tables (column pruning and filter
pushdown still reach the parquet scans).  The mapping is fixed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.functions.calendar import as_date
from lumen.sources.tables import load_table

# Unique row order of `trips` (used to break ties reproducibly).
TRIPS_TIEBREAK = ["flight", "leg", "part_key", "dest", "fare"]

# The moduli that blank out delays, giving the NULLs the
# reference's cleaning queries expect (see FIXTURES.md §2).
ARR_DELAY_NULL_MOD = 37
DEP_DELAY_NULL_MOD = 41
EVENT_VALUE_NULL_MOD = 37


def trips(spark: SparkSession, sf_dir: str, with_orders: bool = True) -> DataFrame:
    """Flights role: one row per line item.

    ``with_orders=False`` is for queries that need no order column (carrier,
    arr_delay): the join with orders becomes a semi-join on its key, so a line
    item without an order is left out here as well.
    """
    li = load_table(spark, sf_dir, "lineitem")
    ship = as_date("l_shipdate")
    cols = [
        F.year(ship).alias("year"),
        F.month(ship).alias("month"),
        F.dayofmonth(ship).alias("day"),
        ship.alias("flight_date"),
        F.col("l_orderkey").alias("flight"),
        F.col("l_suppkey").alias("dest"),
        F.when(F.col("l_orderkey") % DEP_DELAY_NULL_MOD != 0,
               (F.col("l_quantity") - 25).cast("int")).alias("dep_delay"),
        F.col("l_quantity").cast("int").alias("air_time"),
        F.col("l_linenumber").alias("leg"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_extendedprice").alias("fare"),
    ]
    if not with_orders:
        keys = load_table(spark, sf_dir, "orders").select("o_orderkey")
        return li.join(keys, li["l_orderkey"] == keys["o_orderkey"], "left_semi").select(*cols)
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    # Both sides are fact-sized: a shuffle (sort-merge) join on the order key,
    # which is unique in orders, so no key is hot.
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return j.select(
        *cols,
        F.col("o_orderpriority").alias("carrier"),
        F.when(F.col("l_orderkey") % ARR_DELAY_NULL_MOD != 0,
               F.datediff(ship, as_date("o_orderdate"))).alias("arr_delay"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports role: supplier (faa = s_suppkey, name = s_name)."""
    return (load_table(spark, sf_dir, "supplier")
            .select(F.col("s_suppkey").alias("faa"), F.col("s_name").alias("name")))


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airlines role: nation (carrier_code = n_nationkey, name = n_name)."""
    return (load_table(spark, sf_dir, "nation")
            .select(F.col("n_nationkey").alias("carrier_code"), F.col("n_name").alias("name")))


def supplier_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dest (supplier key) → carrier_code (its nation): the airline of a trip."""
    return (load_table(spark, sf_dir, "supplier")
            .select(F.col("s_suppkey").alias("dest"), F.col("s_nationkey").alias("carrier_code")))


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds role: part (cut = p_type, color = p_brand, carat = p_size,
    price = p_retailprice, clarity = p_name)."""
    return load_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("diamond_id"),
        F.col("p_type").alias("cut"),
        F.col("p_brand").alias("color"),
        F.col("p_name").alias("clarity"),
        F.col("p_size").alias("carat"),
        F.col("p_retailprice").alias("price"),
    )


def usarrests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """US-arrests role: customer (first column = name, Murder = c_acctbal)."""
    return load_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("state"),
        F.col("c_acctbal").alias("Murder"),
        F.col("c_nationkey").alias("Assault"),
        F.col("c_custkey").alias("UrbanPop"),
    )


def iris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Iris role: the first four embedding dimensions, label as species."""
    e = F.col("embedding")
    return load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("iris_id"),
        e[0].cast("double").alias("sepal_length"),
        e[1].cast("double").alias("sepal_width"),
        e[2].cast("double").alias("petal_length"),
        e[3].cast("double").alias("petal_width"),
        F.col("label").alias("species"),
    )


IRIS_MEASURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


def event_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-of-day and outlier role: events (carrier = event_type, value with
    NULLs, hour = hour(ts), day = date(ts))."""
    return load_table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("user_id"),
        F.col("event_type").alias("carrier"),
        F.hour("ts").alias("hour"),
        as_date("ts").alias("day"),
        F.when(F.col("event_id") % EVENT_VALUE_NULL_MOD != 0, F.col("value")).alias("value"),
    )
