"""Sources, sinks and catalog operators.

All readers return lazy DataFrames; nothing here collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory (columnar scan, pushdown, pruning)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, header: bool = True,
             infer_schema: bool = True, null_value: str | None = None,
             schema=None) -> DataFrame:
    """CSV scan with a header row.

    ``infer_schema`` costs one extra pass over the files; on large inputs pass
    ``schema`` (a DDL string or StructType) instead.  ``null_value`` turns a
    marker such as ``NA`` into a real NULL, so numeric columns infer as numbers.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write a DataFrame as CSV files (one per partition) under ``path``."""
    df.write.mode("overwrite").option("header", header).csv(path)


def sanitize_columns(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name, in one projection."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a catalog table or view by name."""
    return spark.table(name)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a catalog table including its schema.

    With ``path`` the table's files live in that (shared) folder; without it
    they go to the session warehouse.  Overwrite replaces the schema.
    """
    w = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)


def show_tables(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame (namespace, tableName, isTemporary)."""
    if pattern:
        return spark.sql("SHOW TABLES LIKE :pattern", args={"pattern": pattern})
    return spark.sql("SHOW TABLES")


def describe_table(df: DataFrame) -> DataFrame:
    """Schema as rows: (position, col_name, data_type, nullable).

    Built from the DataFrame's schema, so it works for tables, views and
    intermediate results alike (no job runs).
    """
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields, start=1)]
    return spark.createDataFrame(
        rows, "position int, col_name string, data_type string, nullable boolean")


def file_inventory(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """Files under a dataset directory with size and modification time.

    The ``binaryFile`` source lists the files; selecting only metadata columns
    prunes ``content``, so no file body is read.
    """
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(directory)
            .select("path", "length", "modificationTime"))


def preview(df: DataFrame, n: int, order_by: list[str | Column]) -> DataFrame:
    """First ``n`` rows under a unique order (reproducible, unlike bare LIMIT).

    Planned as ``TakeOrderedAndProject``: each task keeps its own top n, the
    driver merges n x tasks rows.
    """
    return df.orderBy(*order_by).limit(n)


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """One-row DataFrame holding ``COUNT(*)`` (stays lazy, joinable)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
