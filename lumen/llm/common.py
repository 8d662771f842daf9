"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumen.session import scratch_dir

# A side is broadcast only when its written copy is measured to be at most this large.
BROADCAST_BYTES = 16_000_000


def write_once(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    The plan runs once, the lineage is cut, and a lost executor loses nothing.
    """
    path = scratch_dir(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hint_small(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a written table for broadcast if its rows take at most ``most`` bytes
    (eight a row and fixed-width column, strings and arrays as long as they are);
    otherwise return it unchanged, and the join shuffles."""
    width = F.lit(8 * (len(table.columns) + 1))
    for f in table.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + 8 * F.greatest(F.size(f.name), F.lit(0))
    size = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(table) if size <= most else table


def arrow_map(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType) -> DataFrame:
    """Apply ``fn`` (dict of Arrow columns -> dict of column values) batch by batch.

    Batches stay Arrow end to end, so 64-bit integers and nulls pass unchanged.
    """
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        want = to_arrow_schema(schema)
        for b in batches:
            out = fn({n: b.column(i) for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [c.cast(want.field(n).type) if isinstance(c := out[n], pa.Array) else pa.array(c, want.field(n).type)
                 for n in names], names=names)
        gc.collect()  # a reused worker else keeps the helpers of earlier tasks for long

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """The column's strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
