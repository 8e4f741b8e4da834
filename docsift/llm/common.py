"""Shared steps of the training-data operators."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import scratch_path, spent_shuffles

# a table of at most this many narrow rows (a few longs each) may be broadcast
BROADCAST_ROWS = 1_000_000


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the lineage ends there, so a lost executor never recomputes it, and
    later reads prune its columns."""
    path = scratch_path(df.sparkSession, name)
    with spent_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a narrow table whose counted ``rows`` are within
    :data:`BROADCAST_ROWS`; a larger one is left to a shuffled join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_bounds(df: DataFrame, key: str, ranges: int) -> list[int]:
    """Lower bounds (values that occur) of about ``ranges`` ranges of a long
    key with equal numbers of rows.  A narrow job reads the key column only
    and returns ``ranges`` values; the same data give the same bounds, unlike
    the sampling of ``repartitionByRange``."""
    steps = [i / ranges for i in range(ranges)]
    row = df.select(F.min(key).alias("lo"),
                    F.percentile_approx(key, steps, 10 * ranges).alias("q")).first()
    if row["lo"] is None:
        return []
    return sorted({row["lo"], *(v for v in row["q"] if v > row["lo"])})


def range_number(key: Column, bounds: list[int]) -> Column:
    """Number of the range that holds a key (0 below the first bound or null).
    A JVM expression: a Python step here would buffer whole texts.  A key meets
    the first bound of every group of bounds, then its own group's: some
    ``2 * sqrt(ranges)`` comparisons a row."""
    if not bounds:
        return F.lit(0)
    wide = math.isqrt(len(bounds) - 1) + 1

    def upto(of: Column) -> Column:
        return F.size(F.filter(of, lambda x: x <= key))

    group = F.greatest(F.lit(0), upto(F.array(*[F.lit(b) for b in bounds[::wide]])) - 1)
    groups = F.array(*[F.array(*[F.lit(b) for b in bounds[at:at + wide]]) for at in range(0, len(bounds), wide)])
    below = group * wide + upto(F.get(groups, group))
    return F.when(key.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), below - 1)).cast("int")


def dealt(df: DataFrame, number: str, ranges: int) -> DataFrame:
    """Every range as a partition of its own, dealt by its number: hashed
    numbers would leave some tasks several ranges and others none."""
    return df.repartitionById(max(1, ranges), F.col(number))


def packed(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name] for f in schema], schema=schema)
