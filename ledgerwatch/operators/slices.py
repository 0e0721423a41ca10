"""Running results over one ordered sequence, computed slice by slice.

A running value per key needs the key's rows in order. Sorting all rows of a key
in one task fails when the key holds a large share of the data, so the sequence
is cut into slices: every slice is one task-sized group, and what earlier slices
contribute comes in as one extra row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durations import epoch_micros, floor_to, micros

TIME_SLICE = "1 minute"
OFFSET_SLICE = 1_000_000


def slice_of(df: DataFrame, column: str, slice_len: str | int | None = None) -> Column:
    """Slice of a row by its position: a timestamp, cut by a duration, or an offset,
    whose slices hold at most ``slice_len`` rows of one sequence."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return floor_to(epoch_micros(F.col(column)), micros(slice_len or TIME_SLICE))
    return floor_to(F.col(column).cast("bigint"), int(slice_len or OFFSET_SLICE))


def earlier(df: DataFrame, keys: list[str], slice_col: str, value: Column, name: str,
            fold: Callable[[str | Column], Column] = F.max) -> DataFrame:
    """Per key and slice, ``value`` folded over all earlier slices (max or sum).

    The aggregate is combined map-side; the running window then sees one row
    per key and slice. Slices without an earlier one are left out.
    """
    per_slice = df.groupBy(*keys, slice_col).agg(fold(value).alias("_slice_value"))
    before = (W.partitionBy(*keys).orderBy(slice_col)
              .rowsBetween(W.unboundedPreceding, -1))
    return (per_slice.withColumn(name, fold("_slice_value").over(before))
            .drop("_slice_value").filter(F.col(name).isNotNull()))


def running(df: DataFrame, keys: list[str], order_by: list[str], value: Column,
            name: str, fold: Callable[[str | Column], Column] = F.max,
            slice_len: str | int | None = None) -> DataFrame:
    """Every row with ``value`` folded over its key's rows up to it.

    ``order_by`` orders the rows of a key uniquely; its first column cuts them into
    slices. Rows are shuffled once.
    """
    rows = (df.withColumn("_slice", slice_of(df, order_by[0], slice_len))
            .withColumn("_value", value).withColumn("_carried", F.lit(False)))
    carried = (earlier(rows, keys, "_slice", F.col("_value"), "_value", fold)
               .withColumn("_carried", F.lit(True)))
    so_far = (W.partitionBy(*keys, "_slice")
              .orderBy(F.col("_carried").desc(), *order_by)
              .rowsBetween(W.unboundedPreceding, 0))
    return (rows.unionByName(carried, allowMissingColumns=True)
            .withColumn(name, fold("_value").over(so_far))
            .filter(~F.col("_carried")).select(*df.columns, name))
