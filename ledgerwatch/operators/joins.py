"""Lookups in a side with one row per key.

The join is left to Spark: it broadcasts a side that is under its threshold, and
adaptive execution splits the partitions of hot keys of a shuffle join at run time
(``spark.sql.adaptive.skewJoin``), in batch and in stateless micro-batches. Nothing runs
while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(left: DataFrame, right: DataFrame, on: str | list[str],
                how: str = "inner") -> DataFrame:
    """Join ``left`` with a side that has one row per key.

    ``how`` is inner, left, left_semi or left_anti. For the last two the lookup side may
    repeat keys: repeats are folded within tasks before the shuffle, so a key that it
    holds often is one row for each task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    return left.join(right, keys, how)
