"""Lookup of the version that was current at a time (JN1).

Rows and versions of a key are one sequence in time; the version a row meets is the running
maximum of the versions before it. The sequence is cut into slices and every slice begins
with the last version of the earlier ones, so an account with a third of all rows, or of all
versions, is many tasks, and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import running

SLICE = "1 hour"


def current_versions(rows: DataFrame, versions: DataFrame, key: str = "account_id",
                     at: str = "occurred_at", since: str = "since",
                     order_by: Sequence[str] = (), deleted: Column | None = None,
                     how: str = "inner", slice_len: str | int | None = SLICE) -> DataFrame:
    """``rows`` with the columns of their key's version that was current at ``at``.

    A version holds from ``since`` on, that moment included, until the next one.
    ``order_by`` ranks versions of one moment, and their other columns those equal in it.
    Where ``deleted`` is true the key has no version from then on. Rows without a version,
    a key or a time are left out, or with ``how="left"`` have nulls. Versions without a key
    or a time are no versions. ``at`` and ``since`` are timestamps or offsets; slices of
    ``slice_len`` are the groups a task sorts.
    """
    values = [since, *order_by]
    values += [c for c in versions.columns if c != key and c not in values]
    clash = set(values) & set(rows.columns)
    if clash:
        raise ValueError(f"rows and versions both have {sorted(clash)}")
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how}")
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    version = F.struct(F.struct(*values).alias("row"), gone.alias("gone"))
    points = versions.dropna(subset=[key, since]).select(
        key, F.col(since).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    asked = rows.select(key, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                        F.struct(*rows.columns).alias("_asked"))
    met = (running(asked.unionByName(points, allowMissingColumns=True), [key],
                   ["_at", "_kind"], F.col("_version"), "_current", slice_len=slice_len)
           .filter(F.col("_kind") == 1))
    live = F.col("_current").isNotNull() & ~F.col("_current.gone")
    if how == "inner":
        met = met.filter(live)
    return met.select("_asked.*", *[
        F.when(live, F.col("_current.row")[v]).alias(v) for v in values])
