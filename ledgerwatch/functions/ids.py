"""Stable identifiers (FN1, FLT7).

A random id would change when a lost task is run again, or differ between two
tables written from one plan. Ids are therefore hashes of what they identify.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = ("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-"
                "[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")


def _joined(parts) -> Column:
    """Parts with their lengths, ``-`` for null: different parts, different text."""
    def marked(part: Column) -> Column:
        text = part.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))

    return F.concat(*[marked(p) for p in parts])


def alert_id(*parts: Column) -> Column:
    return F.sha2(_joined(parts), 256)


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped text made from the MD5 of ``parts``."""
    return F.regexp_replace(
        F.md5(_joined(parts)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5")


def is_uuid(text: Column) -> Column:
    """Whether a text has all 36 characters; shorter groups of digits are refused."""
    return F.coalesce(text.cast("string").rlike(UUID_PATTERN), F.lit(False))
