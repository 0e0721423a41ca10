"""Framed and base64 payloads (FMT3, FMT4, FMT5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# frame = magic byte 0, four-byte schema id, body.
MAGIC = b"\x00"
ID_BYTES = 4
HEADER_BYTES = 5

NULL_VALUE = "null value"
SHORT_FRAME = "frame too short"
UNKNOWN_MAGIC = "unknown magic byte"


def frame(body: Column, schema_id: Column) -> Column:
    """Prefix a body with its wire header."""
    header = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 2 * ID_BYTES, "0"))
    return F.concat(F.lit(MAGIC), header, body)


def bad_frame(value: Column) -> Column:
    """Why a value is no frame; null when it is one."""
    return (
        F.when(value.isNull(), F.lit(NULL_VALUE))
        .when(F.length(value) < HEADER_BYTES, F.lit(SHORT_FRAME))
        .when(F.substring(value, 1, 1) != F.lit(MAGIC), F.lit(UNKNOWN_MAGIC))
    )


def schema_id(value: Column) -> Column:
    return F.when(
        bad_frame(value).isNull(),
        F.conv(F.hex(F.substring(value, 2, ID_BYTES)), 16, 10).cast("bigint"))


def body(value: Column) -> Column:
    return F.when(
        bad_frame(value).isNull(),
        F.substr(value, F.lit(HEADER_BYTES + 1)))


def quote_base64(value: Column) -> Column:
    """Binary → base64 as a JSON string literal, on one line."""
    text = F.replace(F.base64(value), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit('"'), text, F.lit('"'))


def unquote_base64(payload: Column) -> Column:
    """Drop one quote at either end and decode; null when it is not base64."""
    return F.try_to_binary(F.regexp_replace(payload, '^"|"$', ""), F.lit("base64"))
