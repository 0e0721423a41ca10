"""Record bodies: JSON, Avro and framed Avro (FMT1, FMT2, FMT6-FMT8, SRC8, SNK3)."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import wire

AVRO_READ = {"mode": "PERMISSIVE"}
FRAMED = "confluent_"


def has_avro(spark: SparkSession) -> bool:
    """Whether Spark's Avro module is on the classpath."""
    from pyspark.sql.avro.functions import to_avro

    try:
        return bool(spark.range(1).select(to_avro("id")).schema)
    except AnalysisException:
        return False


def decode_json(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows with ``decoded`` (false: not a JSON object) and the schema's fields.

    Missing fields are null, so records of an older schema read as the newer one.
    """
    text = F.col(value).cast("string")
    record = F.from_json(text, f"{schema}, _corrupt STRING",
                         {"columnNameOfCorruptRecord": "_corrupt"})
    fields = StructType.fromDDL(schema).fieldNames()
    parsed = df.withColumn("_r", record)
    good = F.col("_r").isNotNull() & F.col("_r._corrupt").isNull() & text.isNotNull()
    return parsed.select(
        *df.columns, good.alias("decoded"),
        *[F.when(good, F.col(f"_r.{f}")).alias(f) for f in fields])


def decode_avro(df: DataFrame, schema: dict, value: str = "value") -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    parsed = df.withColumn("_r", from_avro(F.col(value), json.dumps(schema), AVRO_READ))
    fields = [f["name"] for f in schema["fields"]]
    first = F.col(f"_r.{fields[0]}")
    return parsed.select(
        *df.columns, (F.col("_r").isNotNull() & first.isNotNull()).alias("decoded"),
        *[F.col(f"_r.{f}").alias(f) for f in fields])


def decode_versions(df: DataFrame, kind: str, schema, writers: Mapping[int, object],
                    value: str = "value") -> DataFrame:
    """Fields of framed bodies, each read as its frame's schema id says (FMT1, FMT8).

    ``writers`` has the schema that each id was written with, ``schema`` is the one to
    read it as: DDL text for JSON, record schemas for Avro. A field that the writer lacks
    is null; a frame with any other id has ``decoded`` false.
    """
    body, number = wire.body(F.col(value)), wire.schema_id(F.col(value))
    if kind == "json":
        names = StructType.fromDDL(schema).fieldNames()
        types = {f.name: f.dataType for f in StructType.fromDDL(schema)}

        def parsed(writer) -> Column:
            text = body.cast("string")
            had = set(StructType.fromDDL(writer).fieldNames())
            record = F.from_json(text, f"{writer}, _corrupt STRING",
                                 {"columnNameOfCorruptRecord": "_corrupt"})
            return F.when(record["_corrupt"].isNull() & record.isNotNull(), F.struct(*[
                (record[n] if n in had else F.lit(None)).cast(types[n]).alias(n)
                for n in names]))
    else:
        from pyspark.sql.avro.functions import from_avro

        names = [f["name"] for f in schema["fields"]]

        def parsed(writer) -> Column:
            record = from_avro(body, json.dumps(writer),
                               {**AVRO_READ, "avroSchema": json.dumps(schema)})
            return F.when(record[names[0]].isNotNull(), record)

    record = F.coalesce(*[F.when(number == i, parsed(w)) for i, w in sorted(writers.items())])
    return df.withColumn("_r", record).select(
        *df.columns, F.col("_r").isNotNull().alias("decoded"),
        *[F.col(f"_r.{n}").alias(n) for n in names])


def decode_events(df: DataFrame, fmt: str, schema, value: str = "value",
                  writers: Mapping[int, object] | None = None) -> DataFrame:
    """Fields of a record body; ``decoded`` is false where it cannot be read.

    With ``writers``, framed bodies are read by the schema their frame names
    (``decode_versions``); without, all are taken to be written with ``schema``.

    ``fmt`` is ``json`` or ``avro``, with the prefix ``confluent_`` for framed
    bodies. ``schema`` is DDL text for JSON and a record schema for Avro. A bad
    frame or body gives a row with null fields, never an error.
    """
    framed, kind = _format(fmt)
    if framed and writers:
        return decode_versions(df, kind, schema, writers, value)
    decode = decode_json if kind == "json" else decode_avro
    if not framed:
        return decode(df, schema, value)
    body = df.withColumn("_body", wire.body(F.col(value)))
    return decode(body, schema, "_body").drop("_body")


def _format(fmt: str) -> tuple[bool, str]:
    kind = fmt.removeprefix(FRAMED)
    if kind not in ("json", "avro"):
        raise ValueError(f"unknown format: {fmt}")
    return fmt.startswith(FRAMED), kind


def event_body(columns: list[str], fmt: str, schema: dict | None = None,
               schema_id: int = 1) -> Column:
    """Binary record body of the given columns."""
    record = F.struct(*columns)
    framed, kind = _format(fmt)
    if kind == "json":
        body = F.to_json(record).cast("binary")
    else:
        from pyspark.sql.avro.functions import to_avro

        body = to_avro(record, json.dumps(schema)) if schema else to_avro(record)
    return wire.frame(body, F.lit(schema_id)) if framed else body


def encode_events(df: DataFrame, fmt: str, schema: dict | None = None,
                  key: str | None = None, schema_id: int = 1) -> DataFrame:
    """``key, value`` records of all columns; ``raw`` and ``text`` pass the column
    ``value`` on as bytes or as text."""
    if fmt in ("raw", "text"):
        value = F.col("value").cast("binary" if fmt == "raw" else "string")
    else:
        value = event_body(df.columns, fmt, schema, schema_id)
    value = value.alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def wire_names(df: DataFrame) -> DataFrame:
    """Engine column names → field names of the wire records."""
    def camel(name: str) -> str:
        first, *rest = name.split("_")
        return first + "".join(part.capitalize() for part in rest)

    return df.withColumnsRenamed({c: camel(c) for c in df.columns})


def to_event(decoded: DataFrame) -> DataFrame:
    """Wire fields → engine columns (``schemas.EVENT``); times become timestamps
    and amounts decimals. Columns that are not wire fields are kept."""
    renamed = {
        "eventId": "event_id", "transactionId": "transaction_id",
        "accountId": "account_id", "occurredAt": "occurred_at",
        "merchantId": "merchant_id",
    }
    out = decoded.withColumnsRenamed(renamed)
    if "merchant_id" not in out.columns:
        out = out.withColumn("merchant_id", F.lit(None).cast("string"))
    return (out.withColumn("occurred_at", F.timestamp_millis("occurred_at"))
            .withColumn("amount", F.col("amount").try_cast("decimal(15,2)")))


def with_all_fields(*versions: DataFrame) -> DataFrame:
    """Union of record versions; a field a version lacks is null (FMT8)."""
    out = versions[0]
    for other in versions[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
