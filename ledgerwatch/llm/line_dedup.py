"""Repeated passages of three consecutive lines.

A window is three lines that follow each other in a document (cut at ``\\n``, blank
lines left out, spaces, tabs and carriage returns at the ends ignored, those inside
compared as they are). The first window of the corpus with given lines, in order of document and place, stays; the
lines covered by any later one are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _with_lines(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``__lw_key`` (hash of the text) and ``__lw_lines``."""
    return docs.withColumns({
        "__lw_key": F.xxhash64(F.col(text)),
        "__lw_lines": F.split(F.coalesce(F.col(text), F.lit("")), "\n")})


def _line_hashes(lines: Column) -> Column:
    """Places and two hashes of the lines that are not blank."""
    plain = F.transform(lines, lambda x, i: F.struct(
        i.alias("at"),
        F.btrim(x, F.lit(" \t\r")).alias("t")))
    return F.transform(F.filter(plain, lambda x: x["t"] != ""), lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["t"]).alias("h"),
        F.xxhash64(x["t"], F.lit(1)).alias("g")))


def covered_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``__lw_key``, ``__lw_gone``: places of the lines to remove, for each
    document that has any.

    A window's rows are first reduced to its first occurrence, within tasks before the
    shuffle; the occurrences are then joined to it, where Spark splits large keys.
    Windows are compared by 128 bits of hashes.
    """
    hashed = (_with_lines(docs.select(doc, text), text)
              .select(F.col(doc).alias("d"), F.col("__lw_key").alias("k"),
                      _line_hashes(F.col("__lw_lines")).alias("x")))
    last = F.size("x") - WINDOW
    three = [F.get("x", F.col("i") + n) for n in range(WINDOW)]
    found = (hashed.filter(last >= 0)
             .withColumn("i", F.explode(F.sequence(F.lit(0), last)))
             .select("d", "k", F.xxhash64(*[x["h"] for x in three]).alias("h"),
                     F.xxhash64(*[x["g"] for x in three]).alias("g"),
                     F.array(*[x["at"] for x in three]).alias("at")))
    place = F.struct("d", "k", F.get("at", F.lit(0)).alias("i"))
    first = (found.groupBy("h", "g").agg(F.min(place).alias("first"),
                                         F.max(place).alias("last"))
             .filter("first < last"))
    later = found.join(first, ["h", "g"]).filter(place > F.col("first"))
    return (later.select("d", "k", F.explode("at").alias("i")).distinct()
            .groupBy("d", "k").agg(F.collect_list("i").alias("__lw_gone"))
            .select(F.col("d").alias(doc), F.col("k").alias("__lw_key"), "__lw_gone"))


def remove_repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                          out: str = "line_dedup") -> DataFrame:
    """``docs`` with a struct column ``out``: ``text`` (the lines that stay, joined by
    ``\\n``), ``n_lines``, ``n_removed``.

    Order of occurrence: document id (null first), hash of the text, place. Rows with
    equal id and text are one document: they do not count as copies of each other.
    Null text stays null and has no lines; an empty one has one blank line. Blank
    lines belong to no window and stay. Other columns stay (names that begin with
    ``__lw_`` are reserved).
    """
    lined = _with_lines(docs, text)
    gone = covered_lines(docs, doc, text).withColumnsRenamed(
        {doc: "__lw_doc", "__lw_key": "__lw_hash"})
    joined = lined.join(gone, F.col(doc).eqNullSafe(F.col("__lw_doc"))
                        & (F.col("__lw_key") == F.col("__lw_hash")), "left")
    lines, removed = F.col("__lw_lines"), F.col("__lw_gone")
    kept = F.when(removed.isNull(), F.col(text)).otherwise(F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed),
        lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *[lined[c] for c in docs.columns if c != out],
        F.struct(kept.alias("text"),
                 F.when(F.col(text).isNull(), 0).otherwise(F.size(lines))
                 .cast("long").alias("n_lines"),
                 F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed"))
        .alias(out))


def line_report(docs: DataFrame) -> DataFrame:
    """A digest row for each document."""
    cleaned = remove_repeated_lines(docs.select("doc_id", "text"))
    return cleaned.select(
        "doc_id", F.col("line_dedup.n_lines").alias("n_lines"),
        F.col("line_dedup.n_removed").alias("n_removed"),
        F.sha2(F.coalesce("line_dedup.text", F.lit("")), 256).alias("kept_sha256"))
