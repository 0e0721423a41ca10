"""Small tables with the odd rows that every operator must take."""

import random

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "metrics string, size string, `group` string, class string, key string, h string")
TAIL = ("m", "s", "g", "c", "k", "h")


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
                    for _ in range(n))


LONG = words(1, 30_000)
PASSAGE = words(2, 40)


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, words(3, 60), "en", "src0", 1), (1, words(3, 60), "en", "src0", 1),
        (1, words(4, 50), "en", "src1", 1), (2, None, "en", "src0", None),
        (3, "", None, None, 0), (None, words(5, 30), None, None, None),
        (None, None, None, None, None), (None, None, None, None, None),
        (4, "   \n\t ", "de", "src2", 4), (5, LONG, "en", "src0", len(LONG)),
        (6, LONG + " tail", "en", "src0", len(LONG)), (7, "one two", "en", "src0", 7),
        (8, words(3, 60), "en", "src3", 1), (9, f"x {PASSAGE} y", "en", "other", 1),
        (10, "Ünï " * 40, "en", "src0", 1)]
    return spark.createDataFrame([r + TAIL for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")
