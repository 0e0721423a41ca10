import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import joins


@pytest.fixture
def shuffled(spark):
    """Shuffle joins, and skew recognised at the size of a test."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def sides(spark, n=6000):
    left = spark.range(n).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null "
        "else concat('k', id % 700) end as k", "id as v")
    right = spark.range(600).selectExpr("concat('k', id) as k", "id as w").unionByName(
        spark.createDataFrame([("hot", -1)], "k STRING, w LONG"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(spark, shuffled, how):
    left, right = sides(spark)
    got = joins.lookup_join(left, right, "k", how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_split(spark, shuffled, how, capsys):
    left, right = sides(spark, 600_000)
    left = left.withColumn("pad", F.sha2(F.col("v").cast("string"), 256)).repartition(8)
    joined = joins.lookup_join(left, right, "k", how)
    joined.collect()
    joined.explain()
    assert "skew=true" in capsys.readouterr().out


def test_defining_a_join_runs_nothing(spark, shuffled):
    left, right = sides(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job expected")
    joins.lookup_join(left, right, "k")
    assert list(tracker.getJobIdsForGroup("lazy")) == []


def test_two_key_columns(spark, shuffled):
    left = spark.range(3000).selectExpr("id % 2 as a", "'x' as b", "id as v")
    right = spark.createDataFrame([(0, "x", 10), (1, "y", 20)], "a LONG, b STRING, w INT")
    got = joins.lookup_join(left, right, ["a", "b"], "left")
    assert got.count() == 3000
    assert got.filter("w = 10").count() == 1500


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_repeated_lookup_keys_are_folded_first(spark, shuffled, how, capsys):
    left, right = sides(spark)
    repeated = right.crossJoin(spark.range(5).select(F.col("id").alias("copy")))
    got = joins.lookup_join(left, repeated, "k", how)
    got.explain()
    assert "HashAggregate" in capsys.readouterr().out
    assert got.count() == left.join(right, "k", how).count()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_empty_sides(spark, shuffled, how):
    left, right = sides(spark)
    assert joins.lookup_join(left.filter("v < 0"), right, "k", how).count() == 0
    kept = joins.lookup_join(left, right.filter("w < -5"), "k", how).count()
    assert kept == (6000 if how in ("left", "left_anti") else 0)
