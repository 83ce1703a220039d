"""Joins with heavy keys split: the rows of a plain join, no task with a hot key."""

import statistics

import pytest
from pyspark.sql import functions as F

from triplex.operators import joins
from triplex.operators.graph import graph_edges_from_raw
from triplex.operators.matching import subject_as_object_from_raw


def _skewed(spark, n=3000):
    # a third of the rows share key "hot"
    rows = [("hot" if i % 3 == 0 else f"k{i % 97}", i) for i in range(n)] + [(None, -1), (None, -2)]
    return spark.createDataFrame(rows, "k string, v long")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


KEYS = [("hot",), ("k1",), ("k2",), (None,), ("hot",)]


@pytest.mark.parametrize("heavy", [1, 50, 10**6])
def test_same_rows_as_a_plain_semi_join(spark, heavy):
    big, keys = _skewed(spark), spark.createDataFrame(KEYS, "key string")
    on = big.k == keys.key
    assert _rows(joins.semi_join(big, keys, "k", "key", heavy)) == _rows(big.join(keys, on, "left_semi"))


def test_only_heavy_keys_are_listed_and_their_number_is_bounded(spark):
    big = _skewed(spark, 6000)
    found = joins.heavy_keys(big, "k", 1000).collect()
    assert [r["__pieces"] for r in found] == [2]
    assert joins.heavy_keys(big, "k", 1, max_heavy=5).count() == 5
    keys = spark.createDataFrame(KEYS, "key string")
    _, right, _ = joins._dealt(big, joins._distinct(keys, "key"), "k", joins.heavy_keys(big, "k", 1000))
    assert right.count() == 2 + 2  # two pieces of the hot key, one of each other


@pytest.mark.parametrize("heavy", [1, 10**6])
def test_lookup_join_equals_plain_join(spark, heavy):
    big = _skewed(spark, 300)
    table = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "key string, n int")
    for how in ("inner", "left"):
        want = big.join(table, big.k == table.key, how).select("k", "v", "n")
        assert _rows(joins.lookup_join(big, table, "k", "key", how, heavy)) == _rows(want)


def _task_rows(spark, df):
    """Rows that each task of the join's stage gives out, without adaptive merging of partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


NS = "http://rdf.freebase.com/ns/"


@pytest.mark.parametrize("which", ["join", "subjects", "edges"])
def test_no_task_gets_more_than_twice_the_median(spark, which):
    n = 30000
    if which == "join":
        big = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
        out = joins.semi_join(big, big.select(F.col("k").alias("key")), "k", "key", heavy_rows=100)
    else:
        # A third of the triples have one subject and, in turn, one object.
        hot = F.col("id") % 3 == 0
        uri = lambda c: F.concat(F.lit(f"<{NS}m."), c, F.lit(">"))
        own, other = uri(F.col("id").cast("string")), uri((F.col("id") % 9000).cast("string"))
        raw = spark.range(n).select(
            "id",
            F.when(hot & F.lit(which == "subjects"), uri(F.lit("hot"))).otherwise(own).alias("Subject"),
            F.lit(f"<{NS}a.b>").alias("Predicate"),
            F.when(hot & F.lit(which == "edges"), uri(F.lit("0"))).otherwise(F.when(F.col("id") % 7 == 0, uri(F.lit("hot"))).otherwise(other)).alias("Object"),
        )
        raw = raw.withColumn("Object", F.when(F.col("Subject") == f"<{NS}m.hot>", own).otherwise(F.col("Object"))).drop("id")
        out = (subject_as_object_from_raw if which == "subjects" else graph_edges_from_raw)(raw, heavy_rows=100)
    tasks = _task_rows(spark, out)
    assert sum(tasks) > n / 4 and max(tasks) <= 2 * statistics.median(tasks), tasks


def test_building_a_join_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    joins.semi_join(_skewed(spark), spark.createDataFrame(KEYS, "key string"), "k", "key")
    assert set(tracker.getJobIdsForGroup(None)) == before
