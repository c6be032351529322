"""Interval joins where one key has very many right rows within one bucket."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardline.operators.joins import interval_join

LEFT, RIGHT = "k int, a timestamp_ntz, l int", "rk int, b timestamp_ntz, r int"


def sides(spark, n_left, n_right, hot, hot_days, seed=1):
    """A third of both sides belongs to key 7, within some days."""
    rng = random.Random(seed)

    def row(i):
        if rng.random() < hot:
            return 7, dt.datetime(2024, 3, 10) + dt.timedelta(minutes=rng.randrange(1440 * hot_days)), i
        return rng.randrange(40), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(1440 * 365)), i

    left, right = [row(i) for i in range(n_left)], [row(i) for i in range(n_right)]
    left += [(None, dt.datetime(2024, 3, 10), -1), (7, None, -2), (7, dt.datetime(2024, 3, 2), -3), (7, dt.datetime(2024, 3, 8), -4)]
    right += [(None, dt.datetime(2024, 3, 10), -1), (7, None, -2)]
    return left, right


def brute(left, right, before, after):
    out = Counter()
    for k, a, l in left:
        met = [
            (k, a, l, rk, b, r)
            for rk, b, r in right
            if k is not None and k == rk and a and b and a - dt.timedelta(days=before) <= b <= a + dt.timedelta(days=after)
        ]
        out.update(met or [(k, a, l, None, None, None)])
    return out


@pytest.mark.parametrize("piece_rows", [5, 60, 100_000])
@pytest.mark.parametrize("before, after, hot_days", [(2, 2, 4), (0, 1, 2), (3, 0, 1)])
def test_split_buckets_give_the_same_rows(spark, piece_rows, before, after, hot_days):
    left, right = sides(spark, 120, 300, 0.33, hot_days)
    expected = brute(left, right, before, after)
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    for how in ("left", "inner"):
        out = interval_join(l, r, [("k", "rk")], "a", "b", before, after, how, piece_rows)
        assert out.columns == ["k", "a", "l", "rk", "b", "r"]
        want = expected if how == "left" else Counter({x: n for x, n in expected.items() if x[3] is not None})
        assert Counter(tuple(x) for x in out.collect()) == want


def test_left_rows_between_the_times_of_a_split_bucket(spark):
    # Many right rows on two days; left rows whose span ends before, between and after them.
    first, second = dt.datetime(2024, 3, 9, 1), dt.datetime(2024, 3, 11, 23)
    right = [(7, first + dt.timedelta(seconds=i), i) for i in range(50)] + [(7, second, i) for i in range(50)]
    left = [(7, dt.datetime(2024, 3, 8) + dt.timedelta(hours=h), h) for h in range(-30, 130)]
    out = interval_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), [("k", "rk")], "a", "b", 0, 1, "left", 9)
    assert Counter(tuple(x) for x in out.collect()) == brute(left, right, 0, 1)


def test_another_table_may_be_counted(spark):
    left, right = sides(spark, 60, 200, 0.5, 3)
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    more = r.unionByName(r).select(F.col("rk").alias("patient"), F.col("b").alias("day"))
    out = interval_join(l, r, [("k", "rk")], "a", "b", how="left", piece_rows=20, counted=(more, ["patient"], "day"))
    assert Counter(tuple(x) for x in out.collect()) == brute(left, right, 2, 2)


def test_no_task_holds_a_hot_bucket(spark):
    """Rows of the right side per task, with a patient that has a third of them within four days."""
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        right = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("rk"),
            F.expr("timestamp_ntz'2024-03-10' + make_dt_interval(0, 0, cast(id % 1440 * 4 as int))").alias("b"),
            F.col("id").cast("int").alias("r"),
        )
        left = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.expr("timestamp_ntz'2024-03-11'").alias("a"), F.lit(1).alias("l"))
        tasks = {}
        for pieces in (None, 500):
            out = interval_join(left, right, [("k", "rk")], "a", "b", how="left", piece_rows=pieces)
            per_task = out.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()
            sizes = sorted(r["count"] for r in per_task)
            tasks[pieces] = sizes[-1] / sizes[len(sizes) // 2]
        assert tasks[None] > 5 and tasks[500] < 3
    finally:
        spark.conf.set(key, "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
