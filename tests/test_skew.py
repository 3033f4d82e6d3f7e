"""Running state in segments gives the plain window's result, and the segments are even whatever the order looks like."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitetally.operators import hostlog, listings, robots
from sitetally.operators.skew import SEGMENT, OrderedRows, lookup_join, top_k
from sitetally.plans import adapters as A


@pytest.fixture(scope="module")
def log(spark):
    """A third of all rows belong to one host, and some to none."""
    rows = A.fetch_log(spark, SF_DIR)
    host = F.when(F.col("seq") % 3 == 0, "hot").when(F.col("seq") % 7 == 0, None).otherwise(F.col("host"))
    return rows.withColumn("host", host).cache()


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("operator", [hostlog.error_runs, hostlog.backoff_series, hostlog.politeness, hostlog.host_report,
                                      hostlog.host_states])
def test_log_operators(log, operator):
    assert rows(operator(log, segments=13)) == rows(operator(log, segments=1))


CASES = {
    "outlier": lambda: F.when(F.col("id") == 0, F.lit("1970-01-01").cast("timestamp")).otherwise(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))),
    "equal": lambda: F.lit("2024-05-05").cast("timestamp"),
    "date": lambda: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")),
    "string": lambda: F.concat(F.lit("x"), (F.col("id") * 7919 % 1000).cast("string")),
    "missing": lambda: F.when(F.col("id") > 1500, F.col("id")),
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("key", ["hot", "null"])
def test_segments_are_even_and_right(spark, case, key):
    """One key (or NULL) owns all rows; the order has an outlier, equal values, dates, strings, missing values."""
    hot = F.lit("hot") if key == "hot" else F.lit(None).cast("string")
    df = spark.range(4000).select(hot.alias("k"), CASES[case]().alias("at"), "id")
    cut = OrderedRows.of(df, ["k"], ["at", "id"], segments=8)
    sizes = [r["count"] for r in cut.data.groupBy(SEGMENT).count().collect()]
    assert len(sizes) >= 7 and max(sizes) <= 2 * 4000 / 8
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(cut.running_sum({"n": F.col("id")}).rows()) == rows(df.withColumn("n", F.sum("id").over(w)))


def test_scans_against_plain_windows(log):
    w = Window.partitionBy("host").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    v = F.when(F.col("status") == 200, F.col("seq"))
    plain = log.select("host", "seq", F.last(v, True).over(w).alias("last"),
                       F.coalesce(F.sum("seq").over(w), F.lit(0)).alias("total"))
    split = OrderedRows.of(log, ["host"], ["ts", "seq"], 10).last_known({"last": v}, before=True).running_sum(
        {"total": F.col("seq")}, before=True).rows()
    assert split.count() == log.count()
    assert rows(split.select("host", "seq", "last", "total")) == rows(plain)


def test_asof(log):
    parts = log.select("host", "ts", F.col("seq").alias("id"), "status")
    asks, snaps = parts.where("status = 200").drop("status"), parts.where("status = 404").drop("status")
    assert rows(robots.robots_asof(asks, snaps, 3600, segments=9)) == rows(robots.robots_asof(asks, snaps, 3600, segments=1))


def test_ids(spark):
    """Also for groups that nobody named, and for NULL."""
    df = spark.range(1000).select(F.col("id").alias("seq"), F.nullif((F.col("id") % 5).cast("int"), F.lit(4)).alias("prio"))
    for size in (1, 7):
        out = [(-1 if r.prio is None else r.prio, r.seq) for r in listings.with_ids(df, "prio", ["seq"], size).orderBy("id").collect()]
        assert out == sorted(out) and len(out) == 1000
        ids = listings.with_ids(df, "prio", ["seq"], size).agg(F.min("id"), F.max("id"), F.countDistinct("id"))
        assert tuple(ids.collect()[0]) == (1, 1000, 1000)


def test_progress(log):
    marked = log.withColumn("success", F.coalesce(F.col("status") < 400, F.lit(False)))
    assert rows(hostlog.progress_marks(marked, ("ts", "seq"), segments=11)) == rows(
        hostlog.progress_marks(marked, ("ts", "seq"), segments=1))


def test_budget(spark):
    """In the order of a date and of a text."""
    calls = spark.range(600).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"), "id", F.lit("0.02").cast("decimal(10,4)").alias("unit_cost"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("day"), F.col("id").cast("string").alias("text"))
    for order in (("id",), ("day", "id"), ("text",)):
        assert rows(hostlog.budget_calls(calls, {"b": 100}, order, segments=6)) == rows(
            hostlog.budget_calls(calls, {"b": 100}, order, segments=1))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_is_split_at_a_hot_key(spark, how):
    """Half of the rows have one key, a third none: adaptive execution cuts their partitions."""
    left = spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(
        F.col("id").cast("string")).alias("k"), F.repeat(F.lit("x"), 20).alias("v"))
    right = spark.createDataFrame([("hot", 1), ("5", 2), ("9", 3)], "k string, w int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup_join(left.repartition(6, "id"), right, "k", how)
        got = len(joined.collect())
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    plain = {"left": 60_000, "inner": 30_002, "left_semi": 30_002, "left_anti": 29_998}
    assert got == plain[how]


def test_top_k_limits_before_the_shuffle(log):
    plan = top_k(log, ["host"], [F.col("seq")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
