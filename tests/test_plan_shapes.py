"""What the physical plans look like: pruning, pushdown, shuffles, and the handling of hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, final_plan, plan_of
from fareloom.catalog import mapping
from fareloom.catalog import trips as catalog
from fareloom.operators import filters, percentiles, sessions, windows
from fareloom.operators.aggregates import top_k
from fareloom.plans import activity, marts, questions


@pytest.fixture()
def conf(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scan(df, word):
    return next(line for line in plan_of(df).splitlines() if "FileScan" in line and word in line)


def exchanges(df):
    plan = plan_of(df).split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange hashpartitioning", plan))


def test_day_bounds_and_columns_reach_the_scan(spark):
    events = mapping.table(spark, SF_DIR, "events").withColumnRenamed("ts", "created_at")
    line = scan(activity.event_type_counts(events, "2024-01-05", "2024-01-25"), "event_type")
    pushed = line.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in line


def test_only_needed_tables_and_columns_are_read(spark):
    zones = mapping.raw_zones(spark, SF_DIR)
    df = questions.least_frequent_zone(mapping.trips(spark, SF_DIR, start=False, dropoff=False), zones)
    assert "ReadSchema: struct<l_suppkey:bigint>" in scan(df, "l_suppkey")
    assert "o_orderkey" not in plan_of(df)
    assert "TakeOrderedAndProject" in plan_of(df)


def test_trips_are_counted_before_they_meet_the_zones(spark):
    zones = mapping.raw_zones(spark, SF_DIR)
    plan = plan_of(questions.pickups_by_zone(
        mapping.trips(spark, SF_DIR, start=False, dropoff=False), zones))
    zone_join = plan.index("locationid") if "locationid" in plan else plan.index("_pk")
    assert "partial_count" in plan[zone_join:]


def test_zones_are_broadcast_by_their_size(spark):
    plan = plan_of(catalog.fact(spark, SF_DIR))
    assert plan.count("BroadcastHashJoin [pickup_locationid") == 1
    assert plan.count("BroadcastHashJoin [dropoff_locationid") == 1


def test_lines_and_orders_are_never_broadcast(spark):
    assert "SortMergeJoin [l_orderkey" in plan_of(mapping.trips(spark, SF_DIR))


def test_dedup_cuts_copies_before_the_shuffle(spark):
    df = windows.dedup_first(mapping.table(spark, SF_DIR, "lineitem"),
                             ["l_orderkey", "l_linenumber"], ["l_partkey"])
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan[plan.index("Exchange"):]


def test_the_wide_mart_adds_one_shuffle(spark, conf):
    conf(adaptive__enabled="false")
    fact = catalog.fact(spark, SF_DIR)
    assert exchanges(marts.monthly_zone_revenue(fact)) == exchanges(fact) + 1


def test_growth_uses_one_window(spark):
    df = spark.createDataFrame([("g", 1, 2019, 1.0)], "s string, q int, year int, total double")
    assert len(re.findall(r"\bWindow \[", plan_of(windows.yoy(df, ["s", "q"], "year", "total")))) == 1


def test_only_values_inside_a_bracket_are_shuffled(spark):
    """A hot group sends counts and a few thousandths of its values through the two counting shuffles."""
    rows = spark.range(0, 200_000, 1, 8).select(F.struct(F.lit(1).alias("k")).alias("g"), (F.col("id") / 7).alias("v"))
    brackets = percentiles._brackets(rows, [0.5, 0.9], percentiles.MARGIN / percentiles.ACCURACY)
    below, inside = percentiles._inside(rows, brackets, range(2))
    assert inside.count() < 2 * 200_000 / 100
    for counted in (below, inside):
        plan = plan_of(counted).split("== Initial")[0]
        assert "partial_count" in plan and "Window" not in plan
    df = rows.select("g.k", "v")
    assert percentiles.percentiles_by(df, ["k"], "v", [0.5]).first()[1] == pytest.approx(199_999 / 2 / 7)


def test_sessions_meet_as_stretches(spark):
    """A hot key with a row every second: one row per five minutes reaches the ordering."""
    df = spark.range(0, 86_400, 1, 8).select(
        F.lit(1).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    out = sessions.session_counts(df, ["k"], "t")
    assert [r.num_trips for r in out.collect()] == [86_400]
    plan = plan_of(out)
    assert plan.index("Window") < plan.index("partial_count")


def test_session_counts_can_count_a_column(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "k int, pulocationid int").withColumn(
        "t", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = sessions.session_counts(df, ["k"], "t", column="pulocationid")
    assert sorted((r.k, r.num_trips) for r in out.collect()) == [(1, 0), (2, 1)]


def test_the_zone_picks_trips_before_the_big_join(spark):
    """Trips of other zones are gone before order lines and orders are sorted and merged."""
    zones = mapping.raw_zones(spark, SF_DIR)
    df = questions.largest_tip_zone(mapping.trips(spark, SF_DIR), zones, "pickup_datetime", "1995-01-01", "1996-12-31",
                                    zones.first().zone)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(s_nationkey|PushedFilters: \[[^\]]*In\(s_nationkey", plan_of(df))
    plan = plan_of(df)
    assert plan.index("SortMergeJoin [l_orderkey") < plan.index("BroadcastHashJoin [l_suppkey")


def test_top_k_needs_no_full_sort(spark):
    plan = plan_of(top_k(spark.range(100).withColumn("n", F.col("id") % 7), "n", 3, ["id"]))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_a_hot_order_is_split_by_adaptive_execution(spark, conf):
    """One order holds a third of the lines; with limits that fit the test size its partition is split."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
         shuffle__partitions="16", adaptive__advisoryPartitionSizeInBytes="8k",
         adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
         adaptive__skewJoin__skewedPartitionFactor="2")
    lines = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 2000).alias("k"), F.hash("id").alias("x"))
    orders = spark.range(2000).select(F.col("id").alias("o"), F.hash("id").alias("y"))
    plan = final_plan(lines.join(orders.hint("merge"), F.col("k") == F.col("o")))
    assert "SortMergeJoin(skew=true)" in plan


def test_filters_on_a_partition_column_need_both_bounds(spark, tmp_path):
    path = str(tmp_path / "t")
    (mapping.table(spark, SF_DIR, "events").withColumn("day", F.to_date("ts"))
     .write.partitionBy("day").parquet(path))
    back = spark.read.parquet(path)
    plain = scan(filters.between_days(back, "ts", "2024-01-05", "2024-01-06"), "ts")
    pruned = scan(filters.between_days(back, "ts", "2024-01-05", "2024-01-06", "day"), "ts")
    assert "PartitionFilters: []" in plain
    assert "PartitionFilters: [isnotnull(day" in pruned
