import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from fareloom.operators import aggregates as agg
from fareloom.operators import filters as flt
from fareloom.operators import heavy, joins, merges, percentiles, quality, sessions, windows

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))


# ---- filters

def test_last_day_is_whole_for_days_and_cut_for_literals(spark):
    df = times(spark, "2024-03-15 00:00:00", "2024-03-15 10:00:00", "2024-03-16 00:00:00")
    assert flt.between_days(df, "t", "2024-03-01", "2024-03-15").count() == 2
    assert flt.between_literal(df, "t", "2024-03-01", "2024-03-15").count() == 1
    assert flt.between_half_open(df, "t", "2024-03-01", "2024-03-15").count() == 0
    assert flt.on_day(df, "t", "2024-03-15").count() == 2


def test_last_days_and_where_the_number_comes_from(spark, monkeypatch):
    df = times(spark, "2024-01-31 00:00:00", "2024-02-23 23:59:59", "2024-02-24 00:00:00")
    assert flt.last_days(df, "t", "2024-03-02", 7).count() == 1
    assert flt.last_days(df, "t", "2024-03-02").count() == 2
    monkeypatch.setenv("DAYS_BACK", "8")
    assert flt.days_back() == 8 and flt.days_back(3) == 3


def test_nulls_leave_with_not_equal(spark):
    df = spark.createDataFrame([("Unknown",), (None,), ("Bronx",)], "b string")
    assert [r.b for r in flt.where_ne(df, "b", "Unknown").collect()] == ["Bronx"]


def test_small_filters(spark, rows):
    df = spark.createDataFrame([("Cash", 1.0, None), ("CARD", 0.0, 5), ("x", -1.0, 6)],
                               "k string, v double, n int")
    assert rows(flt.where_in(df, "k", ["cash", "card"], lower=True), "k") == [("CARD",), ("Cash",)]
    assert flt.where_in(df, "k", ["cash"]).count() == 0
    assert rows(flt.where_positive(df, ["v"]), "k") == [("Cash",)]
    assert rows(flt.where_not_null(df, "n"), "n") == [(5,), (6,)]
    assert rows(flt.fill(df, {"n": 0}), "n") == [(0,), (5,), (6,)]
    assert flt.cap(df).count() == 3 and flt.cap(df, 2).count() == 2
    assert flt.first_rows(df, 1, ["v"]).first()["k"] == "x"
    assert flt.with_constants(df, {"one": 1}).first()["one"] == 1


# ---- joins

def hot_rows(spark, copies=3000):
    """A third of the rows and more under one key, over several partitions, some keys null."""
    return (spark.range(0, 3 * copies, 1, 6)
            .withColumn("k", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None)
                        .otherwise(F.col("id") % 500)))


def test_unmatched_keeps_copies_and_rows_without_a_key(spark, rows):
    left = hot_rows(spark)
    right = spark.createDataFrame([(k,) for k in (7, 7, 8, None)], "k long")
    found = joins.unmatched(left, right, "k")
    assert found.columns == left.columns
    assert rows(found) == rows(left.where("k is null or k not in (7, 8)"))
    plan = plan_of(joins.unmatched(left, right, "k"))
    assert "Aggregate" not in plan and plan.count("LeftAnti") == 1


def test_orphans_are_counted_by_key(spark, rows):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(joins.orphans(child, "fk", parent, "pk")) == [(9, 2)]


def test_role_join_names_columns_by_role(spark, rows):
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "id int, zone string")
    trips = spark.createDataFrame([(1, 2), (2, 2), (1, 3)], "pu int, do int")
    out = joins.role_join(trips, dim, {"pickup": "pu", "dropoff": "do"}, "id", ["zone"])
    assert out.columns == ["pu", "do", "pickup_zone", "dropoff_zone"]
    assert rows(out) == [(1, 2, "A", "B"), (2, 2, "B", "B")]


def test_join_dim_sides(spark, rows):
    dim = spark.createDataFrame([(1, "A"), (3, "C")], "id int, zone string")
    facts = spark.createDataFrame([(1,), (2,)], "fk int")
    for how, expected in {"inner": [(1, "A")], "left": [(1, "A"), (2, None)],
                          "right": [(1, "A"), (None, "C")],
                          "full": [(1, "A"), (2, None), (None, "C")]}.items():
        assert rows(joins.join_dim(facts, dim, "fk", "id", ["zone"], how)) == expected


# ---- aggregates

def test_top_and_bottom_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 1)], "k string, n int")
    assert [r.k for r in agg.top_k(df, "n", 2, ["k"]).collect()] == ["a", "b"]
    assert [r.k for r in agg.bottom_k(df, "n", 1, ["k"]).collect()] == ["c"]
    assert agg.top_by_max(df, ["k"], "n", "m").first().asDict() == {"k": "a", "m": 2}


def test_counts_and_sums(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 5)], "k string, n int")
    assert rows(agg.count_by(df, ["k"])) == [("a", 2), ("b", 1)]
    assert rows(agg.count_by(df, ["k"], "n")) == [("a", 1), ("b", 1)]
    assert rows(agg.sum_having(df, ["k"], "n", 1, "s")) == [("b", 5)]
    assert agg.count_distinct(df, "k").first()[0] == 2
    assert agg.count_distinct(df, "k", approx=True).first()[0] == 2
    assert agg.distinct(df, ["k"]).count() == 2 and agg.distinct(df.union(df)).count() == 3
    assert agg.avg_of(df, F.col("n"), "a").first()[0] == 3.0


def test_union_matches_names_not_positions(spark, rows):
    green = spark.createDataFrame([(1, "x")], "a int, b string")
    yellow = spark.createDataFrame([("y", 2)], "b string, a int")
    both = agg.union_tagged({"Green": green, "Yellow": yellow})
    assert rows(both) == [(1, "x", "Green"), (2, "y", "Yellow")]
    assert rows(agg.union_all([green, yellow.drop("b")], allow_missing=True)) == [(1, "x"), (2, None)]


# ---- percentiles

PROBS = [0.0, 0.5, 0.9, 0.97, 1.0]


def by_group(df, keys=("k",), **kw):
    out = percentiles.percentiles_by(df, list(keys), "v", PROBS, **kw).collect()
    return {tuple(r[k] for k in keys): list(r)[len(keys):] for r in out}


def test_percentiles_equal_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    data = [("hot", float(v)) for v in np.round(rng.gamma(2, 20, 4000) - 15, 2)]
    data += [(f"k{i % 7}", float(v)) for i, v in enumerate(rng.normal(0, 1e-4, 300))]
    data += [(None, 1e12), (None, -1e12), (None, 0.0), ("one", 3.5), ("void", None), ("hot", None)]
    found = by_group(spark.createDataFrame(data, "k string, v double").repartition(5))
    expected = {}
    for k in {k for k, _ in data}:
        values = [v for key, v in data if key == k and v is not None]
        expected[(k,)] = list(np.percentile(values, np.array(PROBS) * 100)) if values else [None] * 5
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        if values[0] is None:
            assert found[key] == values
        else:
            assert found[key] == pytest.approx(values, rel=1e-12, abs=1e-12)


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.floats(-1e9, 1e9, width=32)), min_size=1,
                max_size=60))
def test_percentiles_equal_built_in(spark, data):
    df = spark.createDataFrame(data, "k int, v double")
    built_in = df.groupBy("k").agg(F.percentile("v", PROBS).alias("p")).collect()
    found = by_group(df)
    for r in built_in:
        assert found[(r.k,)] == pytest.approx(r.p, rel=1e-9, abs=1e-9)


def test_percentile_window_equals_grouped(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.sqrt("id").alias("v"))
    df = df.union(spark.createDataFrame([(None, 4.0)], "k long, v double"))
    over = percentiles.percentiles_over(df, ["k"], "v", [0.9], ["p90"])
    grouped = {r.k: r.p90 for r in percentiles.percentiles_by(df, ["k"], "v", [0.9], ["p90"]).collect()}
    out = over.collect()
    assert len(out) == 501 and all(r.p90 == grouped[r.k] for r in out)


EXTREME = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 1.0, 1.0000000000000002, 0.9999999999999999, 2.0,
           4.0, 1e22, -1e22, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), 3.0,
           1.7e9, 1.7e9 + 1e-6, -2.5, 1e-5, -1e-5]


def test_far_off_and_tiny_values_in_order(spark, monkeypatch):
    df = spark.createDataFrame([(1, v) for v in EXTREME], "k int, v double")
    ranked = sorted(EXTREME, key=lambda v: (v != v, v))
    probs = [i / (len(EXTREME) - 1) for i in range(len(EXTREME))]
    for direct in (100, 1):
        monkeypatch.setattr(percentiles, "DIRECT", direct)
        got = list(percentiles.percentiles_by(df, ["k"], "v", probs, [f"c{i}" for i in range(len(probs))]).first())[1:]
        assert [repr(abs(g) if g == 0 else g) for g in got[:-1]] == [repr(abs(v) if v == 0 else v) for v in ranked[:-1]]
        assert got[-1] != got[-1]


@pytest.mark.parametrize("values", ["id * 1e-10", "1.7e9D + id / 10", "id % 2 * 1e300 + id", "-1e-300 * id", "id", "id % 3",
                                    "if(id < 120000, 5, id)", "if(id % 49 = 0, null, id * id)"])
def test_brackets_of_hot_groups(spark, values):
    """Groups above ``DIRECT`` values go by brackets, beside small ones and one without values."""
    key = F.when(F.col("id") % 4 > 0, "hot").when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") < 40, "few").otherwise("large")
    df = spark.range(200_000).select(key.alias("k"), F.expr(values).cast("double").alias("v"))
    df = df.union(spark.createDataFrame([("void", None)], "k string, v double"))
    probs = [0.0, 0.1, 0.5, 0.97, 1.0]
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", probs).alias("p")).collect()}
    got = {r[0]: list(r[1:]) for r in percentiles.percentiles_by(df, ["k"], "v", probs).collect()}
    assert got.keys() == want.keys() and got["void"] == [None] * 5
    for k, p in want.items():
        assert p is None and k == "void" or got[k] == pytest.approx(p, rel=1e-12)


def test_missed_brackets_are_widened(spark, monkeypatch):
    real, margins = percentiles._brackets, []

    def off(rows, probs, margin):
        margins.append(margin)
        found = real(rows, probs, margin)
        return found if len(margins) > 2 else found.withColumn("lo", F.transform("lo", lambda x: x + 1e6))
    monkeypatch.setattr(percentiles, "_brackets", off)
    monkeypatch.setattr(percentiles, "DIRECT", 100)
    df = spark.range(9000).select((F.col("id") % 2).alias("k"), F.sqrt("id").alias("v"))
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", 0.3).alias("p")).collect()}
    assert {r.k: r.p30 for r in percentiles.percentiles_by(df, ["k"], "v", [0.3]).collect()} == pytest.approx(want)
    assert len(margins) == 3 and margins[2] == 256 * margins[0]


def test_approximate_percentiles_are_near(spark):
    df = spark.range(1001).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    assert by_group(df, approx=True)[(1,)] == pytest.approx([0, 500, 900, 970, 1000], abs=2)


def test_default_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert percentiles.percentiles_by(df, ["k"], "v", [0.9, 0.995]).columns == ["k", "p90", "p99_5"]


# ---- windows

def test_dedup_keeps_the_same_row_in_any_order(spark):
    data = [("a", 2, 9.0), ("a", 1, 5.0), ("a", None, 1.0), ("b", None, 3.0)]
    for shift in range(4):
        df = spark.createDataFrame(data[shift:] + data[:shift], "k string, n int, f double")
        kept = {r.k: r.f for r in windows.dedup_first(df.repartition(3), ["k"], ["n", "f"]).collect()}
        assert kept == {"a": 5.0, "b": 3.0}
    with pytest.raises(ValueError):
        windows.dedup_first(df, ["k"], [])


def test_growth_over_a_gap_year_and_from_zero(spark):
    df = spark.createDataFrame(
        [("g", 1, 2019, 10.0), ("g", 1, 2021, 15.0), ("y", 1, 2019, 0.0), ("y", 1, 2020, 5.0)],
        "s string, q int, year int, total double")
    loose = {(r.s, r.year): (r.prev_year_total, r.yoy_percentage_change)
             for r in windows.yoy(df, ["s", "q"], "year", "total").collect()}
    assert loose == {("g", 2019): (None, None), ("g", 2021): (10.0, 50.0),
                     ("y", 2019): (None, None), ("y", 2020): (0.0, None)}
    strict = {(r.s, r.year): r.prev_year_total
              for r in windows.yoy(df, ["s", "q"], "year", "total", strict_year=True).collect()}
    assert strict[("g", 2021)] is None and strict[("y", 2020)] == 0.0


def test_nth_counts_distinct_values(spark, rows):
    df = spark.createDataFrame([("z", "a", 9), ("z", "b", 9), ("z", "c", 5), ("z", "d", 1), ("w", "e", 2)],
                               "zone string, k string, p int")
    assert rows(windows.nth_by(df, ["zone"], "p", 2), "k") == [("c",)]
    assert rows(windows.nth_by(df, ["zone"], "p", 1, desc=False), "k") == [("d",), ("e",)]


def test_best_and_worst_break_ties_by_label(spark):
    df = spark.createDataFrame([("g", "Q2", 5.0), ("g", "Q1", 5.0), ("g", "Q3", -1.0), ("g", "Q4", None)],
                               "s string, label string, v double")
    assert windows.best_worst(df, ["s"], "label", "v").first().asDict() == {
        "s": "g", "best_label": "Q1", "best_v": 5.0, "worst_label": "Q3", "worst_v": -1.0}


# ---- sessions

def naive_sessions(events, gap):
    found = []
    for key in sorted({k for k, _ in events}):
        line = sorted(t for k, t in events if k == key)
        start = last = line[0]
        count = 0
        for t in line:
            if t - last > gap:
                found.append((key, start, last + gap, count))
                start, count = t, 0
            last, count = t, count + 1
        found.append((key, start, last + gap, count))
    return sorted(found)


def session_rows(spark, events, gap=300):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(milliseconds=t)) for k, t in events],
                               "k int, t timestamp_ntz")
    out = sessions.session_counts(df, ["k"], "t", gap).collect()

    def millis(moment):
        return round((moment - base).total_seconds() * 1000)

    return sorted((r.k, millis(r.session_start), millis(r.session_end), r.num_trips) for r in out)


def test_exactly_the_gap_is_one_session(spark):
    assert len(session_rows(spark, [(1, 0), (1, 300_000)])) == 1
    assert len(session_rows(spark, [(1, 0), (1, 300_001)])) == 2


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4_000_000)), min_size=1, max_size=50))
def test_sessions_equal_a_plain_walk(spark, events):
    assert session_rows(spark, events) == naive_sessions(events, 300_000)


def test_longest_streaks(spark):
    df = spark.createDataFrame([(1, 4), (2, 9), (3, 9)], "k int, num_trips int")
    assert [r.k for r in sessions.longest_streaks(df, 2, ["k"]).collect()] == [2, 3]


# ---- merges

def table(spark, *data):
    return spark.createDataFrame(list(data), "name string, n long, note string")


def test_equal_new_keys_are_all_inserted_and_a_second_run_adds_nothing(spark, rows):
    target = table(spark, ("a", 1, "old"))
    source = table(spark, ("a", 2, "new"), ("b", 1, "x"), ("b", 2, "y"))
    once = merges.merge_insert_only(target, source, "name")
    assert rows(once) == [("a", 1, "old"), ("b", 1, "x"), ("b", 2, "y")]
    assert rows(merges.merge_insert_only(once, source, "name")) == rows(once)
    assert merges.append_new(once, source, "name").count() == 0


def test_upsert_replaces_or_adds(spark, rows):
    target = table(spark, ("a", 1, "t"), ("b", 5, "t"), ("d", None, "t"))
    source = table(spark, ("a", 9, "s"), ("c", 3, "s"), ("b", None, "s"), ("d", 4, "s"))
    replaced = merges.upsert(target, source, ["name"], ["n"])
    assert rows(replaced) == [("a", 9, "t"), ("b", None, "t"), ("c", 3, "s"), ("d", 4, "t")]
    assert rows(merges.upsert(replaced, source, ["name"], ["n"])) == rows(replaced)
    added = merges.upsert(target, source, ["name"], ["n"], mode="add")
    assert rows(added) == [("a", 10, "t"), ("b", 5, "t"), ("c", 3, "s"), ("d", 4, "t")]
    with pytest.raises(ValueError):
        merges.upsert(target, source, ["name"], ["n"], mode="merge")


@pytest.mark.parametrize("bad", [("a", 2, "s"), (None, 2, "s")])
def test_upsert_refuses_repeated_and_missing_source_keys(spark, bad):
    target, source = table(spark, ("a", 1, "t")), table(spark, ("a", 9, "s"), bad)
    with pytest.raises(Exception, match="source row"):
        merges.upsert(target, source, ["name"], ["n"]).collect()
    with pytest.raises(Exception, match="source row"):
        merges.upsert(target, source, ["name"], ["n"]).select("name").count()


# ---- quality

def test_checks_count_failures(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z"), (None, "z")], "id int, c string")
    parent = spark.createDataFrame([(1,)], "pk int")

    def failures(check):
        return [r.failures for r in check.collect()]

    assert failures(quality.check_unique(df, "id")) == [1]
    assert failures(quality.check_not_null(df, ["id", "c"])) == [1, 1]
    assert failures(quality.check_accepted(df, "c", ["a"])) == [2]
    assert failures(quality.check_relationships(df, "id", parent, "pk")) == [1]
    assert failures(quality.check_row_total(df, 6)) == [2]
    assert failures(quality.check_unique(df.limit(0), "id")) == [0]


def test_columns_are_checked_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z"), (None, "z")], "id int, c string")
    checked = quality.check_columns(df, ["id", "c"], {"c": ["a"]}, quality.WARN)
    assert [tuple(r) for r in checked.collect()] == [
        ("not_null", "id", "warn", 1), ("not_null", "c", "warn", 1), ("accepted_values", "c", "warn", 2)]
    assert plan_of(checked).split("== Initial")[0].count("Scan") == 1


def test_an_enforced_report_is_not_made_again(spark):
    report = quality.enforce(quality.quality_report([quality.check_row_total(spark.range(3), 3)]))
    assert "Range" not in plan_of(report)
    assert [r.status for r in report.collect()] == ["pass"]


def test_freshness(spark):
    df = times(spark, "2024-01-01 00:00:00", "2024-01-01 12:00:00")
    def stale(hours):
        return quality.check_freshness(df, "t", hours, dt.datetime(2024, 1, 1, 18)).first().failures
    assert stale(6) == 0 and stale(5.9) == 1
    empty = quality.check_freshness(df.limit(0), "t", 6, dt.datetime(2024, 1, 1))
    assert empty.first().failures == 1


def test_only_errors_stop_and_columns_must_exist(spark):
    df = spark.createDataFrame([(0,), (None,)], "payment_type int")
    warned = quality.quality_report([quality.check_accepted(df, "payment_type", [1, 2], quality.WARN)])
    assert quality.enforce(warned).first().status == "warn"
    failed = quality.quality_report([quality.check_not_null(df, ["payment_type"])])
    with pytest.raises(quality.CheckFailed, match="payment_type"):
        quality.enforce(failed)
    with pytest.raises(ValueError, match="PUlocationID"):
        quality.check_unique(df, "PUlocationID")


def test_sketches_of_days_are_united(spark):
    from fareloom.operators import aggregates
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    df = spark.range(50_000).select(day.alias("day"), (F.col("id") % 9001).alias("v"))
    sketches = aggregates.distinct_sketches(df.union(spark.createDataFrame([(None, 7)], df.schema)), "day", "v")
    assert sketches.count() == 10
    for first, last in (("2024-01-02", "2024-01-02"), ("2024-01-01", "2024-01-10")):
        exact = df.where(F.col("day").between(first, last)).select("v").distinct().count()
        found = aggregates.distinct_between(sketches, "day", first, last).first()[0]
        assert abs(found - exact) <= aggregates.SKETCH_ERROR * exact
    assert aggregates.distinct_between(sketches, "day", "2030-01-01", "2030-01-02").first()[0] == 0


@pytest.mark.parametrize("tracked, proven", [(4000, True), (100, False)])
def test_top_k_of_very_many_keys(spark, monkeypatch, tracked, proven):
    """Heavy keys among 30,000 light ones; too small a sketch cannot prove them, and all keys are counted."""
    rows = spark.range(90_000, numPartitions=6).select(F.expr(
        "case when id % 10 < 3 then concat('heavy', id % 7) when id % 100 = 9 then null else concat('k', id % 30000) end as key"))
    want = agg.top_k(agg.count_by(rows, ["key"]), "count", 7, ["key"]).collect()
    full = []
    monkeypatch.setattr(heavy, "count_by", lambda df, *a, **k: full.append(df) or agg.count_by(df, *a, **k))
    got = heavy.top_k_by_count(rows, "key", 7, tracked).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert len(full) == (1 if proven else 2)


def test_top_k_by_count_of_ties_few_keys_and_nothing(spark):
    flat = spark.range(4000).select((F.col("id") % 400).alias("key"))
    assert [tuple(r) for r in heavy.top_k_by_count(flat, "key", 3).collect()] == [(0, 10), (1, 10), (2, 10)]
    few = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert [tuple(r) for r in heavy.top_k_by_count(few, "key", 5).collect()] == [(1, 2), (None, 1)]
    assert heavy.top_k_by_count(few.where("false"), "key", 5).collect() == []
    with pytest.raises(ValueError, match="tracked"):
        heavy.top_k_by_count(few, "key", 5000)


def test_candidates_and_their_bound(spark):
    rows = spark.range(50_000, numPartitions=5).select(F.expr("if(id % 4 = 0, id % 16, id)").alias("key"))
    items, bound = heavy.heavy_candidates(rows, "key", 20, 1000)
    counts = {r.key: r["count"] for r in rows.groupBy("key").count().collect()}
    assert set(items) >= {0, 4, 8, 12} and max(n for k, n in counts.items() if k not in items) <= bound
