import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from fareloom import functions as fn


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value if not isinstance(value, (str, int, float)) else F.lit(value))
    return df.select(column.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_minutes_count_boundaries_not_elapsed_time(spark):
    pair = {"a": ts("2024-01-01 00:00:59"), "b": ts("2024-01-01 00:01:01")}
    assert one(spark, fn.boundary_minutes("a", "b"), **pair) == 1
    assert one(spark, fn.seconds_between("a", "b"), **pair) == 2
    assert one(spark, fn.seconds_between("b", "a"), **pair) == -2
    assert one(spark, fn.hours_between("a", "b"), **pair) == pytest.approx(2 / 3600)


def test_minutes_before_1970(spark):
    pair = {"a": ts("1969-12-31 23:58:30"), "b": ts("1970-01-01 00:00:00")}
    assert one(spark, fn.boundary_minutes("a", "b"), **pair) == 2


def test_date_labels(spark):
    at = ts("2019-11-30 23:59:59.5")
    assert one(spark, fn.year_quarter("t"), t=at) == "2019/Q4"
    assert one(spark, fn.month_start("t"), t=at) == dt.datetime(2019, 11, 1)
    assert one(spark, fn.floor_second("t"), t=at) == dt.datetime(2019, 11, 30, 23, 59, 59)
    assert one(spark, fn.display_ts("t"), t=at) == "2019-11-30 23:59:59"
    assert one(spark, fn.days_before("2024-03-01", 1)) == dt.date(2024, 2, 29)


def test_times_from_text(spark):
    assert one(spark, fn.parse_ts("s"), s="2019-10-01 00:26:02") == dt.datetime(2019, 10, 1, 0, 26, 2)
    assert one(spark, fn.parse_ts("s", bad="null"), s="soon") is None
    assert one(spark, fn.parse_ts("s"), s=F.lit(None).cast("string")) is None
    for bad in (fn.parse_ts("s"), fn.parse_ts("s", "dd.MM.yyyy"), fn.naive_utc("s")):
        with pytest.raises(Exception, match="not a time: soon"):
            one(spark, bad, s="soon")
    assert one(spark, fn.parse_ts("s", "dd.MM.yyyy"), s="31.12.2020") == dt.datetime(2020, 12, 31)
    assert one(spark, fn.naive_utc("s"), s="2025-03-24T10:00:00.123456+02:00") == dt.datetime(
        2025, 3, 24, 8, 0, 0, 123000)


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("value,expected", [
    ("12", 12), (" 7 ", 7), ("-3", -3), ("+4", 4), ("1.5", None), ("B00254", None), ("", None),
    ("99999999999", None)])
def test_safe_int_of_text(spark, value, expected, text):
    assert one(spark, fn.safe_int("s", text=text), s=value) == expected


def test_safe_int_of_fractions(spark):
    assert one(spark, fn.safe_int("d", rounded=True), d=1.5) == 2
    assert one(spark, fn.safe_int("d", rounded=True), d=-0.4) == 0


def test_numbers(spark):
    assert str(one(spark, fn.numeric("d"), d=12.5)) == "12.500000000"
    assert one(spark, fn.pct_change("n", "o"), n=3.0, o=8.0) == -62.5
    assert one(spark, fn.pct_change("n", "o"), n=3.0, o=0.0) is None
    assert one(spark, fn.pct_change("n", "o"), n=3.0, o=F.lit(None).cast("double")) is None
    assert one(spark, fn.null_if("n", 3), n=3) is None
    assert one(spark, fn.thousands("n"), n=104838) == "104,838"


def test_payment_names(spark):
    df = spark.createDataFrame([("1",), ("6",), ("7",), ("x",), (None,)], "c string")
    for text in (False, True):
        names = [r[0] for r in df.select(fn.payment_description("c", text)).collect()]
        assert names == ["Credit card", "Voided trip", "EMPTY", "EMPTY", "EMPTY"]


def test_bucket_edges_are_inclusive_and_null_is_last(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (3.0,), (99.0,), (None,)], "d double")
    labels = ["a", "b", "c"]
    assert [r[0] for r in df.select(fn.bucket("d", [1, 3], labels)).collect()] == list("abbcc")
    named = df.select(fn.bucket("d", [1, 3], labels, null_label="none")).collect()
    assert named[-1][0] == "none"
    with pytest.raises(ValueError):
        fn.bucket("d", [1, 3], ["a"])


def test_hashes_treat_null_as_agreed(spark):
    none = F.lit(None).cast("string")
    assert one(spark, fn.row_hash("a", "n", "b"), a="x", n=none, b=1) == hashlib.md5(b"x1").hexdigest()
    token = "_dbt_utils_surrogate_key_null_"
    assert one(spark, fn.surrogate_key("a", "n"), a="x", n=none) == hashlib.md5(
        f"x-{token}".encode()).hexdigest()


def test_text(spark):
    assert one(spark, fn.replace_text("s", "Boro", "Green"), s="Boro Zone") == "Green Zone"
    assert one(spark, fn.repo_url("s"), s="a/b") == "http://github.com/a/b"
    assert one(spark, fn.repo_link("s", "go"), s="a/b") == (
        '<a href="http://github.com/a/b" target="_blank">go</a>')
    assert one(spark, fn.file_name("s"), s="x/y/z.csv.gz") == "z.csv.gz"
    assert one(spark, fn.concat_blank("s", "n"), s="a", n=F.lit(None).cast("string")) == "a"


def test_payment_names_in_sql(spark):
    from fareloom.functions.sql import register_sql_functions
    register_sql_functions(spark)
    found = spark.sql("SELECT payment_description(2) AS a, payment_description('x') AS b, "
                      "payment_description(NULL) AS c").first()
    assert tuple(found) == ("Cash", "EMPTY", "EMPTY")
