import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of
from fareloom import schemas, sinks, sources
from fareloom.operators.filters import between_days
from fareloom.plans import activity, ingest, rides, trips
from fareloom.session import fresh_dir, fresh_name, shared_dir


# ---- the shared folder

def test_the_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")


# ---- text files

def test_short_and_wrong_lines_are_kept_with_their_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,x\n3\nn,5,y\n")
    df = sources.scan_csv(spark, str(tmp_path), schema=_abc(), bad_rows="keep")
    found = sorted((tuple(r) for r in df.collect()), key=repr)
    assert found == [(1, 2, "x", None), (3, None, None, "3"), (None, 5, "y", "n,5,y")]
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        sources.scan_csv(spark, str(tmp_path), schema=_abc(), bad_rows="fail").collect()
    assert sources.scan_csv(spark, str(tmp_path), schema=_abc(), bad_rows="drop").count() == 1
    assert df.where("_corrupt_record IS NOT NULL").select("a").count() == 2
    with pytest.raises(ValueError):
        sources.scan_csv(spark, str(tmp_path))


def _abc():
    from pyspark.sql.types import IntegerType, StringType, StructType
    return StructType().add("a", IntegerType()).add("b", IntegerType()).add("c", StringType())


def test_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2019-10-01 00:26:02\n")
    assert dict(sources.scan_csv(spark, str(tmp_path), infer=True).dtypes) == {
        "a": "int", "b": "timestamp"}


GREEN_HEADER = ",".join(schemas.GREEN_CSV.fieldNames())


def green_line(vendor="2", pickup="2019-10-01 00:26:02", dropoff="2019-10-01 00:39:58", pu="112",
               do="196", distance="5.88", fare="18.0", payment="1", tip="0"):
    return (f"{vendor},{pickup},{dropoff},N,1,{pu},{do},1,{distance},{fare},0.5,0.5,{tip},0,,0.3,"
            f"19.3,{payment},1,0")


def write_month(folder, month, *lines):
    with gzip.open(folder / f"green_tripdata_{month}.csv.gz", "wt") as out:
        out.write("\n".join([GREEN_HEADER, *lines]) + "\n")


def test_months_in_one_scan_with_file_names(spark, tmp_path, rows):
    write_month(tmp_path, "2019-10", green_line(), green_line(vendor=""))
    write_month(tmp_path, "2019-11", green_line())
    (tmp_path / "green_tripdata_2019-12.txt").write_text("not a month file")
    df = sources.scan_months(spark, str(tmp_path), "green", ["2019-09", "2019-10", "2019-11"], files=3,
                             gaps=True)
    assert rows(df.groupBy("filename").count()) == [
        ("green_tripdata_2019-10.csv.gz", 2), ("green_tripdata_2019-11.csv.gz", 1)]
    assert df.schema["lpep_pickup_datetime"].dataType.simpleString() == "timestamp_ntz"
    assert df.rdd.getNumPartitions() == 3


def test_an_absent_month_stops_the_load(spark, tmp_path):
    write_month(tmp_path, "2019-10", green_line())
    with pytest.raises(FileNotFoundError, match="2019-09, 2019-11"):
        sources.scan_months(spark, str(tmp_path), "green", ["2019-09", "2019-10", "2019-11"])
    with pytest.raises(FileNotFoundError):
        sources.scan_months(spark, str(tmp_path), "green", ["2019-09"], gaps=True)


@pytest.mark.parametrize("line", [green_line(distance="far"), green_line().rsplit(",", 2)[0]])
def test_a_bad_line_stops_the_load(spark, tmp_path, line):
    write_month(tmp_path, "2019-10", green_line(), line)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        sources.scan_months(spark, str(tmp_path), "green", ["2019-10"]).count()
    assert sources.scan_months(spark, str(tmp_path), "green", ["2019-10"], bad_rows="drop").count() == 1


def test_an_exchanged_header_stops_the_load(spark, tmp_path):
    header = GREEN_HEADER.replace("PULocationID,DOLocationID", "DOLocationID,PULocationID")
    with gzip.open(tmp_path / "green_tripdata_2019-10.csv.gz", "wt") as out:
        out.write(f"{header}\n{green_line()}\n")
    with pytest.raises(Exception, match="header"):
        sources.scan_months(spark, str(tmp_path), "green", ["2019-10"]).collect()


def test_for_hire_files_are_appended_once(spark, tmp_path):
    def write(month, *lines):
        with gzip.open(tmp_path / f"fhv_tripdata_{month}.csv.gz", "wt") as out:
            out.write("\n".join([",".join(schemas.FHV_CSV.fieldNames()), *lines]) + "\n")
    line = "B00254,2019-01-05 00:33:03,2019-01-05 01:37:20,140,236,,B00254"
    write("2019-01", line, line)
    write("2019-02", line.replace("2019-01", "2019-02"))
    table = fresh_dir(spark, "fhv")
    for months in (["2019-01"], ["2019-01", "2019-02"], ["2019-02"]):
        ingest.ingest_months(spark, str(tmp_path), "fhv", months, table)
    assert spark.read.parquet(table).groupBy("filename").count().orderBy("filename").collect() == [
        ("fhv_tripdata_2019-01.csv.gz", 2), ("fhv_tripdata_2019-02.csv.gz", 1)]
    # A load looks at folder names only: it does not mind stored files that cannot be read.
    import pathlib
    for f in pathlib.Path(table).rglob("*.parquet"):
        f.write_bytes(b"broken")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    write("2019-03", line.replace("2019-01", "2019-03"))
    ingest.ingest_months(spark, str(tmp_path), "fhv", ["2019-01", "2019-03"], table)
    assert ingest.loaded_files(spark, table) == [f"fhv_tripdata_2019-0{m}.csv.gz" for m in (1, 2, 3)]


def test_renamed_for_hire_exports_can_be_staged(spark):
    export = spark.createDataFrame([("1", "2019-01-01", "2019-01-01", 1, 2, None, "B1")],
                                   "dispatching_base_num string, tpep_pickup_datetime string, tpep_dropoff_datetime string,"
                                   "PUlocationID int, DOlocationID int, SR_Flag int, Affiliated_base_number string")
    assert trips.stage_fhv(sources.canonical(export, "fhv")).count() == 1


def test_a_month_loaded_twice_adds_nothing(spark, tmp_path, rows):
    table = fresh_dir(spark, "green")
    twin = green_line(tip="3")  # the hash does not look at the tip
    write_month(tmp_path, "2019-10", green_line(), twin, green_line(pickup="2009-01-01 00:00:00"))
    write_month(tmp_path, "2019-11", green_line(), green_line(fare="20.0"))
    for months in (["2019-10"], ["2019-10"], ["2019-10", "2019-11"], ["2019-11"]):
        ingest.ingest_months(spark, str(tmp_path), "green", months, table)
    out = spark.read.parquet(table)
    assert out.count() == 4
    assert rows(out.groupBy("filename").count()) == [
        ("green_tripdata_2019-10.csv.gz", 3), ("green_tripdata_2019-11.csv.gz", 1)]
    assert {r[0] for r in out.select(F.col(ingest.PART).cast("string")).collect()} == {
        "2009-01", "2019-10"}


def test_trips_from_monthly_files_to_facts(spark, tmp_path):
    """Staging on real columns: duplicates, missing vendors, odd payments and unknown zones."""
    write_month(tmp_path, "2019-10", green_line(fare="18.0"), green_line(fare="7.5"),
                green_line(vendor=""), green_line(vendor="1", payment=""),
                green_line(vendor="3", payment="7"), green_line(vendor="4", pu="264"),
                green_line(vendor="5", pu="999"))
    zones = spark.createDataFrame(
        [(112, "Brooklyn", "Greenpoint", "Boro Zone"), (196, "Queens", "Rego Park", "Boro Zone"),
         (264, "Unknown", "NV", "N/A"), (265, None, "NA", "N/A")], schemas.ZONES)
    raw = sources.scan_months(spark, str(tmp_path), "green", ["2019-10"])
    staged = trips.stage_trips(trips.all_trips(
        raw, raw.limit(0).withColumnsRenamed({"lpep_pickup_datetime": "tpep_pickup_datetime",
                                              "lpep_dropoff_datetime": "tpep_dropoff_datetime"})))
    found = {r.vendorid: r for r in staged.collect()}
    assert sorted(found) == [1, 2, 3, 4, 5]
    assert float(found[2].fare_amount) == 7.5
    assert (found[1].payment_type, found[1].payment_type_description) == (0, "EMPTY")
    assert (found[3].payment_type, found[3].payment_type_description) == (7, "EMPTY")
    assert found[2].payment_type_description == "Credit card"
    assert trips.stage_service(raw, "Green", sample_rows=2).count() == 2
    dim = trips.dim_zones(zones)
    assert dim.where("locationid = 112").first().service_zone == "Green Zone"
    fact = trips.fact_trips(staged, dim)
    assert fact.columns == trips.FACT_COLUMNS and len(fact.columns) == 26
    assert sorted(r.vendorid for r in fact.collect()) == [1, 2, 3]


def test_for_hire_base_numbers(spark):
    raw = spark.createDataFrame(
        [("B00254", "2019-01-01 00:00:00", "B1"), (None, "2019-01-01 00:00:00", "1"),
         ("42", "2019-01-01 00:00:00", "17")], "dispatching_base_num string, t string, "
        "affiliated_base_number string").select(
        "dispatching_base_num", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("t").cast("timestamp_ntz").alias("dropoff_datetime"), F.lit(1).alias("PUlocationID"),
        F.lit(2).alias("DOlocationID"), F.lit(None).cast("int").alias("SR_Flag"),
        "affiliated_base_number")
    found = sorted((r.dispatching_base_num, r.dispatchid, r.affilid)
                   for r in trips.stage_fhv(raw).collect())
    assert found == [("42", 42, 17), ("B00254", None, None)]


# ---- JSON

def ride(number):
    return {"Trip_Pickup_DateTime": "2009-06-14 23:23:00", "Passenger_Count": number,
            "Trip_Dropoff_DateTime": "2009-06-14 23:48:00", "Payment_Type": "CASH"}


def write_pages(folder, *pages):
    for number, page in enumerate(pages, 1):
        (folder / f"page_{number}.json").write_text(json.dumps(page))


def test_pages_end_at_the_first_empty_one(spark, tmp_path):
    write_pages(tmp_path, [ride(1), ride(2)], [ride(3)], [], [ride(4)])
    df = rides.load_rides(sources.scan_json_pages(spark, str(tmp_path), schemas.RIDES_JSON))
    assert sorted(r.passenger_count for r in df.collect()) == [1, 2, 3]
    assert "trip_pickup_date_time" in df.columns and "store_and_forward" in df.columns
    assert rides.avg_duration_minutes(df).first().avg_minutes == 25.0
    assert sources.scan_json_pages(spark, str(tmp_path), schemas.RIDES_JSON, base_page=3).count() == 0


def test_a_missing_page_stops_the_load(spark, tmp_path):
    write_pages(tmp_path, [ride(1)], [ride(2)], [ride(3)], [ride(4)])
    (tmp_path / "page_3.json").unlink()
    with pytest.raises(FileNotFoundError, match=r"\[3\]"):
        sources.scan_json_pages(spark, str(tmp_path), schemas.RIDES_JSON)
    (tmp_path / "page.json").write_text("[]")
    with pytest.raises(ValueError, match="number"):
        sources.scan_json_pages(spark, str(tmp_path), schemas.RIDES_JSON)


def test_pages_are_parsed_by_one_scan(spark, tmp_path):
    write_pages(tmp_path, [ride(1)], [ride(2)])
    df = sources.scan_json_pages(spark, str(tmp_path), schemas.RIDES_JSON)
    assert df.count() == 2 and plan_of(df).count("FileScan") == 1


def test_a_broken_event_line_stops_the_load(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "type": "x"}\n{"id": "2", \n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        sources.scan_events_json(spark, str(tmp_path)).count()
    assert sources.scan_events_json(spark, str(tmp_path), bad_rows="drop").count() == 1


@pytest.mark.parametrize("full", [0, 1, 2, 3, 6])
def test_paged_source_reads_all_full_pages(spark, tmp_path, full):
    pages = [[ride(10 * n), ride(10 * n + 1)] for n in range(full)]
    write_pages(tmp_path, *pages, *([[]] * 16))
    spark.dataSource.register(sources.PagedJson)
    df = (spark.read.format("paged_json").schema(schemas.RIDES_JSON)
          .option("url", f"file://{tmp_path}/page_{{page}}.json").load())
    assert sorted(r.Passenger_Count for r in df.collect()) == sorted(
        r["Passenger_Count"] for page in pages for r in page)


def test_activity_lines_to_counts(spark, tmp_path, rows):
    def line(number, kind, repo, at="2025-03-24T10:00:00.9Z"):
        return json.dumps({"id": str(number), "type": kind, "actor": {"id": 1, "login": "me"},
                           "repo": {"id": 5, "name": repo}, "created_at": at, "public": True})

    (tmp_path / "2025-03-24-10.json").write_text("\n".join([
        line(1, "WatchEvent", "a/b"), line(2, "WatchEvent", "a/b"), line(3, "PushEvent", "c/d")]))
    events = activity.land_events(sources.scan_events_json(spark, str(tmp_path)))
    assert rows(activity.watch_counts(events)) == [("a/b", 2)]
    cleaned = activity.clean_events(events)
    assert cleaned.columns == ["event_id", "event_type", "actor_id", "actor_login", "repo_id",
                               "repo_name", "created_at"]
    assert cleaned.first().created_at == dt.datetime(2025, 3, 24, 10, 0, 0)
    assert activity.new_events(cleaned, cleaned).count() == 0
    assert activity.new_events(cleaned.where("event_id = '1'"), cleaned).count() == 2


def test_messages(spark):
    df = spark.createDataFrame([("2019-10-01 00:26:02", 112, None, 5.88)],
                               "t string, PULocationID int, passenger_count int, trip_distance double")
    df = df.withColumn("lpep_pickup_datetime", F.col("t").cast("timestamp_ntz"))
    columns = ["lpep_pickup_datetime", "PULocationID", "passenger_count", "trip_distance"]
    sent = sinks.json_payload(df, columns)
    assert json.loads(sent.first().value) == {
        "lpep_pickup_datetime": "2019-10-01 00:26:02", "PULocationID": 112, "passenger_count": 0,
        "trip_distance": 5.88}
    got = sources.topics.decode(sent).first()
    assert (got.PULocationID, got.passenger_count, got.tip_amount) == (112, 0, None)
    assert got.lpep_pickup_datetime == dt.datetime(2019, 10, 1, 0, 26, 2)


# ---- names

def test_names_come_from_argument_environment_or_default(spark, monkeypatch, tmp_path):
    assert sources.Sources(spark).full_name("t") == "trips.t"
    monkeypatch.setenv("FARELOOM_SCHEMA", "raw")
    assert sources.Sources(spark).full_name("t") == "raw.t"
    assert sources.Sources(spark, "mine").full_name("t") == "mine.t"
    names = sources.Sources(spark, paths={"t": str(tmp_path / "t")})
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert names.table("t").count() == 3
    with pytest.raises(KeyError):
        names.schema_for("core")
    monkeypatch.setenv("FARELOOM_TARGET_SCHEMA", "prod")
    assert names.schema_for("core") == names.schema_for("staging") == "prod"
    monkeypatch.setenv("FARELOOM_STAGING_SCHEMA", "stg")
    assert (names.schema_for("core"), names.schema_for("staging")) == ("prod", "stg")


def test_renames(spark):
    df = spark.createDataFrame([(1, 2)], "vendor_id int, imp_surcharge int")
    assert sources.canonical(df, "green").columns == ["VendorID", "improvement_surcharge"]
    odd = spark.createDataFrame([(1, 2, 3)], "Trip_Pickup_DateTime int, store_and_forward int, mta_tax int")
    assert sources.snake_case(odd).columns == ["trip_pickup_date_time", "store_and_forward", "mta_tax"]


# ---- tables

def test_table_life(spark, rows):
    name = fresh_name("t")
    sinks.create_as(name, spark.createDataFrame([(1, "a")], "a int, b string"), fresh_dir(spark, "t"))
    sinks.append(name, spark.createDataFrame([("b", 2)], "b string, a int"))
    sinks.append(name, spark.createDataFrame([(3,)], "a int"))
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        sinks.append(name, spark.createDataFrame([(3,)], "z int"))
    sinks.replace(name, spark.createDataFrame([("z", 9)], "b string, a int"))
    assert rows(spark.table(name)) == [(9, "z")]
    assert sources.describe(spark.table(name)).where("column_name = 'a'").first().non_null == 1


def test_ensured_table_keeps_rows_and_refuses_null(spark):
    name, path = fresh_name("watch"), fresh_dir(spark, "watch")
    sinks.ensure_table(spark, name, schemas.WATCH_COUNTS, path)
    good = spark.createDataFrame([("a/b", 1)], "name string, watch_count long")
    sinks.append(name, sinks.required(good, schemas.WATCH_COUNTS))
    assert sinks.ensure_table(spark, name, schemas.WATCH_COUNTS, path).count() == 1
    bad = spark.createDataFrame([(None, 1)], "name string, watch_count long")
    with pytest.raises(PySparkException, match="null in required column name"):
        sinks.append(name, sinks.required(bad, schemas.WATCH_COUNTS))
    assert sinks.replace_schema(spark, name, schemas.WATCH_COUNTS, fresh_dir(spark, "w")).count() == 0


def test_materialized_rows_change_only_on_refresh(spark):
    name, size, root = fresh_name("mv"), [2], fresh_dir(spark, "mv")

    def build():
        return spark.range(size[0])

    sinks.materialize(spark, name, build, root)
    size[0] = 5
    assert spark.table(name).count() == 2
    assert sinks.materialize(spark, name, build).count() == 5
    import pathlib
    assert len(list(pathlib.Path(root).iterdir())) == 1  # the old files are gone, the new ones beside them


def test_materialize_never_touches_what_it_did_not_store(spark, tmp_path):
    raw, moved, name = str(tmp_path / "raw"), str(tmp_path / "moved"), fresh_name("zones")
    spark.range(4).write.parquet(raw)
    sources.external_table(spark, name, raw)
    with pytest.raises(ValueError, match="not stored by materialize"):
        sinks.materialize(spark, name, lambda: spark.range(9))
    assert spark.read.parquet(raw).count() == 4 and spark.table(name).count() == 4
    # A table of its own that somebody pointed at other files: these stay as well.
    own = fresh_name("mv")
    sinks.materialize(spark, own, lambda: spark.range(1).select(F.col("id")), fresh_dir(spark, "mv"))
    spark.range(3).write.parquet(moved)
    spark.sql(f"ALTER TABLE {own} SET LOCATION '{moved}'")
    assert sinks.materialize(spark, own, lambda: spark.range(2)).count() == 2
    assert spark.read.parquet(moved).count() == 3


def test_stored_models_outlive_the_process(tmp_path):
    import subprocess
    import sys
    script = """
import sys
sys.path.insert(0, sys.argv[1])
from fareloom.session import build_session
from fareloom.sinks import materialize
spark = build_session("one", "local[1]", 1, **{"spark.checkpoint.dir": sys.argv[2] + "/shared",
                      "spark.sql.warehouse.dir": sys.argv[2] + "/warehouse", "spark.ui.showConsoleProgress": "false"})
materialize(spark, "mart", lambda: spark.range(7))
"""
    root = str(__import__("pathlib").Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", script, root, str(tmp_path)], check=True, capture_output=True, timeout=300)
    folders = list((tmp_path / "warehouse" / "materialized").iterdir())
    assert len(folders) == 1 and folders[0].name.startswith("mart-") and list(folders[0].glob("*.parquet"))


def test_refresh_reads_new_files_alone(spark, rows):
    source, day = fresh_dir(spark, "arriving"), "k int, v double"
    import pathlib
    view = sinks.IncrementalAggregate(fresh_dir(spark, "states"), source, spark.createDataFrame([], day).schema, ["k"], {
        "n": ("count", F.lit(1)), "known": ("count", "v"), "s": ("sum", "v"), "a": ("min", "v"), "b": ("max", "v"), "m": ("avg", "v")})

    def arrive(*data):
        before = {str(f) for f in pathlib.Path(source).glob("*.parquet")} if pathlib.Path(source).exists() else set()
        spark.createDataFrame(list(data), day).coalesce(1).write.mode("append").parquet(source)
        return {str(f) for f in pathlib.Path(source).glob("*.parquet")} - before

    def full():
        return spark.read.parquet(source).groupBy("k").agg(F.count("*").alias("n"), F.count("v").alias("known"), F.sum("v").alias("s"),
                                                           F.min("v").alias("a"), F.max("v").alias("b"), F.avg("v").alias("m"))
    arrive((1, 2.0), (None, 4.0), (1, None))
    assert view.refresh(spark) == 1 and rows(view.read(spark)) == rows(full())
    for data in ([(1, -3.0), (2, 8.0)], [(None, 0.5), (2, 16.0)]):
        arrived = arrive(*data)
        paths = view.new_files(spark)
        assert {p.removeprefix("file:") for p in paths} == arrived
        assert {p.removeprefix("file://") for p in view.new_rows(spark, paths).inputFiles()} == arrived
        assert view.refresh(spark) == 1 and rows(view.read(spark)) == rows(full())
    assert view.refresh(spark) == 0
    # No row, one group of nulls, a file that goes.
    empty = arrive()
    assert view.refresh(spark) == len(empty) and view.refresh(spark) == 0
    gone = arrive((9, None), (None, None))
    view.refresh(spark)
    assert rows(view.read(spark)) == rows(full())
    pathlib.Path(gone.pop()).unlink()
    assert rows(view.read(spark)) == rows(full())
    with pytest.raises(ValueError):
        sinks.IncrementalAggregate("x", source, view.schema, [], {"d": ("median", "v")})


def test_bucketed_target_is_not_shuffled(spark, rows, tmp_path):
    name, path = fresh_name("merged"), str(tmp_path / "merged")

    def staged(*ids):
        return spark.createDataFrame([(i, f"{i}x") for i in ids], "unique_row_id string, filename string")
    ingest.store_bucketed(name, staged("a", "b", "b", None), path, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = ingest.new_for_buckets(spark.table(name), staged("a", "c"), "unique_row_id", 4)
        plan = plan_of(new)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    target = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in target[target.index("FileScan") - 200:target.index("FileScan")]
    ingest.store_bucketed(name, staged("a", "c", "c", None), path)
    assert rows(spark.table(name).select("unique_row_id")) == rows(staged("a", "b", "b", None, None, "c", "c").select("unique_row_id"))
    plain = fresh_name("plain")
    sinks.create_as(plain, staged("a"), str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not bucketed"):
        ingest.store_bucketed(plain, staged("b"), str(tmp_path / "plain"))


def test_external_table_keeps_its_files(spark, tmp_path):
    path, name = str(tmp_path / "x"), fresh_name("x")
    spark.range(4).write.parquet(path)
    assert sources.external_table(spark, name, path).count() == 4
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 4


def test_models_are_views_or_tables(spark):
    layers = sinks.Layers(spark, fresh_name("m") + "_")

    @sinks.model("table")
    def doubled(df):
        return df.select((F.col("id") * 2).alias("id"))

    assert doubled.kind == "table" and doubled(spark.range(2)).count() == 2
    stored = doubled(spark.range(2), layers=layers)
    assert "FileScan parquet" in plan_of(stored)
    with pytest.raises(ValueError):
        layers.store("x", spark.range(1), "index")


def names(path):
    import pathlib
    return {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}


def counts(spark, *pairs):
    return spark.createDataFrame(pairs, "name string, watch_count long")


def test_a_keyed_merge_rewrites_only_what_it_touches(spark, rows):
    table = sinks.KeyedTable(fresh_dir(spark, "keyed"), schemas.WATCH_COUNTS, ["name"], 8)
    assert table.read(spark).count() == 0
    table.merge(counts(spark, *[(f"r{i}", 1) for i in range(100)]), ["watch_count"])
    first = names(table.root)
    assert len({f.split("/")[1] for f in first}) == 8
    table.merge(counts(spark, ("r1", 5), ("r1b", 2)), ["watch_count"], "add", run="hour", batch=3)
    kept = {f.split("/")[1] for f in first & names(table.root)}
    assert 6 <= len(kept) <= 7
    table.merge(counts(spark, ("r1", 5), ("r3", 1)), ["watch_count"], "add", run="hour", batch=3)  # r3 was left out by a broken merge
    assert rows(table.read(spark).where("watch_count > 1")) == [("r1", 6), ("r1b", 2), ("r3", 2)]
    table.merge(counts(spark, ("r1", 1)), ["watch_count"], "add", run="other", batch=3)
    table.merge(counts(spark, ("r1", 5)), ["watch_count"], "add", run="hour", batch=2)
    assert rows(table.read(spark).where("name = 'r1'")) == [("r1", 7)]
    files = names(table.root)
    for bad in ([("r2", 5), ("r2", 6)], [(None, 1)]):
        with pytest.raises(ValueError, match="source row"):
            table.merge(counts(spark, *bad), ["watch_count"])
    table.merge(counts(spark), ["watch_count"])
    assert table.read(spark).count() == 101 and names(table.root) == files


def test_a_second_writer_is_refused_before_it_writes(spark, rows):
    table = sinks.KeyedTable(fresh_dir(spark, "keyed"), schemas.WATCH_COUNTS, ["name"], 4)
    table.merge(counts(spark, ("a", 1)), ["watch_count"])
    files = names(table.root)
    with table._writing(spark):
        with pytest.raises(RuntimeError, match="another writer"):
            sinks.KeyedTable(table.root, schemas.WATCH_COUNTS, ["name"], 4).merge(counts(spark, ("a", 9)), ["watch_count"])
        assert rows(table.read(spark)) == [("a", 1)] and names(table.root) == files
        table.unlock(spark)
        table.merge(counts(spark, ("a", 2)), ["watch_count"])
    assert rows(table.read(spark)) == [("a", 2)]


def test_a_keyed_table_grows(spark, rows):
    table = sinks.KeyedTable(fresh_dir(spark, "keyed"), schemas.WATCH_COUNTS, ["name"], 2)
    table.merge(counts(spark, *[(f"r{i}", i) for i in range(40)]), ["watch_count"], "add", run="x", batch=1)
    table.resize(spark, 8)
    other = sinks.KeyedTable(table.root, schemas.WATCH_COUNTS, ["name"], 3)  # the table has its own number
    other.merge(counts(spark, ("r1", 100), ("r40", 40)), ["watch_count"], "add", run="x", batch=1)
    assert rows(other.read(spark)) == rows(counts(spark, *[(f"r{i}", i) for i in range(41)]))
    assert {f.split("/")[0] for f in names(table.root)} == {"n=8"}
    with pytest.raises(ValueError):
        table.resize(spark, 8)


def test_only_results_are_left_behind(spark, tmp_path):
    import pathlib

    from fareloom.operators import percentiles
    from fareloom.session import shared_dir
    shared = pathlib.Path(shared_dir(spark)) / "fareloom"
    before = set(shared.iterdir()) if shared.exists() else set()
    write_month(tmp_path, "2019-10", green_line())
    for _ in range(2):
        ingest.ingest_months(spark, str(tmp_path), "green", ["2019-10"], str(tmp_path / "table"))
    df = spark.range(9).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert percentiles.percentiles_over(df, ["k"], "v", [0.5], ["p"]).count() == 9
    after = set(shared.iterdir()) - before
    assert len(after) == 1 and after.pop().name.startswith("percentiles")


def test_partitioned_write_prunes_and_sorts(spark):
    path = fresh_dir(spark, "days")
    df = spark.range(0, 4000, 1, 8).select(
        (F.col("id") % 50).alias("vendorid"),
        F.timestamp_seconds(F.lit(1709251200) + (F.col("id") % 20) * 86400).cast("timestamp_ntz").alias("ts"))
    sinks.write_partitioned(df.withColumn("day", F.to_date("ts")), path, "day", ["vendorid"])
    back = spark.read.parquet(path)
    inside = between_days(back, "ts", "2024-03-03", "2024-03-05", "day")
    assert inside.count() == 600
    scan = [line for line in plan_of(inside).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(day" in scan and "day" in scan.split("PartitionFilters")[1]
    one = [r.vendorid for r in spark.read.parquet(f"{path}/day=2024-03-03").collect()]
    assert one == sorted(one)


def test_file_count_and_milliseconds(spark):
    path = fresh_dir(spark, "files")
    df = spark.range(100).select(
        "id", F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz").alias("t"))
    sinks.write_parquet(df, path, files=3, codec="gzip", milliseconds=["t"])
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) == 3 and all(".gz." in f for f in back.inputFiles())
    assert back.first().t == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_a_filter_on_either_column_reads_a_quarter(spark):
    import datetime as dt
    import pathlib

    import pyarrow.parquet as pq
    path = fresh_dir(spark, "clustered")
    draw = F.rand(3)
    df = spark.range(0, 40_000, 1, 4).select("id", F.pow(draw, 6).alias("skewed"), F.timestamp_seconds(F.floor(F.rand(4) * 1e6)).cast("timestamp_ntz").alias("at"))
    df = df.union(spark.createDataFrame([(-1, None, None)], "id long, skewed double, at timestamp_ntz"))
    sinks.write_clustered(df, path, ["skewed", "at"], rows_per_file=500)
    assert spark.read.parquet(path).count() == 40_001
    for column in ("skewed", "at"):
        low, high = df.select(F.percentile_approx(column if column == "skewed" else F.unix_seconds(F.col("at").cast("timestamp")), [0.50, 0.52])).first()[0]
        read = 0
        for f in pathlib.Path(path).glob("*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                c = next(meta.row_group(g).column(i) for i in range(meta.num_columns) if meta.row_group(g).column(i).path_in_schema == column)
                a, b = c.statistics.min, c.statistics.max
                if column == "at":
                    a, b = (x.replace(tzinfo=dt.UTC).timestamp() for x in (a, b))
                read += meta.row_group(g).num_rows if a <= high and b >= low else 0
        assert 0 < read <= 10_000
    empty = fresh_dir(spark, "empty")
    sinks.write_clustered(df.where("id = -2"), empty, ["skewed", "at"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


def test_rows_are_checked_by_the_load_itself(spark, rows, tmp_path):
    from fareloom.plans.checked import TooManyBadRows, load_checked
    good, aside, read = str(tmp_path / "good"), str(tmp_path / "aside"), spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, "x"), (None, None), (5, "b")], "k long, flag string")
    seen = F.udf(lambda k: read.add(1) or k, "long").asNondeterministic()
    rules = {"key": F.col("k").isNotNull(), "flag": F.col("flag").isin("a", "b")}
    report = load_checked(df.withColumn("k", seen("k")), rules, good, aside, max_bad=3, expected_rows=5)
    assert (report.rows, report.rejected, report.failures) == (5, 3, {"key": 2, "flag": 2}) and read.value == 5
    assert rows(spark.read.parquet(good)) == [(1, "a"), (5, "b")]
    assert rows(spark.read.parquet(aside)) == sorted([(None, "a", ["key"]), (3, "x", ["flag"]), (None, None, ["key", "flag"])], key=repr)
    with pytest.raises(TooManyBadRows, match="3 of 5 rows"):
        load_checked(df, rules, good, aside, max_bad=2)
    with pytest.raises(ValueError, match="6 were expected"):
        load_checked(df, rules, good, aside, max_bad=3, expected_rows=6)
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(aside).count() == 3
    assert load_checked(df.limit(0), rules, good, aside).rows == 0
    assert load_checked(df, {}, good, aside).rejected == 0


def test_files_are_written_from_landed_parts_without_a_shuffle(spark, rows, monkeypatch):
    from fareloom.sinks import files
    monkeypatch.setattr(files, "PART_ROWS", 100)
    df = spark.range(0, 9000, 1, 2).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"))
    path, landed = fresh_dir(spark, "files"), fresh_dir(spark, "parts")
    sinks.write_parquet(df, path, files=3)
    back = spark.read.parquet(path)
    assert rows(back) == rows(df) and len(back.inputFiles()) == 3
    held = [r["count"] for r in back.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert sum(held) == 9000 and max(held) <= 3200
    df.write.option("maxRecordsPerFile", 100).parquet(landed)
    assert "Exchange" not in plan_of(files._in_files(spark, landed, df.schema, 3))
    # Too few parts are dealt row by row.
    sinks.write_parquet(spark.range(0, 300, 1, 1), path, files=3)
    assert len(spark.read.parquet(path).inputFiles()) == 3 and spark.read.parquet(path).distinct().count() == 300


def test_a_repeated_load_meets_ids_alone(spark, rows, monkeypatch):
    """Whole rows are read again only for ids that the table lacks; first loads are written as they are scanned."""
    appended, append = [], ingest._append
    monkeypatch.setattr(ingest, "_append", lambda df, *a, **k: (appended.append(k.get("monthly", False)), append(df, *a, **k)))
    path, hashed = fresh_dir(spark, "months"), "0123456789abcdef" * 2

    def staged(*ids, month="2019-10"):
        return spark.createDataFrame([(i, "f", month) for i in ids], f"unique_row_id string, filename string, {ingest.PART} string")
    ingest.store(spark, path, staged("a", "a", hashed), monthly=True)
    ingest.store(spark, path, staged("a", hashed), monthly=True)
    assert appended == [True]
    ingest.store(spark, path, staged("b", month="2019-11"), monthly=True)
    assert appended == [True, True]
    ingest.store(spark, path, staged("a", "c", "c", None, hashed.upper(), hashed), monthly=True)
    assert appended == [True, True, False]
    held = rows(spark.read.parquet(path).select("unique_row_id"))
    assert held == sorted([(i,) for i in ("a", "a", hashed, "b", "c", "c", None, hashed.upper())], key=repr)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_packed_ids_are_equal_for_equal_ids_only(spark):
    ids = ["", "a", "0" * 32, "0" * 16, "\0" * 16, "\0" * 17, "A" * 32, "a" * 32, "a" * 31, "a" * 33, "a" * 32 + "\n", None]
    df = spark.createDataFrame([(i,) for i in ids], "k string").select(ingest.packed("k").alias("p"))
    found = [r.p for r in df.collect()]
    assert found[-1] is None and len({bytes(p) for p in found[:-1]}) == len(ids) - 1
    assert len(found[2]) == 16


def test_buckets_follow_the_first_load(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKET_ROWS", 2)
    name, path = fresh_name("merged"), str(tmp_path / "merged")

    def staged(*ids):
        return spark.createDataFrame([(str(i), "f") for i in ids], "unique_row_id string, filename string")
    ingest.store_bucketed(name, staged(*range(20)), path, buckets=4)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    assert described["data_type"] == "16"
    ingest.store_bucketed(name, staged(*range(10, 25)), path, buckets=4)
    assert rows(spark.table(name).select("unique_row_id")) == rows(staged(*range(25)).select("unique_row_id"))
