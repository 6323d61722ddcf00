"""Streaming jobs on the events table, replayed as files. Each run has its own checkpoint.

A session or hour is emitted once the watermark (newest event minus 5 seconds) has passed its end. The table is
finished data, so its replay is ended by a closing row that lets out what is still open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import streaming as st
from ..schemas import ACTIVITY_JSON
from ..session import fresh_dir
from ..sinks import KeyedTable
from ..sinks.files import write_parquet
from ..plans import activity as act
from ..sources.topics import stream_event_lines, stream_files
from .activity import SESSION_KEYS, SESSIONS_SQL, keyed_events
from .mapping import EVENTS_SQL, nested_events, table
from .registry import query


def _stream(spark, sf_dir, session):
    # The braces make the path a pattern, which may name one file as well as a folder.
    return stream_files(session, f"{sf_dir}/{{events.parquet}}",
                        table(spark, sf_dir, "events").schema)


def _replay_all(spark, sf_dir, start):
    """Replay the table through ``start``, which makes a writer of a stream in event time, to its end."""
    events, end = table(spark, sf_dir, "events"), fresh_dir(spark, "end")
    session = st.stream_session(spark)

    def run():
        stream = st.with_end(_stream(spark, sf_dir, session), session, end)
        st.replay(start(st.in_event_time(stream, "ts")))
    run()
    last = events.agg(F.max("ts")).first()[0]
    if last is not None:
        st.end_replay(spark, end, events.schema, "ts", last + dt.timedelta(days=1))
        run()


def _sessions(events):
    return st.session_stream(keyed_events(events), SESSION_KEYS, "ts")


@query("stream_sessions", f"{SESSIONS_SQL} SELECT * FROM sessions")
def stream_sessions(spark, sf_dir):
    out, checkpoint = fresh_dir(spark, "sessions"), fresh_dir(spark, "checkpoint")
    _replay_all(spark, sf_dir, lambda events: st.land(_sessions(events), out, checkpoint))
    return spark.read.parquet(out)


SESSIONS = (T.StructType().add("event_type", "string").add("user_half", "long")
            .add("session_start", "timestamp").add("session_end", "timestamp").add("num_trips", "long"))


@query("session_upsert", f"{SESSIONS_SQL} SELECT * FROM sessions")
def session_upsert(spark, sf_dir):
    """Two runs with a checkpoint each, one of which delivers every batch twice, into one keyed table."""
    keyed = KeyedTable(fresh_dir(spark, "keyed"), SESSIONS, [*SESSION_KEYS, "session_start"], 8)

    def run(times):
        checkpoint = fresh_dir(spark, "checkpoint")
        sink = st.session_sink(keyed, ["session_end", "num_trips"])

        def deliver(batch, batch_id):
            for _ in range(times):
                sink(batch, batch_id)
        _replay_all(spark, sf_dir, lambda events: _sessions(events).writeStream.outputMode("append")
                    .foreachBatch(deliver).option("checkpointLocation", checkpoint))
    run(2)
    run(1)
    return keyed.read(spark)


@query("tumbling_counts", """
SELECT date_trunc('hour', ts) AS event_hour, event_type, COUNT(*) AS num_hits FROM events GROUP BY 1, 2""")
def tumbling_counts(spark, sf_dir):
    out, checkpoint = fresh_dir(spark, "hours"), fresh_dir(spark, "checkpoint")
    _replay_all(spark, sf_dir, lambda events: st.land(
        st.tumbling_counts(events.select("event_type", "ts"), ["event_type"], "ts"), out, checkpoint))
    return spark.read.parquet(out)


@query("landing_append", "SELECT event_id, event_type, ts AS event_timestamp FROM events")
def landing_append(spark, sf_dir):
    session = st.stream_session(spark)
    rows = _stream(spark, sf_dir, session).select(
        "event_id", "event_type", F.col("ts").alias("event_timestamp"))
    out, checkpoint = fresh_dir(spark, "landing"), fresh_dir(spark, "checkpoint")
    st.replay(st.land(rows, out, checkpoint))
    return spark.read.parquet(out)


@query("land_new_files", f"""
WITH {EVENTS_SQL} SELECT * EXCLUDE (ts) FROM activity""")
def land_new_files(spark, sf_dir):
    """Hourly event lines come in two loads. Each run cleans and appends the files that the checkpoint does not know."""
    events = nested_events(spark, sf_dir)
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "cleaned", "checkpoint"))
    session = st.stream_session(spark)
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    for load, part in (("first", F.col("created_at") < half), ("second", F.col("created_at") >= half)):
        text = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
        lines = events.where(part).withColumn("created_at", text)
        lines.write.json(f"{inbox}/{load}")
        arrived = stream_event_lines(session, f"{inbox}/*", ACTIVITY_JSON)
        st.replay(st.land(act.clean_events(act.land_events(arrived)), out, checkpoint))
    return spark.read.parquet(out)


@query("late_rows", """
SELECT COUNT(*) AS late_rows FROM events
WHERE ts < TIMESTAMP '2024-01-16 00:00:00' AND ts + INTERVAL 5 MINUTE <=
  (SELECT MAX(ts) - INTERVAL 5 SECOND FROM events)""")
def late_rows(spark, sf_dir):
    """The second half of the month arrives first; then the first half comes in behind the watermark."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    inbox, checkpoint = fresh_dir(spark, "inbox"), fresh_dir(spark, "checkpoint")
    out = fresh_dir(spark, "on_time")
    session = st.stream_session(spark, merge_first=False)

    counter = st.LateRows()
    session.streams.addListener(counter)

    def run():
        arrived = st.in_event_time(stream_files(session, f"{inbox}/*", events.schema), "ts")
        # Keyed by event, so that no two rows are counted as one.
        return st.replay(st.land(st.session_stream(arrived, ["event_id"], "ts"), out, checkpoint))

    write_parquet(events.where(F.col("ts") >= middle), f"{inbox}/first")
    run()
    write_parquet(events.where(F.col("ts") < middle), f"{inbox}/second")
    dropped = counter.total(run())
    session.streams.removeListener(counter)
    return spark.range(1).select(F.lit(dropped).cast("long").alias("late_rows"))


@query("late_rows_kept", """
SELECT event_id, ts, 'late' AS arrival FROM events
WHERE ts < TIMESTAMP '2024-01-16 00:00:00' AND ts < (SELECT MAX(ts) - INTERVAL 5 SECOND FROM events)
UNION ALL
SELECT event_id, ts, 'on time' FROM events
WHERE NOT (ts < TIMESTAMP '2024-01-16 00:00:00' AND ts < (SELECT MAX(ts) - INTERVAL 5 SECOND FROM events))""")
def late_rows_kept(spark, sf_dir):
    """As ``late_rows``, but the rows behind the watermark are kept in a side table."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    inbox, checkpoint, on_time, late, marks = (fresh_dir(spark, n) for n in ("inbox", "checkpoint", "on_time", "late", "marks"))
    session = st.stream_session(spark)
    for load, part in (("first", F.col("ts") >= middle), ("second", F.col("ts") < middle)):
        write_parquet(events.where(part), f"{inbox}/{load}")
        arrived = stream_files(session, f"{inbox}/*", events.schema)
        st.replay(arrived.writeStream.foreachBatch(st.split_late(on_time, late, marks, "ts")).option("checkpointLocation", checkpoint))
    parts = [spark.read.schema(events.schema).parquet(f"{path}/*").withColumn("arrival", F.lit(name))
             for path, name in ((late, "late"), (on_time, "on time"))]
    return parts[0].union(parts[1])
