"""Activity reports and batch sessions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import flatten
from ..operators.sessions import longest_streaks, session_counts
from ..plans import activity as act
from ..schemas import WATCH_COUNTS
from ..session import fresh_dir
from ..sinks import KeyedTable
from .mapping import EVENTS_SQL, nested_events, table
from .registry import query

LOW, HIGH = "2024-01-05", "2024-01-25"
_INSIDE = f"CAST(created_at AS DATE) BETWEEN DATE '{LOW}' AND DATE '{HIGH}'"


def flat(spark, sf_dir):
    """Flat events for the reports. Their times are not cut to seconds, so that day bounds, which mean
    the same on whole seconds, reach the file scan."""
    return flatten(nested_events(spark, sf_dir), act.CLEAN_FIELDS)


@query("flatten_events", f"WITH {EVENTS_SQL} SELECT * EXCLUDE (ts) FROM activity")
def flatten_events(spark, sf_dir):
    return act.clean_events(nested_events(spark, sf_dir))


@query("event_type_counts", f"""
WITH {EVENTS_SQL} SELECT event_type, COUNT(*) AS count FROM activity WHERE {_INSIDE} GROUP BY 1
ORDER BY 2 DESC, 1""")
def event_type_counts(spark, sf_dir):
    return act.event_type_counts(flat(spark, sf_dir), LOW, HIGH).orderBy(F.desc("count"), "event_type")


def _top_sql(column):
    return (f"WITH {EVENTS_SQL} SELECT {column}, COUNT(*) AS count FROM activity WHERE {_INSIDE} "
            f"GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")


@query("top_users", _top_sql("actor_login"))
def top_users(spark, sf_dir):
    return act.most_active(flat(spark, sf_dir), "actor_login", LOW, HIGH)


@query("top_repos", _top_sql("repo_name"))
def top_repos(spark, sf_dir):
    return act.most_active(flat(spark, sf_dir), "repo_name", LOW, HIGH)


@query("top_users_of_many", _top_sql("actor_login"))
def top_users_of_many(spark, sf_dir):
    return act.most_active_of_many(flat(spark, sf_dir), "actor_login", LOW, HIGH)


@query("top_repos_of_many", _top_sql("repo_name"))
def top_repos_of_many(spark, sf_dir):
    return act.most_active_of_many(flat(spark, sf_dir), "repo_name", LOW, HIGH)


@query("daily_events", f"""
WITH {EVENTS_SQL} SELECT CAST(created_at AS DATE) AS event_date, COUNT(*) AS count
FROM activity WHERE {_INSIDE} GROUP BY 1 ORDER BY 1""")
def daily_events(spark, sf_dir):
    return act.daily_events(flat(spark, sf_dir), LOW, HIGH).orderBy("event_date")


@query("event_type_daily", f"""
WITH {EVENTS_SQL} SELECT CAST(created_at AS DATE) AS event_date, COUNT(*) AS count
FROM activity WHERE {_INSIDE} AND event_type = 'purchase' GROUP BY 1 ORDER BY 1""")
def event_type_daily(spark, sf_dir):
    return act.daily_events(flat(spark, sf_dir), LOW, HIGH, "purchase").orderBy("event_date")


@query("repo_activity", f"""
WITH {EVENTS_SQL} SELECT repo_id, repo_name, COUNT(event_id) AS event_count
FROM activity WHERE created_at >= DATE '2024-01-31' - INTERVAL 21 DAY GROUP BY 1, 2
ORDER BY 3 DESC, 2""")
def repo_activity(spark, sf_dir):
    return act.repo_activity(flat(spark, sf_dir), "2024-01-31", 21).orderBy(
        F.desc("event_count"), "repo_name")


_WATCH = f"""WITH {EVENTS_SQL}, watched AS (SELECT * FROM activity WHERE event_type = 'view')"""


@query("watch_counts", f"{_WATCH} SELECT repo_name AS name, COUNT(*) AS watch_count FROM watched "
       "GROUP BY 1")
def watch_counts(spark, sf_dir):
    return act.watch_counts(nested_events(spark, sf_dir), "view")


_MOMENT = "2024-01-30 12:00:00"


def _watch_table(spark, sf_dir):
    """Counts up to a moment in a keyed table, and the counts of the events after it."""
    events = nested_events(spark, sf_dir)
    moment = F.lit(_MOMENT).cast("timestamp_ntz")
    stored = KeyedTable(fresh_dir(spark, "watch_counts"), WATCH_COUNTS, ["name"], 16)
    stored.merge(act.watch_counts(events.where(F.col("created_at") < moment), "view"), ["watch_count"])
    return stored, act.watch_counts(events.where(F.col("created_at") >= moment), "view")


@query("merge_upsert", f"""{_WATCH},
stored AS (SELECT repo_name AS name, COUNT(*) AS n FROM watched
           WHERE ts < TIMESTAMP '{_MOMENT}' GROUP BY 1),
fresh AS (SELECT repo_name AS name, COUNT(*) AS n FROM watched
          WHERE ts >= TIMESTAMP '{_MOMENT}' GROUP BY 1)
SELECT COALESCE(f.name, s.name) AS name, COALESCE(f.n, s.n) AS watch_count
FROM stored s FULL JOIN fresh f ON s.name = f.name""")
def merge_upsert(spark, sf_dir):
    """The counts after the moment replace the stored ones; only the buckets they touch are rewritten."""
    stored, fresh = _watch_table(spark, sf_dir)
    stored.merge(fresh, ["watch_count"])
    return stored.read(spark)


@query("merge_upsert_add", f"{_WATCH} SELECT repo_name AS name, COUNT(*) AS watch_count FROM watched GROUP BY 1")
def merge_upsert_add(spark, sf_dir):
    """The counts after the moment are added to the stored ones; the batch is delivered twice and added once."""
    stored, fresh = _watch_table(spark, sf_dir)
    for _ in range(2):
        stored.merge(fresh, ["watch_count"], "add", run="hourly", batch=1)
    return stored.read(spark)


@query("append_new_events", f"""
WITH {EVENTS_SQL} SELECT * EXCLUDE (ts) FROM activity""")
def append_new_events(spark, sf_dir):
    """The first half is stored; then everything is offered twice, and only what is new is appended."""
    cleaned, path = act.clean_events(nested_events(spark, sf_dir)), fresh_dir(spark, "cleaned")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    cleaned.where(F.col("created_at") < half).write.parquet(path)
    for _ in range(2):
        act.new_events(spark.read.parquet(path), cleaned).write.mode("append").parquet(path)
    return spark.read.parquet(path)


_URL = "'http://github.com/' || repo_name"


@query("watch_top", f"""{_WATCH}
SELECT repo_name, COUNT(*) AS watch_count, {_URL} AS url,
       '<a href="' || {_URL} || '" target="_blank">open</a>' AS link
FROM watched GROUP BY repo_name ORDER BY 2 DESC, 1 LIMIT 1000""")
def watch_top(spark, sf_dir):
    return act.watch_top(act.watch_counts(nested_events(spark, sf_dir), "view"))


@query("repo_links", f"""
WITH {EVENTS_SQL} SELECT event_id, {_URL} AS url FROM activity""")
def repo_links(spark, sf_dir):
    return flat(spark, sf_dir).select("event_id", act.repo_url("repo_name").alias("url"))


SESSIONS_SQL = """
WITH e AS (SELECT event_type, user_id % 2 AS user_half, ts,
                  LAG(ts) OVER (PARTITION BY event_type, user_id % 2 ORDER BY ts) AS before
           FROM events),
s AS (SELECT *, SUM(CASE WHEN before IS NULL OR ts > before + INTERVAL 5 MINUTE THEN 1 ELSE 0 END)
          OVER (PARTITION BY event_type, user_half ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
      FROM e),
sessions AS (
  SELECT event_type, user_half, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end,
         COUNT(*) AS num_trips
  FROM s GROUP BY event_type, user_half, sid)"""
SESSION_KEYS = ["event_type", "user_half"]


def keyed_events(events):
    """Events with the two-part session key: the type and one of two groups of users."""
    return events.select("event_id", "event_type", (F.col("user_id") % 2).alias("user_half"), "ts")


@query("sessions_batch", f"{SESSIONS_SQL} SELECT * FROM sessions")
def sessions_batch(spark, sf_dir):
    return session_counts(keyed_events(table(spark, sf_dir, "events")), SESSION_KEYS, "ts")


@query("longest_streak", f"""{SESSIONS_SQL} SELECT * FROM sessions
ORDER BY num_trips DESC, session_start, event_type, user_half LIMIT 10""")
def longest_streak(spark, sf_dir):
    sessions = session_counts(keyed_events(table(spark, sf_dir, "events")), SESSION_KEYS, "ts")
    return longest_streaks(sessions, 10, ["session_start", *SESSION_KEYS])
