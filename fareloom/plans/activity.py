"""Activity events: cleaning, counts and the dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day, floor_second, naive_utc, repo_link, repo_url
from ..operators.aggregates import count_by, top_k
from ..operators.filters import Day, between_days, flatten, last_days, where_eq
from ..operators.heavy import top_k_by_count
from ..operators.merges import append_new, upsert

# The nested fields and their cleaned names.
CLEAN_FIELDS = {
    "id": "event_id", "type": "event_type", "actor.id": "actor_id", "actor.login": "actor_login",
    "repo.id": "repo_id", "repo.name": "repo_name", "created_at": "created_at",
}
WATCH = "WatchEvent"


def land_events(events: DataFrame) -> DataFrame:
    """Parsed event lines with their time as a UTC wall clock in milliseconds."""
    return events.withColumn("created_at", naive_utc("created_at"))


def clean_events(events: DataFrame) -> DataFrame:
    """Flat events with whole-second times."""
    return flatten(events, CLEAN_FIELDS).withColumn("created_at", floor_second("created_at"))


def new_events(stored: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The cleaned events to append: those not stored yet, so that loading an hour twice adds nothing."""
    return append_new(stored, cleaned, "event_id")


def watch_counts(events: DataFrame, watch: str = WATCH) -> DataFrame:
    """Watch events per repository of nested events."""
    return count_by(where_eq(events, "type", watch), {"name": F.col("repo.name")},
                    name="watch_count")


def merge_watch_counts(stored: DataFrame, counts: DataFrame, mode: str = "replace") -> DataFrame:
    return upsert(stored, counts, ["name"], ["watch_count"], mode)


def repo_activity(cleaned: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    return count_by(last_days(cleaned, "created_at", as_of, days), ["repo_id", "repo_name"],
                    "event_id", "event_count")


def event_type_counts(cleaned: DataFrame, low: Day, high: Day, part: str | None = None
                      ) -> DataFrame:
    return count_by(between_days(cleaned, "created_at", low, high, part), ["event_type"])


def most_active(cleaned: DataFrame, column: str, low: Day, high: Day, k: int = 10) -> DataFrame:
    """The ``k`` users (``actor_login``) or repositories (``repo_name``) with the most events."""
    counts = count_by(between_days(cleaned, "created_at", low, high), [column])
    return top_k(counts, "count", k, [column])


def most_active_of_many(cleaned: DataFrame, column: str, low: Day, high: Day, k: int = 10) -> DataFrame:
    """``most_active`` for so many users or repositories that counting all of them would shuffle the table: by sketch,
    recount and proof. Runs at once; the result is stored in the shared folder."""
    return top_k_by_count(between_days(cleaned, "created_at", low, high), column, k)


def daily_events(cleaned: DataFrame, low: Day, high: Day, event_type: str | None = None
                 ) -> DataFrame:
    inside = between_days(cleaned, "created_at", low, high)
    if event_type is not None:
        inside = where_eq(inside, "event_type", event_type)
    return count_by(inside, {"event_date": day("created_at")})


def watch_top(counts: DataFrame, k: int = 1000, label: str = "open") -> DataFrame:
    """The most watched repositories with their addresses."""
    return top_k(counts, "watch_count", k, ["name"]).select(
        F.col("name").alias("repo_name"), "watch_count", repo_url("name").alias("url"),
        repo_link("name", label).alias("link"))
