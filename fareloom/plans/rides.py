"""Rides loaded from pages of a web service."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import boundary_minutes, parse_ts
from ..operators.aggregates import avg_of
from ..sources.files import snake_case

TIMES = ["trip_pickup_date_time", "trip_dropoff_date_time"]


def load_rides(pages: DataFrame) -> DataFrame:
    """Page records under snake-case names, with real times."""
    rides = snake_case(pages)
    return rides.withColumns({c: parse_ts(c) for c in TIMES})


def avg_duration_minutes(rides: DataFrame) -> DataFrame:
    return avg_of(rides, boundary_minutes(*TIMES), "avg_minutes")
