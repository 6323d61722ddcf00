"""Column functions: every one takes and returns a Column and stays inside generated JVM code."""

from .text import (concat_blank, display_ts, file_name, replace_text, repo_link, repo_url,
                   row_hash, surrogate_key, thousands)
from .times import (boundary_minutes, date_parts, day, days_before, floor_milli, floor_second,
                    hours_between, month_start, naive_utc, parse_ts, seconds_between,
                    year_quarter)
from .values import (bucket, first_non_null, map_codes, null_if, numeric, payment_description,
                     pct_change, safe_int, safe_ints)

__all__ = [
    "boundary_minutes", "bucket", "concat_blank", "date_parts", "day", "days_before",
    "display_ts", "file_name", "first_non_null", "floor_milli", "floor_second", "hours_between",
    "map_codes", "month_start", "naive_utc", "null_if", "numeric", "parse_ts",
    "payment_description", "pct_change", "replace_text", "repo_link", "repo_url", "row_hash",
    "safe_int", "safe_ints", "seconds_between", "surrogate_key", "thousands", "year_quarter",
]
