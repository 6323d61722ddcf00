"""Text, key and display functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import ColumnOrName, _col

# Fixed value: the token the common surrogate-key macro writes for a null field.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _text(value: ColumnOrName, blank: str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(blank))


def concat_blank(*values: ColumnOrName) -> Column:
    """All values as one text, null as nothing."""
    return F.concat(*[_text(v, "") for v in values])


def row_hash(*values: ColumnOrName) -> Column:
    return F.md5(concat_blank(*values).cast("binary"))


def surrogate_key(*values: ColumnOrName, null_token: str = NULL_TOKEN) -> Column:
    return F.md5(F.concat_ws("-", *[_text(v, null_token) for v in values]).cast("binary"))


def replace_text(value: ColumnOrName, old: str, new: str) -> Column:
    return F.replace(_col(value), F.lit(old), F.lit(new))


def thousands(number: ColumnOrName) -> Column:
    """A count for display, such as ``104,838``. Keep the number beside it."""
    return F.format_number(_col(number), 0)


def display_ts(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def repo_url(name: ColumnOrName) -> Column:
    return F.concat(F.lit("http://github.com/"), _col(name))


def repo_link(name: ColumnOrName, label: str) -> Column:
    return F.concat(F.lit('<a href="'), repo_url(name), F.lit(f'" target="_blank">{label}</a>'))


def file_name(path: ColumnOrName | None = None) -> Column:
    """The last path segment; without an argument, of the file the row was read from."""
    if path is None:
        return F.col("_metadata.file_name")
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)
