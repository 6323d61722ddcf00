"""Casts, null handling, code maps and range buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .times import ColumnOrName, _col

NUMERIC = "decimal(38,9)"

# Names of the payment codes.
PAYMENT_NAMES = {
    1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip",
}


# What Spark itself reads as a whole number: blanks and control characters around it are ignored.
_WHOLE_NUMBER = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"


def safe_int(value: ColumnOrName, kind: str = "int", rounded: bool = False, text: bool = False
             ) -> Column:
    """Integer or null, never an error. ``rounded`` is for fractional inputs.

    Say ``text`` for text columns with many values that are no numbers: a failing cast raises and
    catches an error inside, which costs some fifty times the pattern test that avoids it.
    """
    value = _col(value)
    if text:
        value = F.when(value.rlike(_WHOLE_NUMBER), value)
    return (F.round(value) if rounded else value).try_cast(kind)


def safe_ints(df: DataFrame, names: Mapping[str, str]) -> list[Column]:
    """``safe_int`` of columns of ``df``, under new names, with the pattern test on text columns."""
    text = {f.name.lower() for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return [safe_int(column, text=column.lower() in text).alias(name)
            for column, name in names.items()]


def numeric(value: ColumnOrName) -> Column:
    return _col(value).cast(NUMERIC)


def first_non_null(*values: ColumnOrName) -> Column:
    return F.coalesce(*[_col(v) for v in values])


def null_if(value: ColumnOrName, unwanted) -> Column:
    return F.nullif(_col(value), unwanted if isinstance(unwanted, Column) else F.lit(unwanted))


def pct_change(new: ColumnOrName, old: ColumnOrName, scale: int = 2) -> Column:
    """Growth in percent; null when the old value is null or zero."""
    new, old = _col(new).cast("double"), _col(old).cast("double")
    return F.round((new - old) / F.nullif(old, F.lit(0.0)) * 100, scale)


def map_codes(value: ColumnOrName, names: Mapping, default: str) -> Column:
    """The name of a code, else ``default``. The code expression is evaluated once."""
    table = F.create_map(*[F.lit(item) for pair in names.items() for item in pair])
    return F.coalesce(F.try_element_at(table, _col(value)), F.lit(default))


def payment_description(code: ColumnOrName, text: bool = False) -> Column:
    """The payment name; unknown codes and null give ``EMPTY``."""
    return map_codes(safe_int(code, text=text), PAYMENT_NAMES, "EMPTY")


def bucket(value: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
           null_label: str | None = None) -> Column:
    """Label by the first upper edge (inclusive) that is not passed; the last label is open.

    Null goes to the last label like any value above all edges, unless ``null_label`` is given.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    value = _col(value)
    result = F.when(value <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        result = result.when(value <= edge, label)
    if null_label is not None:
        result = result.when(value.isNull(), null_label)
    return result.otherwise(labels[-1])
