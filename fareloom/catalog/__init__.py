"""The jobs applied to the star-schema test tables, each with the SQL that must give the same rows."""

from . import activity, files, questions, streams, tables_io, trips  # noqa: F401  (fills the registry)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
