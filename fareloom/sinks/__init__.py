"""Writers: files, tables, keyed tables, incremental aggregates, and topic messages."""

from .files import write_clustered, write_csv, write_parquet, write_partitioned
from .incremental import IncrementalAggregate
from .keyed import KeyedTable
from .tables import (Layers, append, create_as, ensure_table, materialize, model, replace,
                     replace_schema, required)
from .topics import json_payload, publish_json

__all__ = [
    "IncrementalAggregate", "KeyedTable", "Layers", "append", "create_as", "ensure_table", "json_payload",
    "materialize", "model", "publish_json", "replace", "replace_schema", "required", "write_clustered", "write_csv",
    "write_parquet", "write_partitioned",
]
