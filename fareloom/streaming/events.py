"""Event-time streams.

State is kept by key and shuffle partition in RocksDB on the executors and saved to the checkpoint
folder, so a lost executor costs the current micro-batch only. The number of shuffle partitions is fixed
by the first run of a checkpoint.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import file_system
from ..sinks.keyed import KeyedTable
from ..sources.topics import stream_files

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_INHERITED = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")


def stream_session(spark: SparkSession, merge_first: bool = True) -> SparkSession:
    """A session of the same application with the state settings of this module.

    ``merge_first`` joins rows to sessions before the shuffle, so that a hot key sends sessions, not
    rows. Late rows are then dropped, and counted, as merged sessions; switch it off to count rows.
    """
    own = spark.newSession()
    for key in _INHERITED:
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    own.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition",
                 str(merge_first).lower())
    return own


def in_event_time(df: DataFrame, ts: str, delay: str = "5 seconds") -> DataFrame:
    """``ts`` as event time; rows later than ``delay`` behind the newest one may be dropped."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def session_stream(events: DataFrame, keys: Sequence[str], ts: str, gap: str = "5 minutes",
                   name: str = "num_trips", column: str = "*") -> DataFrame:
    """Sessions per key of a stream in event time; a session is emitted once the watermark passed it.

    ``column`` counts its non-null values instead of rows.
    """
    window = F.session_window(ts, gap).alias("session")
    return (events.groupBy(*keys, window).agg(F.count(column).alias(name))
            .select(*keys, F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), name))


def tumbling_counts(events: DataFrame, keys: Sequence[str], ts: str, width: str = "1 hour",
                    name: str = "num_hits") -> DataFrame:
    """Rows per key and hour; an hour is emitted once the watermark passed its end."""
    window = F.window(ts, width).alias("hour")
    return (events.groupBy(window, *keys).agg(F.count("*").alias(name))
            .select(F.col("hour.start").alias("event_hour"), *keys, name))


def land(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the rows of a stream, each exactly once, to Parquet files."""
    return (df.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint))


def session_sink(table: KeyedTable, set_columns: Sequence[str], run: str | None = None):
    """A batch function that merges sessions into a keyed table.

    A session that comes again, from a repeated batch or from another run over the same events, replaces itself.
    With the name of a ``run`` (one per checkpoint) batches that were merged before are left out.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, set_columns, run=run, batch=batch_id)
    return write


def with_end(events: DataFrame, session: SparkSession, folder: str) -> DataFrame:
    """A stream that also takes the closing row of ``end_replay`` from ``folder``, which is made here."""
    files, path = file_system(session, folder)
    files.mkdirs(path)
    return events.unionByName(stream_files(session, folder, events.schema))


def end_replay(spark: SparkSession, folder: str, schema: T.StructType, ts: str, at: dt.datetime) -> None:
    """Write the closing row of a finished replay: only its time ``at``, far behind all events, is set.

    The next run of the query takes it, which moves the watermark past everything that is still open. The row's
    own window stays open, so it is in no result.
    """
    row = [F.lit(at).cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
           for f in schema.fields]
    spark.range(1).select(*row).write.mode("append").parquet(folder)


def replay(writer: DataStreamWriter) -> StreamingQuery:
    """Run what has arrived and stop; a live job uses ``processingTime`` in place of this trigger."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def watch_progress(writer: DataStreamWriter, interval: str = "60 seconds") -> StreamingQuery:
    """Run until stopped, with one checkpointed micro-batch per interval."""
    return writer.trigger(processingTime=interval).start()


def split_late(on_time: str, late: str, watermarks: str, ts: str, delay: str = "5 seconds"):
    """A batch function that keeps its own watermark beside its tables and sends the rows behind it to a side table.

    Spark's watermark only counts such rows. Here the watermark of a batch is the newest ``ts`` of all batches before,
    less ``delay``; rows without a time are on time. Each batch has a folder of its own in all three places and a
    repeated one writes the same folders again, so nothing comes twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files, folder = file_system(spark, watermarks)
        known = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        known = [n for n in known if n.startswith("batch=") and int(n[6:]) < batch_id]
        mark = None
        if known:
            mark = spark.read.parquet(*[f"{watermarks}/{n}" for n in known]).agg(F.max("newest")).first()[0]
        behind = F.lit(False) if mark is None else F.coalesce(F.col(ts) < F.lit(mark) - F.expr(f"interval {delay}"), F.lit(False))
        batch = batch.persist()
        batch.where(~behind).write.mode("overwrite").parquet(f"{on_time}/batch={batch_id}")
        batch.where(behind).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        # The watermark goes last: a batch that was broken off is split by the same one again.
        newest = batch.agg(F.max(ts).alias("newest"))
        if mark is not None:
            newest = newest.select(F.greatest("newest", F.lit(mark)).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{watermarks}/batch={batch_id}")
        batch.unpersist()
    return write


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators dropped behind the watermark, batch by batch as they are reported.

    Add it to the streams of a session before the query starts: ``session.streams.addListener(counter)``.
    """

    def __init__(self):
        self._dropped: dict[str, int] = defaultdict(int)
        self._over: set[str] = set()
        self._told = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._told:
            self._dropped[str(event.progress.runId)] += sum(
                s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        with self._told:
            self._over.add(str(event.runId))
            self._told.notify_all()

    def total(self, query: StreamingQuery, timeout: float = 60) -> int:
        """All rows that a finished run dropped. Reports come in order, the end of the run last."""
        run = str(query.runId)
        with self._told:
            if not self._told.wait_for(lambda: run in self._over, timeout):
                raise TimeoutError("the end of the query was not reported")
            return self._dropped[run]
