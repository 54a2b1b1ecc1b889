"""Keyed state of entities in a stream: streaks, last success and rolling latencies as one state variable, and timers for entities that stay away.

One processor holds the step of the batch operators.  Observations of an entity are put in order of time within a micro-batch; each gives the
entity's state after it.  An entity that isn't seen for longer than ``absent`` of event time gives one row of status ``missing``, counts
as a failure, and keeps its last success, as a child does that vanished from its source.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from siftspark.schemas import HISTORY

OUT = "entity_id long, event_id long, ts timestamp, technical_status string, consecutive_successes long, consecutive_failures long, last_success_at timestamp, latencies array<long>"
#: Times are microseconds inside the processor, so that no time zone comes into it.
_ROWS = "entity_id long, event_id long, at long, technical_status string, consecutive_successes long, consecutive_failures long, last_success long, latencies array<long>"
_ROW = Row(*(column.split()[0] for column in _ROWS.split(", ")))
_STATE = "successes long, failures long, last_success long, seen long, latencies array<long>"


class Tracker(StatefulProcessor):
    """State of one entity: its streaks and times, the latencies of its last successes, and a timer while it is expected back.

    All of it is one variable, read once and written once a batch: an entity costs two calls to the state store, not six."""

    def __init__(self, absent: timedelta | None = None):
        self.absent = absent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("entity", _STATE)

    def _read(self) -> tuple:
        return self.state.get() or (0, 0, None, None, [])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        successes, failures, last, seen, held = self._read()
        held, out = list(held), []
        for row in sorted(rows, key=lambda r: (r["at"], r["event_id"])):
            at, latency = row["at"], row["latency"]
            if row["technical_status"] == "healthy":
                successes, failures, last = successes + 1, 0, at
                held = (held + [latency])[-HISTORY:] if latency is not None else held
            else:
                successes, failures = 0, failures + 1
            seen = at if seen is None else max(seen, at)
            out.append(_ROW(key[0], row["event_id"], at, row["technical_status"], successes, failures, last, held))
        self.state.update((successes, failures, last, seen, held))
        if self.absent is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            self.handle.registerTimer((seen + self.absent // timedelta(microseconds=1)) // 1000)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        successes, failures, last, seen, held = self._read()
        self.state.update((0, failures + 1, last, seen, held))
        yield _ROW(key[0], None, expiredTimerInfo.getExpiryTimeInMs() * 1000, "missing", 0, failures + 1, last, list(held))

    def close(self) -> None:
        pass


def tracked(observations: DataFrame, late: str = "1 hour", absent: timedelta | None = None, before: DataFrame | None = None) -> DataFrame:
    """The state after each observation of a stream (entity_id long, event_id long, ts, technical_status, latency long).

    Rows later than the watermark are left out.  The session needs the RocksDB state store, which keeps state on disk and in the
    checkpoint, so that memory is bounded by one entity's batch and a restart goes on where the last batch ended."""
    rows = observations.select(F.col("entity_id").cast("long"), F.col("event_id").cast("long"), "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "technical_status", F.col("latency").cast("long"))
    found = rows.withWatermark("ts", late).groupBy("entity_id").transformWithState(
        statefulProcessor=Tracker(absent), outputStructType=_ROWS, outputMode="Append", timeMode="EventTime" if absent is not None else "None"
    )
    times = {"ts": F.timestamp_micros("at"), "last_success_at": F.timestamp_micros("last_success")}
    return found.select(*(times[c].alias(c) if c in times else c for c in (column.split()[0] for column in OUT.split(", "))))


#: The state store that ``tracked`` needs, by the name of its setting.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def replayed(spark: SparkSession, path: str, convert, place: str, late: str = "1 hour", bytes_a_batch: int = 64 << 20) -> DataFrame:
    """All states of a table of recorded observations, replayed as a stream into a folder, in a session of its own settings.

    ``convert`` turns the table's rows into observations.  Batches are bounded by bytes; files are read in the order of their times."""
    own = spark.newSession()
    own.conf.set(*STATE_STORE)
    schema = spark.read.parquet(path).schema
    # As a pattern that fits the path alone: a stream takes a folder or a pattern, and the table may be one file.
    source = own.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_a_batch)).parquet(f"{path[:-1]}[{path[-1]}]")
    query = tracked(convert(source), late).writeStream.format("parquet").option("path", f"{place}/states").option("checkpointLocation", f"{place}/check").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(OUT).parquet(f"{place}/states")
