"""Live counters: total, approved, pending and high-priority tickets while tickets and actions arrive.

Tickets and terminal actions are one stream, keyed by ticket.  The state of a ticket is whether it
was submitted and how it was closed; each change goes out as +1 or -1 on the counters, so that an
approval takes back the ``pending`` that the submission had added.  The counters of a micro-batch
are those of the batch before plus the batch's changes.

Actions may come before their ticket; they count once it is there.  Micro-batches count in arrival
order, inside one the first terminal action by (time, action id) closes the ticket; edits, later
actions and repeated submissions change nothing.

State is held for open tickets, and for ``retention`` of event time after a terminal action: then an
event-time timer removes it.  Rows older than the watermark (``late``) are dropped by the engine.

Needs the RocksDB state store, see ``streaming.review``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ticketgrain.operators.workflow import TERMINAL
from ticketgrain.streaming import folders
from ticketgrain.streaming.review import milliseconds, order_of, since

COUNTERS = ("total", "approved", "pending", "high_priority")
_DELTAS = ", ".join(f"{c} long" for c in COUNTERS)
_SUBMITTED, _HIGH = "submitted", "high"


def facts(tickets: DataFrame, actions: DataFrame, late: str) -> DataFrame:
    """One stream of what changes a counter: ticket_id, ts, action_id, kind, high, ts_us."""
    submitted = tickets.select(
        F.col("id").alias("ticket_id"),
        F.col("created_at").alias("ts"),
        F.lit(0).cast("long").alias("action_id"),
        F.lit(_SUBMITTED).alias("kind"),
        F.coalesce(F.col("classification.priority") == "high", F.lit(False)).alias(_HIGH),
    )
    closed = actions.filter(F.col("action").isin(*TERMINAL)).select(
        "ticket_id", "ts", "action_id", F.col("action").alias("kind"), F.lit(False).alias(_HIGH)
    )
    both = submitted.unionByName(closed).filter("ticket_id IS NOT NULL")
    return both.withColumn("ts_us", F.unix_micros("ts")).withWatermark("ts", late)


class _CounterProcessor(StatefulProcessor):
    def __init__(self, retention_ms: int) -> None:
        self._retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._ticket = handle.getValueState("ticket", f"{_SUBMITTED} boolean, {_HIGH} boolean, closed string")

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        before = tuple(self._ticket.get() or (False, False, None))
        submitted, high, closed = before
        first = opened = None
        for row in rows:
            place = order_of(row.ts_us, row.action_id)
            if row.kind == _SUBMITTED:
                opened = (place, row) if opened is None or place < opened[0] else opened
            else:
                first = (place, row) if first is None or place < first[0] else first
        if opened is not None and not submitted:
            submitted, high = True, opened[1][_HIGH]
        if first is not None and closed is None:
            closed = first[1].kind
            self._handle.registerTimer(since(first[1].ts_us, timer_values) + self._retention_ms)
        after = (submitted, high, closed)
        if after != before:
            self._ticket.update(after)
        change = [b - a for a, b in zip(_counted(before), _counted(after), strict=True)]
        if any(change):
            yield Row(**dict(zip(COUNTERS, change, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._ticket.clear()
        yield from ()

    def close(self) -> None:
        pass


def _counted(ticket: tuple) -> tuple[int, int, int, int]:
    """What one ticket adds to each counter."""
    submitted, high, closed = ticket
    return int(submitted), int(submitted and closed == "approve"), int(submitted and closed is None), int(submitted and high)


def changes(tickets: DataFrame, actions: DataFrame, late: str = "1 day", retention: str = "30 days") -> DataFrame:
    """The +1 and -1 that tickets and actions make, a row for each changed ticket and micro-batch."""
    keyed = facts(tickets, actions, late).groupBy("ticket_id")
    return keyed.transformWithState(
        statefulProcessor=_CounterProcessor(milliseconds(tickets.sparkSession, retention)),
        outputStructType=_DELTAS,
        outputMode="Update",
        timeMode="EventTime",
    )


def start_counters(
    tickets: DataFrame, actions: DataFrame, table: str, checkpoint: str, late: str = "1 day", retention: str = "30 days"
) -> StreamingQuery:
    """Keep the counters as one row a micro-batch; folders that no rerun can need are removed.

    ``tickets`` is a stream of id, created_at and classification.priority, ``actions`` one of
    ticket_id, action_id, ts and action.
    """
    spark = tickets.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        done = [n for n in folders.numbers(spark, table) if n < number]
        before = folders.read(spark, table, done[-1:], _DELTAS).select(*COUNTERS)
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS]
        folders.write(batch.select(*COUNTERS).unionByName(before).agg(*sums).coalesce(1), table, number)
        folders.remove(spark, table, done[:-1])

    return (
        changes(tickets, actions, late, retention)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )


def read_counters(spark: SparkSession, table: str) -> DataFrame:
    """total, approved, pending, high_priority after the last micro-batch; zeros before the first."""
    last = folders.read(spark, table, folders.numbers(spark, table)[-1:], _DELTAS)
    return last.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS])

