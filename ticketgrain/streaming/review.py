"""Review state over a stream of actions.

One small state per ticket.  Micro-batches count in arrival order, as they do for
a reviewer pressing buttons; inside a micro-batch actions are ordered by event
time.  The first approve or reject closes the ticket, later actions are ignored.

With a watermark, the state of a closed ticket is removed ``retention`` of event time after it was
closed.  What is written stays, so an action that comes later still changes nothing: of the states of
a ticket the first closed one counts.  ``start_review`` writes a folder for each micro-batch and
compacts them: closed tickets are moved once to folders that are never read for compaction again,
open ones are carried, so a compaction costs as much as is open or new.

Needs the RocksDB state store:
``spark.sql.streaming.stateStore.providerClass =
org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ticketgrain.functions import fixed_values as V
from ticketgrain.operators.workflow import TERMINAL
from ticketgrain.streaming import folders

OUTPUT = "ticket_id long, status string, edited_response string, final_text string, reviewer string"
_REVIEW = "status string, edited string, final_text string, reviewer string"
_EDIT = "ts_us long, action_id long, text string"
# Edits of one ticket and micro-batch that a task holds in memory.
_HELD_EDITS = 1000


class _ReviewProcessor(StatefulProcessor):
    def __init__(self, retention_ms: int | None = None) -> None:
        self._retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._review = handle.getValueState("review", _REVIEW)
        self._edits = handle.getListState("edits", _EDIT)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        before = self._review.get()
        status, edited, final_text, reviewer = before or (V.STATUS_PENDING, None, None, None)
        if status == V.STATUS_PENDING:
            place, close, edits, stored = None, None, [], False
            # Edits wait until the batch's first terminal action is known: beyond a bounded
            # number in the state store, not in memory.
            for row in rows:
                at = order_of(row.ts_us, row.action_id)
                if place is not None and at >= place:
                    continue
                if row.action in TERMINAL:
                    place, close = at, row
                elif row.action == "modify":
                    edits.append((row.ts_us, row.action_id, row.text))
                    if len(edits) == _HELD_EDITS:
                        self._edits.appendList(edits)
                        edits, stored = [], True
            last = None
            for ts_us, action_id, text in chain(self._edits.get() if stored else (), edits):
                at = order_of(ts_us, action_id)
                if (place is None or at < place) and (last is None or at > last[0]):
                    last = (at, text)
            if stored:
                self._edits.clear()
            edited = last[1] if last is not None else edited
            if close is not None and close.action == "approve":
                status, final_text, reviewer = V.STATUS_APPROVED, close.text, close.reviewer
            elif close is not None:
                status = V.STATUS_REJECTED
            self._review.update((status, edited, final_text, reviewer))
            if close is not None and self._retention_ms is not None:
                self._handle.registerTimer(since(close.ts_us, timer_values) + self._retention_ms)
        yield Row(ticket_id=key[0], status=status, edited_response=edited, final_text=final_text, reviewer=reviewer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._review.clear()
        yield from ()

    def close(self) -> None:
        pass


def order_of(*values) -> tuple:
    """A tuple that orders as (time, id) does, nulls last."""
    return tuple((value is None, value or 0) for value in values)


def since(ts_us: int | None, timer_values) -> int:
    """The event time in milliseconds from which a closed ticket is retained."""
    now = timer_values.getCurrentWatermarkInMs()
    return now if ts_us is None else max(ts_us // 1000, now)


def review_stream(actions: DataFrame, late: str | None = None, retention: str = "30 days") -> DataFrame:
    """Latest review state of every ticket touched by a batch of actions.

    With ``late`` (a watermark on ``ts``) older actions are dropped by the engine, and states go
    ``retention`` after their ticket was closed; without it they stay for ever.
    """
    keyed = actions.select(
        "ticket_id", "ts", F.unix_micros("ts").alias("ts_us"), "action_id", "action", "text", "reviewer"
    )
    if late is None:
        keyed, processor, mode = keyed.drop("ts"), _ReviewProcessor(), "None"
    else:
        processor, mode = _ReviewProcessor(milliseconds(actions.sparkSession, retention)), "EventTime"
        keyed = keyed.withWatermark("ts", late)
    return keyed.groupBy("ticket_id").transformWithState(
        statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Update", timeMode=mode
    )


def milliseconds(spark: SparkSession, interval: str) -> int:
    """Length of an interval such as ``2 days`` or ``90 minutes``."""
    epoch = F.unix_millis(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp") + F.expr(f"interval {interval}"))
    zero = F.unix_millis(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp"))
    return spark.range(1).select(epoch - zero).first()[0]


def start_review(
    actions: DataFrame,
    table: str,
    checkpoint: str,
    late: str | None = None,
    retention: str = "30 days",
    compact_every: int = 16,
) -> StreamingQuery:
    """Keep the state of every touched ticket below ``table``; ``read_reviews`` reads it.

    ``new`` has a folder for each micro-batch.  When there are ``compact_every`` of them they are
    folded: closed tickets go to ``closed``, the others to ``open``.
    """
    spark = actions.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        folders.write(batch, f"{table}/new", number)
        folded = folders.numbers(spark, f"{table}/open")
        if len([n for n in folders.numbers(spark, f"{table}/new") if n > max(folded, default=-1)]) >= compact_every:
            compact_reviews(spark, table)

    return (
        review_stream(actions, late, retention)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )


def compact_reviews(spark: SparkSession, table: str) -> None:
    """Fold the micro-batches since the last time; what a reader may still use is removed the next time."""
    folded = folders.numbers(spark, f"{table}/open")
    batches = folders.numbers(spark, f"{table}/new")
    new = [n for n in batches if n > max(folded, default=-1)]
    if not new:
        return
    states = _resolved(_since(spark, table, folded[-1:], new)).persist()
    is_open = F.col("status") == V.STATUS_PENDING
    folders.write(states.filter(~is_open), f"{table}/closed", new[-1])
    folders.write(states.filter(is_open), f"{table}/open", new[-1])
    states.unpersist()
    folders.remove(spark, f"{table}/open", folded[:-1])
    folders.remove(spark, f"{table}/new", [n for n in batches if n <= max(folded, default=-1)])


def _since(spark: SparkSession, table: str, folded: list[int], new: list[int]) -> DataFrame:
    """The open tickets of the last compaction and the states written after it, with the batch of each."""
    carried = folders.read(spark, f"{table}/open", folded, f"{OUTPUT}, written int").drop("batch")
    return carried.unionByName(folders.read(spark, f"{table}/new", new, OUTPUT).withColumnRenamed("batch", "written"))


def _resolved(states: DataFrame) -> DataFrame:
    """One row a ticket: the first closed state, else the last one."""
    row = F.struct(*states.columns)
    closed = F.min_by(row, F.when(F.col("status") != V.STATUS_PENDING, F.col("written")))
    found = states.groupBy("ticket_id").agg(F.coalesce(closed, F.max_by(row, "written")).alias("row"))
    return found.select("row.*")


def read_reviews(spark: SparkSession, table: str) -> DataFrame:
    """The state of every ticket that ``start_review`` has seen."""
    folded = folders.numbers(spark, f"{table}/open")
    last = max(folded, default=-1)
    closed = [n for n in folders.numbers(spark, f"{table}/closed") if n <= last]
    new = [n for n in folders.numbers(spark, f"{table}/new") if n > last]
    states = _since(spark, table, folded[-1:], new)
    if closed:
        states = states.unionByName(folders.read(spark, f"{table}/closed", closed, f"{OUTPUT}, written int").drop("batch"))
    return _resolved(states).drop("written")
