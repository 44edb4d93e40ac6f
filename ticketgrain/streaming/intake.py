"""Ticket intake and live dashboard as streaming queries.

``intake`` is a stateless projection, so the batch operator is the streaming
operator.  The dashboard keeps one counter per (dimension, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketgrain.operators import workflow
from ticketgrain.streaming import folders


def start_intake(submissions: DataFrame, table: str, checkpoint: str, **rules) -> StreamingQuery:
    """Append routed tickets to a parquet table; exactly once through the checkpoint."""
    return (
        workflow.intake(submissions, **rules)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def live_distributions(tickets: DataFrame) -> DataFrame:
    """Tickets per priority and type over everything that arrived."""
    return workflow.dashboard_distributions(tickets)


def with_ticket_key(tickets: DataFrame) -> DataFrame:
    """Column ``ticket_key``: a digest of subject, body and time of submission.

    A dense id needs all tickets in one order, which a stream does not have; equal submissions have
    equal keys wherever and whenever they arrive.  Lengths keep the parts apart, nulls differ from
    empty strings.
    """
    parts = [F.col("subject"), F.col("body"), F.unix_micros("created_at").cast("string")]
    written = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return tickets.withColumn("ticket_key", F.sha2(F.concat(*written), 256))


def without_repeats(tickets: DataFrame, late: str = "1 day") -> DataFrame:
    """A stream of tickets in which a submission that comes again within ``late`` counts once.

    State is held for one key a ticket until the watermark passes its time plus ``late``.
    """
    return with_ticket_key(tickets).withWatermark("created_at", late).dropDuplicatesWithinWatermark(["ticket_key"])


def start_unique_intake(submissions: DataFrame, table: str, checkpoint: str, late: str = "1 day", **rules) -> StreamingQuery:
    """``start_intake`` with content keys and without repeated submissions."""
    return (
        workflow.intake(without_repeats(submissions, late), **rules)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def daily_distributions(tickets: DataFrame, late: str = "1 day") -> DataFrame:
    """The same per day of submission; in append mode a day goes out once, when the watermark passes its end."""
    return (
        tickets.withWatermark("created_at", late)
        .select("created_at", workflow._dimensions(tickets))
        .groupBy(F.window("created_at", "1 day").alias("day"), "dimension", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def start_dashboard(tickets: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Keep the current distributions as a parquet table.

    Each batch writes a folder of its own below ``table``, and those that no rerun can need are
    removed; ``read_dashboard`` takes the newest complete one, so readers never meet a half-written
    state.
    """
    spark = tickets.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        folders.write(batch, table, number)
        folders.remove(spark, table, [n for n in folders.numbers(spark, table) if n < number][:-1])

    return (
        live_distributions(tickets)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )


def read_dashboard(spark: SparkSession, table: str) -> DataFrame:
    """The state after the last batch of ``start_dashboard``."""
    return folders.read(spark, table, folders.numbers(spark, table)[-1:], "dimension string, value string, n long").drop("batch")


def start_daily_dashboard(tickets: DataFrame, table: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Distributions of each day, written once when the day closes, and counts of rows that came later.

    A day closes after the micro-batch in which the latest submission so far lies ``late`` or more
    after its end.  Below ``table``: ``closed`` has each day's final counts, ``late`` the counts of rows
    whose day was closed when they arrived (or that have no time), ``open`` what is carried to the next
    micro-batch: the days that are not closed, a few rows each, and the latest time.  On-time and late
    rows together are all that arrived.
    """
    spark = tickets.sparkSession
    delay = F.expr(f"interval {late}")

    def add(batch: DataFrame, number: int) -> None:
        done = [n for n in folders.numbers(spark, f"{table}/open") if n < number]
        before = folders.read(spark, f"{table}/open", done[-1:], _OPEN).select("day", "dimension", "value", "n", "latest")
        closed_until = before.select((F.max("latest") - delay).alias("until")).first()[0]
        day = F.date_trunc("day", "created_at").alias("day")
        new = batch.select(day, "created_at", workflow._dimensions(batch)).groupBy("day", "dimension", "value")
        new = new.agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest")).persist()
        end = F.col("day") + F.expr("interval 1 day")
        is_late = F.col("day").isNull() | F.coalesce(end <= F.lit(closed_until), F.lit(False))
        folders.write(new.filter(is_late).select("day", "dimension", "value", "n").coalesce(1), f"{table}/late", number)
        held = new.filter(~is_late).unionByName(before).groupBy("day", "dimension", "value")
        held = held.agg(F.sum("n").alias("n"), F.max("latest").alias("latest")).persist()
        latest = held.unionByName(new).select(F.max("latest")).first()[0]
        is_closed = F.coalesce(end <= F.lit(latest) - delay, F.lit(False))
        counts = held.filter(F.col("day").isNotNull())
        folders.write(counts.filter(is_closed).select("day", "dimension", "value", "n").coalesce(1), f"{table}/closed", number)
        # one row without a day carries the latest time when no day is open
        clock = spark.createDataFrame([(None, None, None, 0, latest)], _OPEN)
        carried = counts.filter(~is_closed).unionByName(clock).select("day", "dimension", "value", "n", "latest")
        folders.write(carried.coalesce(1), f"{table}/open", number)
        folders.remove(spark, f"{table}/open", done[:-1])
        new.unpersist()
        held.unpersist()

    return (
        tickets.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )


_DAY = "day timestamp, dimension string, value string, n long"
_OPEN = f"{_DAY}, latest timestamp"


def read_days(spark: SparkSession, table: str, part: str = "closed") -> DataFrame:
    """day, dimension, value, n of the closed days, of the late rows (``part='late'``) or of the days still open (``open``)."""
    done = folders.numbers(spark, f"{table}/open")
    batches = done[-1:] if part == "open" else [n for n in folders.numbers(spark, f"{table}/{part}") if n <= max(done, default=-1)]
    found = folders.read(spark, f"{table}/{part}", batches, _DAY)
    if part == "open":
        found = found.filter("day IS NOT NULL")  # not the row that carries the latest time
    return found.groupBy("day", "dimension", "value").agg(F.sum("n").alias("n"))


def read_all_days(spark: SparkSession, table: str) -> DataFrame:
    """day, dimension, value, n of everything that arrived: closed days, open days and late rows."""
    closed, still_open, late = (read_days(spark, table, part) for part in ("closed", "open", "late"))
    return closed.unionByName(still_open).unionByName(late).groupBy("day", "dimension", "value").agg(F.sum("n").alias("n"))
