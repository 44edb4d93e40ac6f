"""Intake, review state and dashboard, in batch and as streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketgrain import schemas
from ticketgrain.operators import workflow as wf
from ticketgrain.streaming import counters, folders, review
from ticketgrain.streaming import intake as streams

T0 = dt.datetime(2024, 1, 1)


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


SUBMISSIONS = [
    (1, "Urgent: download", "the site is down", at(0)),
    (2, "", "no subject", at(1)),
    (3, "Question", "", at(2)),
    (4, "Question", "where is my invoice", at(3)),
    (5, "Hello", "slow product", at(3)),
]


@pytest.fixture()
def submissions(spark):
    return spark.createDataFrame(SUBMISSIONS, schemas.SUBMISSIONS)


def test_intake(submissions):
    tickets = wf.intake(submissions)
    got = {r["key"]: r for r in tickets.collect()}
    assert set(got) == {1, 4, 5}  # subject and body are both needed
    assert got[1]["classification"]["priority"] == "high"
    assert (got[4]["classification"]["queue"], got[4]["classification"]["priority"]) == ("Billing and Payments", "low")
    assert {r["status"] for r in got.values()} == {"pending_review"}
    assert {r["final_response"] for r in got.values()} == {None}
    numbered = {r["key"]: r["id"] for r in wf.number_tickets(tickets).collect()}
    assert numbered == {1: 1, 4: 2, 5: 3}


def test_history_filters_combine(submissions):
    tickets = wf.intake(submissions)
    assert wf.history(tickets).count() == 3
    assert {r["key"] for r in wf.history(tickets, priority="low").collect()} == {4}
    assert {r["key"] for r in wf.history(tickets, search="PRODUCT").collect()} == {5}
    assert {r["key"] for r in wf.history(tickets, status="pending_review", search="down").collect()} == {1}
    assert wf.history(tickets, status="approved").count() == 0


ACTIONS = [
    # ticket 1: edit, approve with the edited text, then ignored actions
    (1, 1, at(1), "modify", "better", None),
    (1, 2, at(2), "approve", None, "Kim"),
    (1, 3, at(3), "modify", "too late", None),
    (1, 4, at(4), "reject", None, None),
    # ticket 2: two edits, last one stays, still open
    (2, 5, at(1), "modify", "first", None),
    (2, 6, at(2), "modify", "second", None),
    # ticket 3: rejected; ticket 4: approved without a name; ties go by action id
    (3, 7, at(1), "reject", None, None),
    (4, 8, at(5), "approve", "sent text", None),
    (4, 9, at(5), "reject", None, None),
    # an unknown ticket
    (99, 10, at(1), "approve", None, None),
]
EXPECTED = [
    (1, "better", "approved", "better", "Kim"),
    (2, "second", "pending_review", None, None),
    (3, "suggested 3", "rejected", None, None),
    (4, "suggested 4", "approved", "sent text", "Admin"),
    (5, "suggested 5", "pending_review", None, None),
]


@pytest.fixture()
def tickets(spark):
    return spark.range(1, 6).select(
        "id",
        F.concat(F.lit("suggested "), F.col("id").cast("string")).alias("suggested_response"),
        F.struct(F.when(F.col("id") == 1, "high").otherwise("low").alias("priority"), F.lit("Request").alias("type")).alias("classification"),
        F.lit("pending_review").alias("status"),
        F.lit(None).cast("string").alias("final_response"),
        F.lit(None).cast("string").alias("reviewed_by"),
    )


def test_review_state(spark, tickets):
    actions = spark.createDataFrame(ACTIONS, schemas.ACTIONS)
    state = wf.review_state(tickets, actions)
    assert rows(state, "id", "suggested_response", "status", "final_response", "reviewed_by") == EXPECTED
    assert rows(wf.pending_tickets(tickets, actions), "id") == [(2,), (5,)]
    assert tuple(wf.dashboard_counters(state).first()) == (5, 2, 2, 1)
    assert rows(wf.dashboard_distributions(state)) == [
        ("priority", "high", 1), ("priority", "low", 4), ("type", "Request", 5),
    ]


def test_review_state_with_one_hot_ticket(spark, tickets):
    edits = spark.range(3000).select(
        F.lit(1).cast("long").alias("ticket_id"), F.col("id").alias("action_id"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.lit("modify").alias("action"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("text"), F.lit(None).cast("string").alias("reviewer"),
    )
    close = spark.createDataFrame([(1, 5000, dt.datetime(1970, 1, 1, 0, 20), "approve", None, "Kim")], schemas.ACTIONS)
    row = wf.review_state(tickets, edits.union(close)).filter("id = 1").first()
    # the edit of the same second has the smaller action id, so it came first
    assert (row["status"], row["final_response"]) == ("approved", "v1200")


def write_batches(spark, data, schema, folder, size):
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], schema).coalesce(1).write.mode("append").parquet(folder)


def test_streamed_intake_equals_batch(spark, submissions, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(spark, SUBMISSIONS, schemas.SUBMISSIONS, source, 2)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).option("maxFilesPerTrigger", 1).parquet(source)
    streams.start_intake(stream, f"{base}/tickets", f"{base}/checkpoint").awaitTermination()
    batch = wf.intake(submissions)
    columns = ["key", "status", "suggested_response"]
    assert rows(spark.read.parquet(f"{base}/tickets"), *columns) == rows(batch, *columns)
    # a restart from the checkpoint adds only what is new
    write_batches(spark, [(6, "Hi", "bug", at(9))], schemas.SUBMISSIONS, source, 1)
    streams.start_intake(stream, f"{base}/tickets", f"{base}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{base}/tickets").count() == 4


def test_live_dashboard_equals_batch(spark, submissions, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(spark, SUBMISSIONS, schemas.SUBMISSIONS, source, 2)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).option("maxFilesPerTrigger", 1).parquet(source)
    streams.start_dashboard(wf.intake(stream), f"{base}/table", f"{base}/checkpoint").awaitTermination()
    batch = wf.dashboard_distributions(wf.intake(submissions))
    assert rows(streams.read_dashboard(spark, f"{base}/table")) == rows(batch)


def test_daily_dashboard_closes_days(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(1, "a", "bug", at(0)), (2, "b", "bug", at(10)), (3, "c", "urgent", at(3 * 24 * 60))]
    write_batches(spark, data, schemas.SUBMISSIONS, source, 1)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).parquet(source)
    query = (
        streams.daily_distributions(wf.intake(stream)).writeStream.format("parquet").option("path", f"{base}/d")
        .option("checkpointLocation", f"{base}/c").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = spark.read.parquet(f"{base}/d").select("dimension", "value", "n")
    assert rows(closed) == [("priority", "medium", 2), ("type", "Incident", 2)]


@pytest.mark.parametrize("batch_size", [1, 3, 100])
def test_streamed_review_equals_batch(spark, tickets, tmp_path, batch_size):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(spark, sorted(ACTIONS, key=lambda a: (a[2], a[1])), schemas.ACTIONS, source, batch_size)
    stream = spark.readStream.schema(schemas.ACTIONS).option("maxFilesPerTrigger", 1).parquet(source)

    def append(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{base}/states")

    query = (
        review.review_stream(stream).writeStream.foreachBatch(append).outputMode("update")
        .option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = spark.read.parquet(f"{base}/states")
    latest = states.groupBy("ticket_id").agg(
        *[F.max_by(c, "batch").alias(c) for c in ("status", "edited_response", "final_text", "reviewer")]
    )
    assert rows(latest) == [
        (1, "approved", "better", None, "Kim"),
        (2, "pending_review", "second", None, None),
        (3, "rejected", None, None, None),
        (4, "approved", None, "sent text", None),
        (99, "approved", None, None, None),
    ]


def progress_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_review_states_go_after_their_time_and_batches_are_folded(spark, tmp_path):
    """Closed tickets leave the state store, not the table; a late action on one changes nothing."""
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    day = 24 * 60
    acts = [(i, i, at(i), "approve" if i % 2 else "modify", f"text {i}", None) for i in range(1, 9)]
    acts += [(100 + k, 100 + k, at(k * day), "modify", f"day {k}", None) for k in range(1, 7)]
    acts += [(1, 200, at(6 * day), "reject", None, None), (2, 201, at(6 * day + 1), "reject", None, None)]
    write_batches(spark, acts[:8], schemas.ACTIONS, source, 8)
    write_batches(spark, acts[8:], schemas.ACTIONS, source, 1)
    stream = spark.readStream.schema(schemas.ACTIONS).option("maxFilesPerTrigger", 1).parquet(source)
    query = review.start_review(stream, f"{base}/t", f"{base}/c", late="1 hour", retention="2 days", compact_every=3)
    query.awaitTermination()
    held = progress_rows(query)
    # 8 tickets, then one more a day; the four closed ones are removed, ticket 1 comes again, ticket 2 is closed
    assert min(b - a for a, b in zip(held, held[1:])) <= -3 and max(held) < 14
    wanted = [(i, "approved" if i % 2 else "pending_review", None if i % 2 else f"text {i}") for i in range(1, 9)]
    wanted[1] = (2, "rejected", "text 2")
    wanted += [(100 + k, "pending_review", f"day {k}") for k in range(1, 7)]
    assert rows(review.read_reviews(spark, f"{base}/t"), "ticket_id", "status", "edited_response") == sorted(wanted, key=repr)
    parts = {part: folders.numbers(spark, f"{base}/t/{part}") for part in ("new", "open", "closed")}
    assert len(parts["new"]) < 9 and 1 <= len(parts["open"]) <= 2 and len(parts["closed"]) >= 2
    review.compact_reviews(spark, f"{base}/t")
    review.compact_reviews(spark, f"{base}/t")
    assert rows(review.read_reviews(spark, f"{base}/t"), "ticket_id", "status", "edited_response") == sorted(wanted, key=repr)


SUBMITTED = [(i, at(i), {"priority": "high" if i % 3 == 0 else "low"}) for i in range(1, 8)]
CLOSING = [
    (1, 1, at(9), "approve", None, None), (2, 2, at(9), "reject", None, None), (3, 3, at(9), "modify", "x", None),
    (1, 4, at(10), "reject", None, None), (2, 5, at(11), "approve", None, None), (6, 6, at(12), "approve", None, None),
    (6, 7, at(12), "reject", None, None), (99, 8, at(12), "approve", None, None),
]
_TICKET = "id long, created_at timestamp, classification struct<priority: string>"


@pytest.mark.parametrize("size", [3, 100])
@pytest.mark.parametrize("tickets_first", [True, False])
def test_live_counters(spark, tmp_path, size, tickets_first):
    """Whatever comes first: each closing takes the ticket from pending, once, and unknown tickets count nothing."""
    left, right, base = str(tmp_path / "t"), str(tmp_path / "a"), str(tmp_path / "out")
    again = [*SUBMITTED, SUBMITTED[0], SUBMITTED[4]]
    for path, schema in ((left, _TICKET), (right, schemas.ACTIONS)):
        spark.createDataFrame([], schema).write.parquet(path)
    tickets = spark.readStream.schema(_TICKET).option("maxFilesPerTrigger", 1).parquet(left)
    actions = spark.readStream.schema(schemas.ACTIONS).option("maxFilesPerTrigger", 1).parquet(right)

    def run():
        counters.start_counters(tickets, actions, f"{base}/t", f"{base}/c", late="1 hour").awaitTermination()
        return tuple(counters.read_counters(spark, f"{base}/t").first())

    steps = [lambda: write_batches(spark, again, _TICKET, left, size), lambda: write_batches(spark, CLOSING, schemas.ACTIONS, right, size)]
    seen = []
    for step in steps if tickets_first else steps[::-1]:
        step()
        seen.append(run())
    assert seen == [(7, 0, 7, 2) if tickets_first else (0, 0, 0, 0), (7, 2, 4, 2)]
    assert len(folders.numbers(spark, f"{base}/t")) <= 2


def test_live_counters_forget_closed_tickets(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    schema = f"{_TICKET}, action string, ticket_id long, action_id long, ts timestamp"
    day = 24 * 60
    data = [(k, at(k * day), {"priority": "low"}, "approve", k, k, at(k * day + 1)) for k in range(12)]
    write_batches(spark, data, schema, source, 1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = counters.start_counters(stream, stream, f"{base}/t", f"{base}/c", late="1 day", retention="2 days")
    query.awaitTermination()
    assert tuple(counters.read_counters(spark, f"{base}/t").first()) == (12, 12, 0, 0)
    # a state and a timer for each ticket of the last days, not of all twelve
    assert max(progress_rows(query)) <= 2 * 7
    assert review.milliseconds(spark, "90 minutes") == 90 * 60 * 1000


def test_days_close_once_and_late_rows_are_counted_apart(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    day = 24 * 60
    arriving = [at(0), at(10), at(day), at(3 * day), at(20), at(day + 5), at(3 * day + 7), None, at(9 * day), at(2 * day)]
    data = [(i, "a", "bug", ts) for i, ts in enumerate(arriving)]
    write_batches(spark, data, schemas.SUBMISSIONS, source, 1)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).option("maxFilesPerTrigger", 1).parquet(source)
    query = streams.start_daily_dashboard(wf.intake(stream), f"{base}/t", f"{base}/c", late="1 day")
    query.awaitTermination()

    def counts(part):
        found = streams.read_days(spark, f"{base}/t", part).filter("dimension = 'type'")
        return {r.day and r.day.day - at(0).day: r.n for r in found.collect()}

    # at day 3 the days 0 and 1 are closed: two late rows; at day 9 day 3 closes with both its rows
    assert counts("closed") == {0: 2, 1: 1, 3: 2}
    assert counts("late") == {0: 1, 1: 1, 2: 1, None: 1}
    closings = [len(spark.read.parquet(f"{base}/t/closed/batch={n}").collect()) for n in folders.numbers(spark, f"{base}/t/closed")]
    assert sum(closings) == 2 * 3 and len(folders.numbers(spark, f"{base}/t/open")) <= 2
    # a batch that is run again after a failure changes nothing
    before = rows(streams.read_days(spark, f"{base}/t"))
    write_batches(spark, [(99, "b", "bug", at(12 * day))], schemas.SUBMISSIONS, source, 1)
    streams.start_daily_dashboard(wf.intake(stream), f"{base}/t", f"{base}/c", late="1 day").awaitTermination()
    after = rows(streams.read_days(spark, f"{base}/t"))
    assert set(before) < set(after) and counts("closed") == {0: 2, 1: 1, 3: 2, 9: 1}


def test_content_keys(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(1, "a", "bc", at(0)), (2, "ab", "c", at(0)), (3, "a", "bc", at(0)), (4, "a", "bc", at(1)), (5, "1:a", "b", at(1))]
    keyed = streams.with_ticket_key(spark.createDataFrame([*data, (6, None, "", None), (7, "", None, None)], schemas.SUBMISSIONS))
    keys = {r.key: r.ticket_key for r in keyed.collect()}
    assert keys[1] == keys[3] and len(set(keys.values())) == 6 and None not in keys.values()
    write_batches(spark, data, schemas.SUBMISSIONS, source, 1)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).option("maxFilesPerTrigger", 1).parquet(source)
    streams.start_unique_intake(stream, f"{base}/t", f"{base}/c", late="1 hour").awaitTermination()
    found = spark.read.parquet(f"{base}/t")
    assert sorted(r.key for r in found.collect()) == [1, 2, 4, 5]
    # a repeat after a restart is known from the state
    write_batches(spark, [(8, "ab", "c", at(0)), (9, "new", "x", at(2))], schemas.SUBMISSIONS, source, 2)
    streams.start_unique_intake(stream, f"{base}/t", f"{base}/c", late="1 hour").awaitTermination()
    assert sorted(r.key for r in spark.read.parquet(f"{base}/t").collect()) == [1, 2, 4, 5, 9]
