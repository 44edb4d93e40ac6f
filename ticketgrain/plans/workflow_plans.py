"""Queries over the ticket workflow, models and connectors."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ticketgrain import schemas
from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx
from ticketgrain.operators import classification as cl
from ticketgrain.operators import experiments, features, generation, models, sampling
from ticketgrain.operators import workflow as wf
from ticketgrain.operators.scaling import stage
from ticketgrain.plans import mappings as m
from ticketgrain.plans.registry import query, rounded, sql_prompt, sql_text, table
from ticketgrain.session import scratch_path
from ticketgrain.sources import readers, writers
from ticketgrain.sources.positions import with_positions
from ticketgrain.streaming import counters, review
from ticketgrain.streaming import intake as streams

_INTAKE = f"({m.INTAKE_SQL})"
_REPLY = "CASE priority " + " ".join(
    f"WHEN '{p}' THEN {sql_text(t)}" for p, t in V.REPLY_TEMPLATES.items()
) + " END"


def _tickets(spark, sf):
    return wf.intake(m.submissions(spark, sf), **m.event_rules())


def _flat(tickets, *extra):
    return tickets.select(
        *extra, "key", "subject", "body",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        "classification.type", "classification.queue", "classification.priority", "classification.confidence",
        "suggested_response", "status",
    )


_FLAT_SQL = f"""key, subject, body, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, type, queue, priority,
0.85::DOUBLE AS confidence, replace({_REPLY}, '{{subject}}', substr(subject, 1, 50)) AS suggested_response,
'pending_review' AS status"""


@query("ticket_intake", f"SELECT {_FLAT_SQL} FROM {_INTAKE}")
def ticket_intake(spark, sf):
    return _flat(_tickets(spark, sf))


@query("ticket_ids", "SELECT event_id AS key, row_number() OVER (ORDER BY ts, event_id) AS id FROM events")
def ticket_ids(spark, sf):
    numbered = wf.number_tickets(_tickets(spark, sf).select("key", "created_at"))
    return numbered.select("key", "id")


@query(
    "ticket_history",
    f"""SELECT {_FLAT_SQL} FROM {_INTAKE} WHERE priority = 'high' AND (contains(lower(subject), 'err')
    OR contains(lower(body), 'err'))""",
)
def ticket_history(spark, sf):
    return _flat(wf.history(_tickets(spark, sf), V.STATUS_PENDING, "high", "ERR"))


@query(
    "ticket_dashboard",
    f"""SELECT 'priority' AS dimension, priority AS value, count(*) AS n FROM {_INTAKE} GROUP BY priority
    UNION ALL SELECT 'type', type, count(*) FROM {_INTAKE} GROUP BY type""",
)
def ticket_dashboard(spark, sf):
    return wf.dashboard_distributions(_tickets(spark, sf))


# Fixed texts that hold words of the default rules, with the labels a reader expects.
_DEFAULT_CASES = (
    ("URGENT: payment failed with an error", "Incident", "Billing and Payments", "high"),
    ("Question about the product manual", "Request", "Product Support", "low"),
    ("Please upgrade my account", "Change", "Customer Service", "medium"),
    ("The server is down", "Request", "Technical Support", "high"),
    ("Slow performance, please investigate", "Problem", "Technical Support", "medium"),
    ("Information on an invoice", "Request", "Billing and Payments", "low"),
    ("Where to download the new feature", "Change", "Product Support", "high"),
    ("Reset of my password", "Request", "Customer Service", "medium"),
)


@query(
    "default_routing",
    "WITH cases(k, subject, type, queue, priority) AS (VALUES "
    + ", ".join(f"({k}, {', '.join(map(sql_text, case))})" for k, case in enumerate(_DEFAULT_CASES))
    + ") SELECT event_id AS key, subject, type, queue, priority FROM events JOIN cases ON event_id % 8 = k",
)
def default_routing(spark, sf):
    """The default rules on one fixed subject for each event."""
    subjects = F.array(*[F.lit(subject) for subject, *_ in _DEFAULT_CASES])
    raised = table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        F.get(subjects, F.pmod("event_id", F.lit(8)).cast("int")).alias("subject"),
        F.concat(F.lit("ticket "), F.col("event_id").cast("string")).alias("body"),
    )
    routed = wf.intake(raised)
    return routed.select("key", "subject", "classification.type", "classification.queue", "classification.priority")


# --- review state -------------------------------------------------------------
_STATE_SQL = f"""
WITH actions AS ({m.ACTIONS_SQL}), tickets AS ({m.REVIEW_TICKETS_SQL}),
closing AS (SELECT * FROM actions WHERE action <> 'modify' QUALIFY row_number() OVER (PARTITION BY ticket_id
            ORDER BY ts, action_id) = 1),
edits AS (SELECT a.ticket_id, a.text FROM actions a LEFT JOIN closing c USING (ticket_id)
          WHERE a.action = 'modify' AND (c.ts IS NULL OR a.ts < c.ts OR (a.ts = c.ts AND a.action_id < c.action_id))
          QUALIFY row_number() OVER (PARTITION BY a.ticket_id ORDER BY a.ts DESC, a.action_id DESC) = 1),
state AS (SELECT t.id, coalesce(e.text, t.suggested_response) AS suggested_response,
  CASE c.action WHEN 'approve' THEN 'approved' WHEN 'reject' THEN 'rejected' ELSE 'pending_review' END AS status,
  CASE WHEN c.action = 'approve' THEN coalesce(c.text, e.text, t.suggested_response) END AS final_response,
  CASE WHEN c.action = 'approve' THEN coalesce(c.reviewer, 'Admin') END AS reviewed_by, t.created_at
  FROM tickets t LEFT JOIN closing c ON c.ticket_id = t.id LEFT JOIN edits e ON e.ticket_id = t.id)
"""


def _state(spark, sf):
    return wf.review_state(m.review_tickets(spark, sf), m.actions(spark, sf))


@query("ticket_state", _STATE_SQL + "SELECT id, suggested_response, status, final_response, reviewed_by FROM state")
def ticket_state(spark, sf):
    return _state(spark, sf).select("id", "suggested_response", "status", "final_response", "reviewed_by")


@query("pending_tickets", _STATE_SQL + "SELECT id, suggested_response FROM tickets WHERE id NOT IN (SELECT ticket_id FROM closing)")
def pending_tickets(spark, sf):
    return wf.pending_tickets(m.review_tickets(spark, sf), m.actions(spark, sf)).select("id", "suggested_response")


@query(
    "review_counters",
    _STATE_SQL
    + """SELECT count(*) AS total, count(*) FILTER (status = 'approved') AS approved,
    count(*) FILTER (status = 'pending_review') AS pending, count(*) FILTER (id % 3 = 0) AS high_priority FROM state""",
)
def review_counters(spark, sf):
    priority = F.when(F.col("id") % 3 == 0, "high").otherwise("low")
    classified = _state(spark, sf).withColumn("classification", F.struct(priority.alias("priority")))
    return wf.dashboard_counters(classified)


# --- streams ------------------------------------------------------------------
def _raw_event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _event_stream(spark, sf):
    return m.submissions_of(_raw_event_stream(spark, sf))


@query("streamed_intake", f"SELECT {_FLAT_SQL} FROM {_INTAKE}")
def streamed_intake(spark, sf):
    """The intake as a stream into a parquet table; equals the batch query."""
    base = scratch_path(spark, "intake")
    streams.start_intake(
        _event_stream(spark, sf), f"{base}/tickets", f"{base}/checkpoint", **m.event_rules()
    ).awaitTermination()
    return _flat(spark.read.parquet(f"{base}/tickets"))


@query(
    "live_dashboard",
    f"""SELECT 'priority' AS dimension, priority AS value, count(*) AS n FROM {_INTAKE} GROUP BY priority
    UNION ALL SELECT 'type', type, count(*) FROM {_INTAKE} GROUP BY type""",
)
def live_dashboard(spark, sf):
    base = scratch_path(spark, "dashboard")
    tickets = wf.intake(_event_stream(spark, sf), **m.event_rules())
    streams.start_dashboard(tickets, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return streams.read_dashboard(spark, f"{base}/table")


@contextmanager
def _rocksdb(spark):
    """The state store that ``transformWithState`` needs, for the time of one stream."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _event_batches(spark, sf):
    """The events as a stream of several micro-batches in order of time: a third of the days after another.

    Within a third a user's events are in one file, so that the order of files changes no state.
    """
    events = table(spark, sf, "events")
    path = scratch_path(spark, "event-batches")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    for part in range(3):
        third = F.floor(F.datediff("ts", F.lit(low)) * 3 / (F.datediff(F.lit(high), F.lit(low)) + 1))
        events.filter(third == part).repartition(2, "user_id").write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


# Longer than a third of the days, so that no file of a third is late.
_LATE = "15 days"


@query(
    "daily_dashboard",
    f"""SELECT strftime(created_at::DATE, '%Y-%m-%d') AS day, dimension, value, count(*) AS n FROM
    (SELECT created_at, 'priority' AS dimension, priority AS value FROM {_INTAKE}
     UNION ALL SELECT created_at, 'type', type FROM {_INTAKE}) GROUP BY ALL""",
)
def daily_dashboard(spark, sf):
    """Every day: those closed when the stream ends, those still open, and what came late."""
    base = scratch_path(spark, "daily")
    tickets = wf.intake(_event_stream(spark, sf), **m.event_rules())
    streams.start_daily_dashboard(tickets, f"{base}/table", f"{base}/checkpoint", late="1 day").awaitTermination()
    days = streams.read_all_days(spark, f"{base}/table")
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "dimension", "value", "n")


@query(
    "late_tickets",
    f"""WITH t AS MATERIALIZED (SELECT * FROM {_INTAKE}), d AS (
      SELECT *, floor((created_at::DATE - min(created_at::DATE) OVER ()) * 3 / (max(created_at::DATE) OVER ()
        - min(created_at::DATE) OVER () + 1)) AS part FROM t),
    x AS (SELECT *, key % 5 = 0 AND part = 0 AS held_back FROM d),
    until AS (SELECT max(created_at) - INTERVAL 1 DAY AS until FROM x WHERE NOT held_back)
    SELECT strftime(created_at::DATE, '%Y-%m-%d') AS day, dimension, value, count(*) AS n FROM (
      SELECT created_at, 'priority' AS dimension, priority AS value FROM x WHERE held_back
      UNION ALL SELECT created_at, 'type', type FROM x WHERE held_back), until
    WHERE created_at::DATE + INTERVAL 1 DAY <= until GROUP BY ALL""",
)
def late_tickets(spark, sf):
    """Every fifth ticket of the first third of the days comes after all others: their days are closed."""
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    third = F.floor(F.datediff("ts", F.lit(low)) * 3 / (F.datediff(F.lit(high), F.lit(low)) + 1))
    held_back = (F.col("event_id") % 5 == 0) & (third == 0)
    base = scratch_path(spark, "late")
    for part in (~held_back, held_back):
        events.filter(part).coalesce(1).write.mode("append").parquet(f"{base}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/events")
    tickets = wf.intake(m.submissions_of(stream), **m.event_rules())
    streams.start_daily_dashboard(tickets, f"{base}/table", f"{base}/checkpoint", late="1 day").awaitTermination()
    late = streams.read_days(spark, f"{base}/table", "late")
    return late.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "dimension", "value", "n")


@query(
    "streamed_ticket_keys",
    f"""SELECT sha256(length(subject) || ':' || subject || length(body) || ':' || body || length(epoch_us(created_at)::VARCHAR)
      || ':' || epoch_us(created_at)) AS ticket_key, subject, body, priority, min(key) % 1 AS repeats_left
    FROM {_INTAKE} GROUP BY subject, body, priority, created_at""",
)
def streamed_ticket_keys(spark, sf):
    """Every third ticket arrives twice, every sixth three times; each has one row under its content key."""
    base = scratch_path(spark, "ticket-keys")
    arriving = _event_stream(spark, sf)
    again = arriving.unionByName(arriving.filter("key % 3 = 0")).unionByName(arriving.filter("key % 6 = 0"))
    streams.start_unique_intake(again, f"{base}/tickets", f"{base}/checkpoint", **m.event_rules()).awaitTermination()
    tickets = spark.read.parquet(f"{base}/tickets")
    first = tickets.groupBy("ticket_key").agg(F.count(F.lit(1)).alias("copies"))
    joined = tickets.join(first, "ticket_key")
    return joined.select("ticket_key", "subject", "body", "classification.priority", (F.col("copies") - 1).alias("repeats_left"))


@query("streamed_review", _STATE_SQL + "SELECT id, suggested_response, status, final_response, reviewed_by FROM state")
def streamed_review(spark, sf):
    """The review state from a stream of several batches, states removed after a time; equals the batch query."""
    base = scratch_path(spark, "review-state")
    actions = m.actions_of(_event_batches(spark, sf))
    with _rocksdb(spark):
        review.start_review(
            actions, f"{base}/table", f"{base}/checkpoint", late=_LATE, retention="2 days", compact_every=2
        ).awaitTermination()
    states = review.read_reviews(spark, f"{base}/table").withColumnRenamed("ticket_id", "id")
    tickets = m.review_tickets(spark, sf).select("id", "suggested_response").join(states, "id", "left")
    approved = F.col("status") == V.STATUS_APPROVED
    suggestion = F.coalesce("edited_response", "suggested_response")
    return tickets.select(
        "id",
        suggestion.alias("suggested_response"),
        F.coalesce("status", F.lit(V.STATUS_PENDING)).alias("status"),
        F.when(approved, F.coalesce("final_text", suggestion)).alias("final_response"),
        F.when(approved, F.coalesce("reviewer", F.lit(V.DEFAULT_REVIEWER))).alias("reviewed_by"),
    )


@query(
    "live_counters",
    _STATE_SQL
    + """SELECT count(*) AS total, count(*) FILTER (status = 'approved') AS approved,
    count(*) FILTER (status = 'pending_review') AS pending, count(*) FILTER (id % 3 = 0) AS high_priority FROM state""",
)
def live_counters(spark, sf):
    """The counters from streams of tickets and actions over several batches; equals ``review_counters``."""
    base = scratch_path(spark, "counters")
    events = _event_batches(spark, sf)
    ticket = F.col("user_id") * 1000 + F.dayofyear("ts")
    priority = F.when(ticket % 3 == 0, "high").otherwise("low")
    tickets = events.select(
        ticket.alias("id"), F.col("ts").cast("timestamp").alias("created_at"), F.struct(priority.alias("priority")).alias("classification")
    )
    with _rocksdb(spark):
        counters.start_counters(
            tickets, m.actions_of(events), f"{base}/table", f"{base}/checkpoint", late=_LATE, retention="20 days"
        ).awaitTermination()
    return counters.read_counters(spark, f"{base}/table")


# --- connectors ---------------------------------------------------------------
@query("csv_roundtrip", "SELECT doc_id, text, lang, source FROM documents")
def csv_roundtrip(spark, sf):
    """Documents with newlines, quotes and blanks through CSV files."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "csv")
    writers.write_csv(docs, path, "overwrite")
    return readers.read_csv(spark, path, docs.schema)


@query("csv_splits", "SELECT doc_id, text, CASE WHEN lang = 'en' THEN 'train' WHEN lang = 'de' THEN 'val' ELSE 'test' END AS split FROM documents")
def csv_splits(spark, sf):
    """Splits kept as tickets_<split>.csv, each loaded again."""
    lang = F.col("lang")
    split = F.when(lang == "en", "train").when(lang == "de", "val").otherwise("test")
    docs = table(spark, sf, "documents").select("doc_id", "text", split.alias("split"))
    base = scratch_path(spark, "csv-splits")
    found = []
    for name in ("train", "val", "test"):
        part = docs.filter(F.col("split") == name).drop("split")
        writers.write_csv(part, f"{base}/tickets_{name}.csv")
        found.append(readers.load_split(spark, base, name, part.schema).withColumn("split", F.lit(name)))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "json")
    writers.write_samples(turns, path, "overwrite")
    return readers.read_json_records(spark, path, turns.schema)


_TURNS_SQL = """SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS sample_id, conv_id, turn, role, text
FROM conversations"""


@query("json_array_roundtrip", _TURNS_SQL)
def json_array_roundtrip(spark, sf):
    """Turns in several files of one JSON array each, read back with their places."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "json-arrays")
    writers.write_json_arrays(turns.repartitionByRange(5, "conv_id", "turn").sortWithinPartitions("conv_id", "turn"), path)
    return readers.read_json_array(spark, path, turns.schema)


@query(
    "positional_pairs",
    f"""SELECT p.sample_id, p.text AS prediction, r.role AS reference FROM ({_TURNS_SQL}) p
    JOIN (SELECT row_number() OVER (ORDER BY conv_id DESC, turn) - 1 AS sample_id, role FROM conversations WHERE role <> 'system'
          AND turn > 0) r USING (sample_id)""",
)
def positional_pairs(spark, sf):
    """Two outputs without keys, of unequal length and dealt over unequal files, joined place by place."""
    turns = table(spark, sf, "conversations")
    base = scratch_path(spark, "positions")
    predictions = turns.repartitionByRange(6, "conv_id", "turn").sortWithinPartitions("conv_id", "turn").select("text")
    order = (F.desc("conv_id"), F.asc("turn"))
    later = turns.filter("role <> 'system' AND turn > 0").repartitionByRange(4, *order).sortWithinPartitions(*order)
    writers.write_samples(predictions, f"{base}/predictions")
    writers.write_samples(later.select("role"), f"{base}/references")
    places = [
        with_positions(readers.read_json_records(spark, f"{base}/{name}", side.schema), "sample_id").withColumnRenamed(column, new)
        for name, side, column, new in (
            ("predictions", turns.select("text"), "text", "prediction"),
            ("references", turns.select("role"), "role", "reference"),
        )
    ]
    return generation.pair_by_position(*places)


@query(
    "split_roundtrip",
    """SELECT doc_id, source FROM documents WHERE substr(md5(doc_id || '-42'), 1, 8) < '0ccccccc'""",
)
def split_roundtrip(spark, sf):
    """Write hash parts as partitions and load the validation part alone."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    base = scratch_path(spark, "splits")
    writers.write_splits(sampling.holdout(docs, "doc_id").withColumnRenamed("part", "split"), base, "overwrite")
    return readers.load_split(spark, base, "val").select("doc_id", "source")


@query(
    "results_glob",
    """SELECT lang AS model, round(avg(n_chars), 6) AS avg_pred_length, count(*)::DOUBLE / 1000 AS avg_bleu
    FROM documents GROUP BY lang""",
)
def results_glob(spark, sf):
    """A result file per language, found again by its folder name."""
    base = scratch_path(spark, "results")
    per_lang = table(spark, sf, "documents").groupBy("lang").agg(
        F.avg("n_chars").alias("avg_pred_length"),
        (F.count(F.lit(1)) / 1000.0).cast("double").alias("avg_bleu"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    record = writers.evaluation_record(per_lang).schema  # column order of the files
    nested = per_lang.select(
        F.col("lang").alias("model"),
        F.struct(*record["aggregated"].dataType.names).alias("aggregated"),
        "sample_count",
    )
    writers.write_results(nested, base)
    found = readers.load_evaluations(spark, base)
    return rounded(found.select("model", "avg_pred_length", "avg_bleu"))


@query(
    "predictions_roundtrip",
    """SELECT conv_id, turn, text AS input, text AS output, role AS reference
    FROM conversations""",
)
def predictions_roundtrip(spark, sf):
    scored = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("input"),
        F.col("text").alias("output"),
        F.col("role").alias("reference"),
    )
    path = scratch_path(spark, "predictions")
    writers.write_predictions(scored, path, "overwrite")
    return readers.read_json_records(spark, path, scored.schema)


@query(
    "evaluation_file",
    """SELECT round(avg(length(text)), 6) AS avg_pred_length, round(avg(turn), 6) AS avg_ref_length
    FROM conversations""",
)
def evaluation_file(spark, sf):
    """The aggregate as a result file, unwrapped again."""
    total = table(spark, sf, "conversations").agg(
        F.avg(F.length("text")).alias("avg_pred_length"),
        F.avg("turn").alias("avg_ref_length"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    path = scratch_path(spark, "evaluation")
    writers.write_evaluation(total, path)
    return rounded(readers.load_results(spark, path).select("avg_pred_length", "avg_ref_length"))


@query(
    "experiment_files",
    f"""SELECT exp, epoch, round(train_loss, 9) AS train_loss, round(train_acc, 9) AS train_acc,
    round(val_acc, 9) AS val_acc, round(val_f1_macro, 9) AS val_f1_macro
    FROM (SELECT 'run-' || exp AS exp, epoch::INT AS epoch, train_loss, train_acc, val_acc, val_f1_macro
          FROM ({m.EPOCHS_SQL}))""",
)
def experiment_files(spark, sf):
    """Nested run records and the flat summary through files, epochs exploded again."""
    epochs = m.epochs(spark, sf)
    missing = F.lit(None).cast("double")
    entry = F.struct(
        F.col("epoch").cast("int").alias("epoch"), "train_loss", "train_acc", missing.alias("train_f1_macro"),
        "val_acc", "val_f1_macro", missing.alias("val_f1_weighted"),
    )
    # a run has as many entries as epochs
    nested = epochs.groupBy("exp").agg(F.collect_list(entry).alias("epochs"))
    config = F.struct(F.concat(F.lit("run-"), F.col("exp").cast("string")).alias("name"))
    base = scratch_path(spark, "experiments")
    summary = experiments.best_and_last(epochs)
    writers.write_experiments(nested.select(config.alias("config"), "epochs"), summary, base)
    back = readers.read_json_records(spark, f"{base}/experiments", schemas.EXPERIMENTS)
    columns = ["exp", "epoch", "train_loss", "train_acc", "val_acc", "val_f1_macro"]
    return rounded(experiments.explode_epochs(back).select(*columns), 9)


@query(
    "experiment_summary_csv",
    f"""SELECT exp, greatest(max(val_f1_macro), 0) AS best_val_f1, count(*) AS epochs,
    max_by(val_acc, epoch) AS final_val_acc, max_by(train_acc, epoch) AS final_train_acc FROM ({m.EPOCHS_SQL}) GROUP BY exp""",
)
def experiment_summary_csv(spark, sf):
    """The flat summary beside the run records, read back from its CSV files."""
    epochs = m.epochs(spark, sf)
    summary = experiments.best_and_last(epochs).drop("last_epoch", "final_train_loss")
    runs = summary.select(F.struct(F.col("exp").cast("string").alias("name")).alias("config"))
    base = scratch_path(spark, "experiments")
    writers.write_experiments(runs, summary, base)
    return readers.read_csv(spark, f"{base}/summary", summary.schema)


@query(
    "review_sheet",
    """SELECT row_number() OVER (ORDER BY doc_id) AS id, substr(text, 1, 500) AS input FROM
    (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100)""",
)
def review_sheet(spark, sf):
    """The review template through its CSV file; the first n rows are its purpose."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("input"))
    sheet = sampling.review_template(docs, "doc_id", 100, columns=("input",))
    path = scratch_path(spark, "review")
    writers.write_review(sheet, path)
    return readers.read_csv(spark, path, sheet.schema).select("id", "input")


@query(
    "manifest_upsert",
    """SELECT c_name AS name, 'customer-' || c_custkey AS file_name, 'old' AS formatting FROM customer
    WHERE c_custkey % 5 <> 0
    UNION ALL SELECT c_name, 'segment-' || c_mktsegment, 'alpaca' FROM customer WHERE c_custkey % 5 = 0""",
)
def manifest_upsert(spark, sf):
    """Entries of a manifest, a fifth of them renewed: new ones win, the others stay."""
    customer = table(spark, sf, "customer")
    name = F.col("c_name").alias("name")
    old = customer.select(
        name,
        F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("file_name"),
        F.lit("old").alias("formatting"),
    )
    new = customer.filter(F.col("c_custkey") % 5 == 0).select(
        name,
        F.concat(F.lit("segment-"), F.col("c_mktsegment")).alias("file_name"),
        F.lit(V.MANIFEST_FORMAT).alias("formatting"),
    )
    return writers.merge_manifest(old, new)


# --- models -------------------------------------------------------------------
def _lr_splits(spark, sf):
    """Cleaned documents with class ids of the training split, as (train, test)."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", tx.basic_clean(F.col("text")).alias("text")
    )
    split = stage(sampling.stratified_split(docs, "doc_id", "lang"))
    index = features.label_index(split.filter("split = 'train'"), "lang")
    # numeric class ids, as the estimator wants them
    data = features.encode_labels(split, "lang", index).withColumn("label", F.col("label_id").cast("double"))
    return data.filter("split = 'train'"), data.filter("split = 'test'")


@query("lr_lang")
def lr_lang(spark, sf):
    """Predict the language of held-out documents: terms, idf and regression are fitted on the training split."""
    train, test = _lr_splits(spark, sf)
    tfidf = features.fit_tfidf(train, **V.TFIDF_PLAIN).to_pipeline()
    # written once, then read by every pass of the fit
    classifier = models.fit_logistic_regression(stage(tfidf.transform(train).select("label", "features")))
    predicted = models.predict(classifier, tfidf.transform(test))
    cells = cl.confusion_counts(predicted, "label", "predicted")
    return rounded(cl.summary_metrics(cells), 4)


@query("lr_saved_model")
def lr_saved_model(spark, sf):
    """Fit and save the whole pipeline (full preset), load it, count predictions per class of the held-out documents."""
    train, test = _lr_splits(spark, sf)

    def fit():
        steps = features.fit_tfidf(train, **V.TFIDF_FULL).to_pipeline()
        vectors = stage(steps.transform(train).select("label", "features"))
        return PipelineModel([*steps.stages, models.fit_logistic_regression(vectors, balanced=True)])

    key = models.training_key(train.select("label", "text"), preset="full", balanced=True)
    model = models.fit_or_load(spark, scratch_path(spark, "lr-model"), fit, key)
    predicted = models.predict(model, test.select("label", "text"))
    return cl.confusion_counts(predicted, "label", "predicted")


@query(
    "lr_group_shares",
    """SELECT source, lang, round(n::DOUBLE / sum(n) OVER (PARTITION BY source), 4) AS share
    FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)""",
)
def lr_group_shares(spark, sf):
    """With one feature for each group and next to no regularisation the fitted probabilities are the groups' shares."""
    docs = table(spark, sf, "documents").select("source", "lang")
    index = stage(features.label_index(docs, "lang"))
    data = features.encode_labels(docs, "lang", index).withColumn("label", F.col("label_id").cast("double"))
    one_hot = CountVectorizer(inputCol="_groups", outputCol="features", binary=True)
    data = data.withColumn("_groups", F.array("source"))
    vectors = one_hot.fit(data).transform(data)
    classifier = models.fit_logistic_regression(stage(vectors.select("label", "features")), c=1e9, tol=1e-9)
    groups = vectors.dropDuplicates(["source"]).select("source", "features")
    shares = classifier.transform(groups).select("source", F.posexplode(vector_to_array("probability")).alias("id", "share"))
    present = docs.distinct()
    named = shares.join(index.select("id", F.col("label").alias("lang")), "id").join(present, ["source", "lang"])
    return rounded(named.select("source", "lang", "share"), 4)


@query(
    "lr_group_classes",
    """WITH n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)
    SELECT source, sum(n)::BIGINT AS documents, max(n) AS predicted_documents FROM n GROUP BY source""",
)
def lr_group_classes(spark, sf):
    """A saved regression on one feature for each group, loaded again: each group's class is its most frequent one."""
    docs = table(spark, sf, "documents").select("source", "lang")
    index = stage(features.label_index(docs, "lang"))
    data = features.encode_labels(docs, "lang", index).withColumn("label", F.col("label_id").cast("double"))
    data = data.withColumn("_groups", F.array("source"))

    def fit():
        one_hot = CountVectorizer(inputCol="_groups", outputCol="features", binary=True).fit(data)
        vectors = stage(one_hot.transform(data).select("label", "features"))
        return PipelineModel([one_hot, models.fit_logistic_regression(vectors, c=1e9, tol=1e-9)])

    def refuse():
        raise RuntimeError("the saved model was not found")

    base, key = scratch_path(spark, "lr-groups"), models.training_key(data, c=1e9, tol=1e-9)
    models.fit_or_load(spark, base, fit, key)
    loaded = models.fit_or_load(spark, base, refuse, key)
    cells = cl.confusion_counts(models.predict(loaded, data).withColumn("cell", F.struct("source", "label")), "cell", "predicted")
    right = F.when(F.col("truth.label") == F.col("prediction"), F.col("n")).otherwise(0)
    found = cells.groupBy(F.col("truth.source").alias("source"))
    return found.agg(F.sum("n").alias("documents"), F.sum(right).cast("long").alias("predicted_documents"))


def _digest_predictor():
    """Stands in for a language model: answers with the digest of the whole prompt."""

    def predict(prompts):
        return prompts.map(lambda p: hashlib.sha256(p.encode()).hexdigest())

    return predict


_PROMPT_SQL = f"""SELECT doc_id, {sql_text(V.RESPONSE_INSTRUCTION)} AS instruction, text AS input, source AS reference
FROM documents"""


@query(
    "scored_prompts",
    f"""SELECT doc_id, instruction, input, sha256({sql_prompt(V.CHAT_LAYOUT)}) AS output, reference
    FROM ({_PROMPT_SQL})""",
)
def scored_prompts(spark, sf):
    """Batch scoring of all documents with a caller-supplied predictor."""
    samples = table(spark, sf, "documents").select(
        "doc_id",
        F.lit(V.RESPONSE_INSTRUCTION).alias("instruction"),
        F.col("text").alias("input"),
        F.col("source").alias("output"),
    )
    return models.score_prompts(samples, _digest_predictor, keep=("doc_id",))
