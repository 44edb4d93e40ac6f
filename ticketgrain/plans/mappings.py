"""Views of the driver tables as the tables of the ticket problem.

* documents  -> tickets (subject = first line, body = the rest, queue = source,
                language = lang, tags from the words of the source table keys)
* labels     -> class labels of documents
* conversations -> prediction/reference pairs (a user turn and the next turn)
* orders     -> classifier output (truth = priority, prediction = status)
* lineitem   -> step logs of training runs, and evaluated models
* events     -> submitted tickets and review actions
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain.functions import text as tx
from ticketgrain.operators.generation import pair_by_key
from ticketgrain.operators.scaling import by_key
from ticketgrain.plans.registry import table

# --- documents as tickets -----------------------------------------------------
TICKETS_SQL = """
SELECT doc_id,
       split_part(text, chr(10), 1) AS subject,
       CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body,
       source AS queue, lang AS language, text
FROM documents
"""


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        tx.first_line(F.col("text")).alias("subject"),
        tx.after_first_line(F.col("text")).alias("body"),
        F.col("source").alias("queue"),
        F.col("lang").alias("language"),
        "text",
    )


# Labels are partly missing, which exercises the null rules.
LABELLED_SQL = f"""
SELECT t.*, CASE l.quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' END AS priority,
       CASE l.toxic WHEN 1 THEN 'Incident' WHEN 0 THEN 'Request' END AS type
FROM ({TICKETS_SQL}) t LEFT JOIN labels l USING (doc_id)
"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("priority"),
        F.when(F.col("toxic") == 1, "Incident").when(F.col("toxic") == 0, "Request").alias("type"),
    )
    return tickets(spark, sf).join(labels, "doc_id", "left")


# --- conversations as prediction/reference pairs ------------------------------
PAIRS_SQL = """
SELECT u.conv_id, u.turn, u.text AS prediction, a.text AS reference
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""
PAIR_KEYS = ["conv_id", "turn"]


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    predictions = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prediction")
    )
    references = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference")
    )
    return pair_by_key(predictions, references, PAIR_KEYS)


# --- orders as classifier output ----------------------------------------------
CLASSIFIED_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
            WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'medium' END AS truth,
       CASE o_orderstatus WHEN 'F' THEN 'high' WHEN 'O' THEN 'medium' ELSE 'low' END AS prediction
FROM orders
"""


def classified(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(priority.isin("1-URGENT", "2-HIGH"), "high")
        .when(priority == "5-LOW", "low")
        .otherwise("medium")
        .alias("truth"),
        F.when(F.col("o_orderstatus") == "F", "high")
        .when(F.col("o_orderstatus") == "O", "medium")
        .otherwise("low")
        .alias("prediction"),
    )


# --- lineitem as step logs ----------------------------------------------------
# Ratios of whole numbers, so both engines see the same value bit by bit.
STEPS_SQL = """
SELECT l_orderkey AS exp, l_linenumber::BIGINT AS epoch, l_discount AS loss,
       l_quantity::BIGINT AS correct, 50::BIGINT AS total
FROM lineitem
"""
EPOCHS_SQL = """
SELECT l_orderkey AS exp, l_linenumber::BIGINT AS epoch, avg(l_discount) AS train_loss,
       sum(l_quantity::BIGINT)::DOUBLE / (50 * count(*)) AS train_acc,
       sum(round(l_tax * 100)::BIGINT)::DOUBLE / (8 * count(*)) AS val_acc,
       sum(l_partkey % 1000)::DOUBLE / (1000 * count(*)) AS val_f1_macro
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""
RUNS_SQL = """
SELECT o_orderkey AS exp, 'run-' || o_orderkey AS name,
       substr(o_orderpriority, 1, 1)::BIGINT * 1e-5 AS lr, o_orderstatus = 'F' AS frozen
FROM orders
"""
SUMMARY_SQL = f"""
SELECT b.*, r.name, r.lr, r.frozen FROM (
  SELECT exp, greatest(max(val_f1_macro), 0.0) AS best_val_f1, count(*) AS epochs,
         max(epoch) AS last_epoch, arg_max(val_acc, epoch) AS final_val_acc,
         arg_max(train_acc, epoch) AS final_train_acc, arg_max(train_loss, epoch) AS final_train_loss
  FROM ({EPOCHS_SQL}) GROUP BY exp) b JOIN ({RUNS_SQL}) r USING (exp)
"""


def steps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("exp"),
        F.col("l_linenumber").cast("long").alias("epoch"),
        F.col("l_discount").alias("loss"),
        F.col("l_quantity").cast("long").alias("correct"),
        F.lit(50).cast("long").alias("total"),
    )


def epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Placed by run, over more tasks the more steps there are: what joins or groups by run stays there."""
    n = F.count(F.lit(1))
    return (
        by_key(table(spark, sf, "lineitem"), "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("exp"), F.col("l_linenumber").cast("long").alias("epoch"))
        .agg(
            F.avg("l_discount").alias("train_loss"),
            (F.sum(F.col("l_quantity").cast("long")) / (50 * n)).alias("train_acc"),
            (F.sum(F.round(F.col("l_tax") * 100).cast("long")) / (8 * n)).alias("val_acc"),
            (F.sum(F.col("l_partkey") % 1000) / (1000 * n)).alias("val_f1_macro"),
        )
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("exp"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("name"),
        (F.substring("o_orderpriority", 1, 1).cast("long") * F.lit(1e-5)).alias("lr"),
        (F.col("o_orderstatus") == "F").alias("frozen"),
    )


# --- lineitem as evaluated models ---------------------------------------------
# One family per supplier; the line number picks the variant of the run name.
_VARIANTS = ("lora-rank16", "lora-rank32", "lora", "lora-rank128", "lora-lr1e4", "lora-epoch5", "lora-warmup03")
MODELS_SQL = f"""
SELECT 'm' || l_suppkey || '-' || CASE l_linenumber
         {" ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_VARIANTS, 1))} END AS model,
       l_suppkey AS family, l_linenumber::BIGINT AS position,
       sum(l_quantity::BIGINT)::DOUBLE / (50 * count(*)) AS avg_rouge1_f,
       sum(round(l_discount * 100)::BIGINT)::DOUBLE / (10 * count(*)) AS avg_rouge2_f,
       CASE WHEN l_suppkey % 10 > 0 THEN sum(l_partkey % 1000)::DOUBLE / (1000 * count(*)) END AS avg_rougeL_f,
       sum(l_orderkey % 1000)::DOUBLE / (1000 * count(*)) AS avg_bleu,
       sum(round(l_tax * 100)::BIGINT)::DOUBLE / (8 * count(*)) AS priority_accuracy,
       count(*) FILTER (l_linestatus = 'O')::DOUBLE / count(*) AS type_accuracy,
       count(*) FILTER (l_returnflag = 'A')::DOUBLE / count(*) AS queue_accuracy
FROM lineitem GROUP BY l_suppkey, l_linenumber
"""


def models(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count(F.lit(1))
    number = F.col("l_linenumber")
    variant = F.element_at(F.array(*[F.lit(v) for v in _VARIANTS]), number)
    rouge_l = F.sum(F.col("l_partkey") % 1000) / (1000 * n)
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_linenumber")
        .agg(
            (F.sum(F.col("l_quantity").cast("long")) / (50 * n)).alias("avg_rouge1_f"),
            (F.sum(F.round(F.col("l_discount") * 100).cast("long")) / (10 * n)).alias("avg_rouge2_f"),
            rouge_l.alias("_rouge_l"),
            (F.sum(F.col("l_orderkey") % 1000) / (1000 * n)).alias("avg_bleu"),
            (F.sum(F.round(F.col("l_tax") * 100).cast("long")) / (8 * n)).alias("priority_accuracy"),
            (F.count_if(F.col("l_linestatus") == "O") / n).alias("type_accuracy"),
            (F.count_if(F.col("l_returnflag") == "A") / n).alias("queue_accuracy"),
        )
        .select(
            F.concat(F.lit("m"), F.col("l_suppkey").cast("string"), F.lit("-"), variant).alias("model"),
            F.col("l_suppkey").alias("family"),
            number.cast("long").alias("position"),
            "avg_rouge1_f",
            "avg_rouge2_f",
            # every tenth family was evaluated without text metrics
            F.when(F.col("l_suppkey") % 10 > 0, F.col("_rouge_l")).alias("avg_rougeL_f"),
            "avg_bleu",
            "priority_accuracy",
            "type_accuracy",
            "queue_accuracy",
        )
    )


# --- events as submissions and actions ----------------------------------------
# The props text names nothing the default rules know, so the queries bring rules.
EVENT_PRIORITY_RULES = (("high", ("error", "purchase")), ("low", ("view",)))
EVENT_TYPE_RULES = (("Incident", ("error",)), ("Problem", ("click",)), ("Change", ("signup",)))
EVENT_QUEUE_RULES = (("Billing and Payments", ("purchase",)), ("Customer Service", ("signup", "view")))


def event_rules() -> dict:
    return {
        "priority_rules": EVENT_PRIORITY_RULES,
        "type_rules": EVENT_TYPE_RULES,
        "queue_rules": EVENT_QUEUE_RULES,
    }


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    return submissions_of(table(spark, sf, "events"))


def submissions_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("key"),
        F.col("event_type").alias("subject"),
        F.col("props").alias("body"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


INTAKE_SQL = """
SELECT event_id AS key, event_type AS subject, props AS body, ts AS created_at,
  CASE WHEN contains(txt, 'error') THEN 'Incident' WHEN contains(txt, 'click') THEN 'Problem'
       WHEN contains(txt, 'signup') THEN 'Change' ELSE 'Request' END AS type,
  CASE WHEN contains(txt, 'purchase') THEN 'Billing and Payments'
       WHEN contains(txt, 'signup') OR contains(txt, 'view') THEN 'Customer Service'
       ELSE 'Technical Support' END AS queue,
  CASE WHEN contains(txt, 'error') OR contains(txt, 'purchase') THEN 'high'
       WHEN contains(txt, 'view') THEN 'low' ELSE 'medium' END AS priority
FROM (SELECT *, lower(event_type || ' ' || props) AS txt FROM events WHERE event_type <> '' AND props <> '')
"""

# A user's day is a ticket; clicks edit, purchases approve, errors reject.
_TICKET_SQL = "(user_id * 1000 + dayofyear(ts))"
ACTIONS_SQL = f"""
SELECT {_TICKET_SQL} AS ticket_id, event_id AS action_id, ts,
       CASE event_type WHEN 'click' THEN 'modify' WHEN 'purchase' THEN 'approve' ELSE 'reject' END AS action,
       props AS text, 'agent-' || (event_id % 7) AS reviewer
FROM events
WHERE event_type IN ('click', 'purchase', 'error')
"""
# Tickets of the review queries, opened with the first event of the user's day.
REVIEW_TICKETS_SQL = f"""
SELECT {_TICKET_SQL} AS id, 'suggested reply for ' || {_TICKET_SQL} AS suggested_response, min(ts) AS created_at
FROM events GROUP BY {_TICKET_SQL}
"""


def _ticket() -> Column:
    return F.col("user_id") * 1000 + F.dayofyear("ts")


def actions(spark: SparkSession, sf: str) -> DataFrame:
    return actions_of(table(spark, sf, "events"))


def actions_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.filter(kind.isin("click", "purchase", "error")).select(
        _ticket().alias("ticket_id"),
        F.col("event_id").alias("action_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "click", "modify").when(kind == "purchase", "approve").otherwise("reject").alias("action"),
        F.col("props").alias("text"),
        F.concat(F.lit("agent-"), (F.col("event_id") % 7).cast("string")).alias("reviewer"),
    )


def review_tickets(spark: SparkSession, sf: str) -> DataFrame:
    opened = table(spark, sf, "events").groupBy(_ticket().alias("id"))
    return opened.agg(F.min("ts").cast("timestamp").alias("created_at")).select(
        "id",
        F.concat(F.lit("suggested reply for "), F.col("id").cast("string")).alias("suggested_response"),
        "created_at",
        F.lit("pending_review").alias("status"),
        F.lit(None).cast("string").alias("final_response"),
        F.lit(None).cast("string").alias("reviewed_by"),
    )
