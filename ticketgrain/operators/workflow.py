"""Ticket intake, review state and dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions.routing import classify_ticket, suggest_reply
from ticketgrain.operators.scaling import global_row_number

TERMINAL = ("approve", "reject")


def intake(submissions: DataFrame, **rules) -> DataFrame:
    """Route submissions and open them for review; works on batch and streaming tables.

    A submission needs a subject and a body.  Other columns pass through.
    """
    subject, body = F.col("subject"), F.col("body")
    complete = submissions.filter((subject != "") & (body != ""))
    routed = complete.withColumn("classification", classify_ticket(subject, body, **rules))
    return routed.withColumns(
        {
            "suggested_response": suggest_reply(subject, F.col("classification.priority")),
            "status": F.lit(V.STATUS_PENDING),
            "final_response": F.lit(None).cast("string"),
            "reviewed_by": F.lit(None).cast("string"),
        }
    )


def number_tickets(tickets: DataFrame, order: str = "created_at", key: str = "key") -> DataFrame:
    """Dense ids from 1 in submission order (batch; a stream keeps its own key)."""
    return global_row_number(tickets, [F.asc(order), F.asc(key)], "id")


def _place() -> Column:
    """Time and id of an action as one fixed-width number, so that minima stay hash aggregates."""
    return F.unix_micros("ts").cast("decimal(19,0)") * F.lit(2**62).cast("decimal(19,0)") + F.col("action_id")


def _winners(actions: DataFrame, chosen: DataFrame) -> DataFrame:
    """The actions at the chosen places (ticket_id, place), of which each ticket has one."""
    return actions.withColumn("place", _place()).join(chosen, ["ticket_id", "place"], "left_semi")


def _first_places(actions: DataFrame) -> DataFrame:
    terminal = actions.filter(F.col("action").isin(*TERMINAL))
    return terminal.groupBy("ticket_id").agg(F.min(_place()).alias("place"))


def first_terminal(actions: DataFrame) -> DataFrame:
    """The first approve or reject of each ticket: ticket_id, t_action, t_text, t_reviewer.

    Numbers alone are aggregated, before the shuffle too, so a ticket with very many actions
    sends one row per task; the texts of the winners are fetched afterwards.
    """
    found = _winners(actions, _first_places(actions))
    return found.select(
        "ticket_id",
        F.col("action").alias("t_action"),
        F.col("text").alias("t_text"),
        F.col("reviewer").alias("t_reviewer"),
    )


def last_open_edit(actions: DataFrame) -> DataFrame:
    """The last modify of each ticket before its terminal action: ticket_id, edited_response.

    Edits of one ticket may be a large part of the log: as numbers they meet the ticket's one
    terminal place, where the planner may split a hot ticket, and are reduced right after.
    """
    edits = actions.filter(F.col("action") == "modify").select("ticket_id", _place().alias("place"))
    cut = _first_places(actions).withColumnRenamed("place", "cut")
    joined = edits.join(cut, "ticket_id", "left")
    last = (
        joined.filter(F.col("cut").isNull() | (F.col("place") < F.col("cut")))
        .groupBy("ticket_id")
        .agg(F.max("place").alias("place"))
    )
    return _winners(actions, last).select("ticket_id", F.col("text").alias("edited_response"))


def review_state(tickets: DataFrame, actions: DataFrame) -> DataFrame:
    """Apply the action log (ticket_id, action_id, ts, action, text, reviewer) to the tickets.

    The first approve or reject closes a ticket, later actions change nothing; an
    edit replaces the suggestion; approving without a text sends the suggestion.
    """
    terminal = first_terminal(actions)
    edits = last_open_edit(actions)
    joined = (
        tickets.drop("status", "final_response", "reviewed_by")
        .join(terminal, tickets["id"] == terminal["ticket_id"], "left")
        .drop("ticket_id")
        .join(edits, tickets["id"] == edits["ticket_id"], "left")
        .drop("ticket_id")
    )
    suggestion = F.coalesce("edited_response", "suggested_response")
    approved = F.col("t_action") == "approve"
    status = (
        F.when(approved, V.STATUS_APPROVED)
        .when(F.col("t_action") == "reject", V.STATUS_REJECTED)
        .otherwise(V.STATUS_PENDING)
    )
    return joined.withColumns(
        {
            "suggested_response": suggestion,
            "status": status,
            "final_response": F.when(approved, F.coalesce("t_text", suggestion)),
            "reviewed_by": F.when(approved, F.coalesce("t_reviewer", F.lit(V.DEFAULT_REVIEWER))),
        }
    ).drop("t_action", "t_text", "t_reviewer", "edited_response")


def pending_tickets(tickets: DataFrame, actions: DataFrame) -> DataFrame:
    """Tickets without a terminal action."""
    closed = actions.filter(F.col("action").isin(*TERMINAL)).select(F.col("ticket_id").alias("id")).distinct()
    return tickets.join(closed, "id", "left_anti")


def history(
    tickets: DataFrame, status: str | None = None, priority: str | None = None, search: str | None = None
) -> DataFrame:
    """Tickets by status, priority and a case-insensitive text in subject or body."""
    if status is not None:
        tickets = tickets.filter(F.col("status") == status)
    if priority is not None:
        tickets = tickets.filter(F.col("classification.priority") == priority)
    if search:
        needle = F.lit(search.lower())
        found = F.contains(F.lower("subject"), needle) | F.contains(F.lower("body"), needle)
        tickets = tickets.filter(found)
    return tickets


def dashboard_counters(tickets: DataFrame) -> DataFrame:
    """Total, approved, pending and high-priority tickets."""
    return tickets.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == V.STATUS_APPROVED).alias("approved"),
        F.count_if(F.col("status") == V.STATUS_PENDING).alias("pending"),
        F.count_if(F.col("classification.priority") == "high").alias("high_priority"),
    )


def _dimensions(tickets: DataFrame) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(f).alias("dimension"), F.col(f"classification.{f}").alias("value"))
                for f in ("priority", "type")
            ]
        )
    )


def dashboard_distributions(tickets: DataFrame) -> DataFrame:
    """Tickets per priority and per type in one pass; works on streams too."""
    return (
        tickets.select(_dimensions(tickets)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    )
