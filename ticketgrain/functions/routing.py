"""Keyword routing of a ticket and its reply template."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V

Rules = Sequence[tuple[str, Sequence[str]]]


def route(text: Column, rules: Rules, default: str) -> Column:
    """Label of the first rule with any of its words inside the (lower-case) text."""
    branches = []
    for label, keywords in rules:
        hit = F.lit(False)
        for word in keywords:
            hit = hit | F.contains(text, F.lit(word))
        branches.append(F.when(hit, F.lit(label)))
    return F.coalesce(*branches, F.lit(default))


def classify_ticket(
    subject: Column,
    body: Column,
    priority_rules: Rules = V.PRIORITY_RULES,
    type_rules: Rules = V.TYPE_RULES,
    queue_rules: Rules = V.QUEUE_RULES,
) -> Column:
    """Struct of type, queue, priority and the constant confidence."""
    text = F.lower(F.concat(subject, F.lit(" "), body))
    return F.struct(
        route(text, type_rules, V.TYPE_DEFAULT).alias("type"),
        route(text, queue_rules, V.QUEUE_DEFAULT).alias("queue"),
        route(text, priority_rules, V.PRIORITY_DEFAULT).alias("priority"),
        F.lit(V.ROUTING_CONFIDENCE).cast("double").alias("confidence"),
    )


def suggest_reply(
    subject: Column, priority: Column, templates: Mapping[str, str] = V.REPLY_TEMPLATES
) -> Column:
    """Template of the priority (medium when unknown) with the start of the subject."""
    chosen = F.coalesce(
        *[F.when(priority == name, F.lit(text)) for name, text in templates.items()],
        F.lit(templates[V.DEFAULT_PRIORITY]),
    )
    return F.replace(chosen, F.lit("{subject}"), F.substring(subject, 1, V.REPLY_SUBJECT_CHARS))
