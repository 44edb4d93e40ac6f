"""Instruction samples and prompts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions.text import clean_text


def ticket_input(subject: Column, body: Column) -> Column:
    """Cleaned subject and body under headings; the body alone without a subject."""
    clean_subject = clean_text(subject)
    heading = F.concat(F.lit("Subject: "), clean_subject, F.lit("\n\nContent:\n"))
    return F.concat(F.when(clean_subject != "", heading).otherwise(""), clean_text(body))


def multi_task_output(
    ticket_type: Column, queue: Column, priority: Column, tags: Column, answer: Column
) -> Column:
    return F.concat(
        F.lit("Classification:\n- Type: "), ticket_type,
        F.lit("\n- Queue: "), queue,
        F.lit("\n- Priority: "), priority,
        F.lit("\n- Tags: "), tags,
        F.lit("\n\nResponse:\n"), answer,
    )


def classification_output(ticket_type: Column, queue: Column, priority: Column) -> Column:
    return F.concat(
        F.lit("Type: "), ticket_type, F.lit(" | Queue: "), queue, F.lit(" | Priority: "), priority
    )


def build_prompt(instruction: Column, user_input: Column, template: str = "chat") -> Column:
    """Chat layout for ``chat``, the instruction/input/response layout otherwise."""
    layout = V.CHAT_LAYOUT if template == "chat" else V.PLAIN_LAYOUT
    head, rest = layout.split("{instruction}")
    middle, tail = rest.split("{input}")
    return F.concat(F.lit(head), instruction, F.lit(middle), user_input, F.lit(tail))
