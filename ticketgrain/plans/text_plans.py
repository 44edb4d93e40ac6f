"""Queries over ticket text: cleaning, assembling, sampling, prompts, extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketgrain.functions import extraction, prompts
from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx
from ticketgrain.operators import classification, sampling
from ticketgrain.operators import tickets as tk
from ticketgrain.plans import mappings as m
from ticketgrain.plans.registry import (
    WS, query, rounded, sql_basic_clean, sql_clean_text, sql_prompt, sql_rounded, sql_strip, sql_text, sql_words, table,
)

_TICKETS = f"({m.TICKETS_SQL})"
_LABELLED = f"({m.LABELLED_SQL})"


@query(
    "clean_documents",
    f"""SELECT doc_id, cleaned, length(cleaned)::BIGINT AS n_chars, len({sql_words("cleaned")})::BIGINT AS n_words
    FROM (SELECT doc_id, {sql_basic_clean("text")} AS cleaned FROM documents)""",
)
def clean_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", tx.basic_clean(F.col("text")).alias("cleaned"))
    return docs.select(
        "doc_id", "cleaned", tx.char_count(F.col("cleaned")).alias("n_chars"),
        tx.word_count(F.col("cleaned")).alias("n_words"),
    )


@query(
    "clean_text_keep_layout",
    f"SELECT conv_id, turn, {sql_clean_text('text')} AS cleaned FROM conversations",
)
def clean_text_keep_layout(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.clean_text(F.col("text")).alias("cleaned")
    )


@query(
    "clean_keep_punct",
    f"""SELECT doc_id, {sql_strip(f"regexp_replace(regexp_replace(regexp_replace(lower(text), "
                                 f"'http[^{WS}]+|www[^{WS}]+', '', 'g'), '[^{WS}]+@[^{WS}]+', '', 'g'), "
                                 f"'[{WS}]+', ' ', 'g')")} AS cleaned FROM documents""",
)
def clean_keep_punct(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.basic_clean(F.col("text"), keep_punctuation=True).alias("cleaned")
    )


@query("strip_only", f"SELECT page_id, {sql_strip('html')} AS stripped FROM pages")
def strip_only(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip(F.col("html")).alias("stripped"))


@query(
    "null_defaults",
    f"SELECT doc_id, coalesce(text, '') AS text, coalesce(priority, 'medium') AS priority FROM {_LABELLED}",
)
def null_defaults(spark, sf):
    return tk.with_defaults(m.labelled(spark, sf)).select("doc_id", "text", "priority")


@query("lang_filter", f"SELECT doc_id, queue, language FROM {_TICKETS} WHERE language = 'en'")
def lang_filter(spark, sf):
    return tk.filter_language(m.tickets(spark, sf)).select("doc_id", "queue", "language")


_ASSEMBLED = f"""SELECT doc_id, coalesce(subject, '') || chr(10) || chr(10) || coalesce(body, '') AS text
FROM {_TICKETS}"""


@query(
    "ticket_text",
    f"""SELECT doc_id, text, length(text)::BIGINT AS n_chars, len({sql_words("text")})::BIGINT AS n_words,
    {sql_basic_clean("text")} AS cleaned_text FROM ({_ASSEMBLED})""",
)
def ticket_text(spark, sf):
    return tk.with_text(m.tickets(spark, sf)).select("doc_id", "text", "n_chars", "n_words", "cleaned_text")


def _sql_input(subject: str = "subject", body: str = "body") -> str:
    s, b = sql_clean_text(subject), sql_clean_text(body)
    return (
        f"CASE WHEN {s} <> '' THEN 'Subject: ' || {s} || chr(10) || chr(10) || 'Content:' || chr(10) || {b} "
        f"ELSE {b} END"
    )


@query("ticket_input", f"SELECT doc_id, {_sql_input()} AS input FROM {_TICKETS}")
def ticket_input(spark, sf):
    return m.tickets(spark, sf).select(
        "doc_id", prompts.ticket_input(F.col("subject"), F.col("body")).alias("input")
    )


# Parts as tagged tickets: some tags are null, some empty, some rows have none.
_PART_TAGS_SQL = """SELECT p_partkey, p_size,
    CASE WHEN p_size % 4 > 0 THEN p_brand ELSE '' END AS tag_1,
    CASE WHEN p_size % 3 > 0 THEN p_type END AS tag_2,
    CASE WHEN p_size % 2 > 0 THEN p_name END AS tag_3,
    CASE WHEN p_size % 5 > 1 THEN 'size ' || p_size END AS tag_4, CASE WHEN p_size % 5 = 0 THEN p_brand ELSE '' END AS tag_5,
    CASE WHEN p_size % 7 = 0 THEN p_type END AS tag_6, CASE WHEN p_size % 6 = 0 THEN p_name END AS tag_7,
    CASE WHEN p_size > 40 THEN 'large' ELSE '' END AS tag_8 FROM part"""


def _tagged_parts(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(size % 4 > 0, F.col("p_brand")).otherwise("").alias("tag_1"),
        F.when(size % 3 > 0, F.col("p_type")).alias("tag_2"),
        F.when(size % 2 > 0, F.col("p_name")).alias("tag_3"),
        F.when(size % 5 > 1, F.concat(F.lit("size "), size.cast("string"))).alias("tag_4"),
        F.when(size % 5 == 0, F.col("p_brand")).otherwise("").alias("tag_5"),
        F.when(size % 7 == 0, F.col("p_type")).alias("tag_6"),
        F.when(size % 6 == 0, F.col("p_name")).alias("tag_7"),
        F.when(size > 40, F.lit("large")).otherwise("").alias("tag_8"),
    )


@query(
    "tags",
    f"""SELECT p_partkey, coalesce(nullif(concat_ws(', ', {", ".join(f"nullif({c}, '')" for c in V.TAG_COLUMNS)}), ''), 'None') AS tags FROM ({_PART_TAGS_SQL})""",
)
def tags(spark, sf):
    parts = _tagged_parts(spark, sf)
    return parts.select("p_partkey", tx.format_tags([F.col(c) for c in V.TAG_COLUMNS]).alias("tags"))


@query(
    "preview",
    """SELECT doc_id, substr(text, 1, 500) AS p500, substr(text, 1, 200) AS p200, substr(text, 1, 150) AS p150,
    substr(text, 1, 50) AS p50 FROM documents""",
)
def preview(spark, sf):
    out = table(spark, sf, "documents").select("doc_id", "text")
    for chars in (500, 200, 150, 50):
        out = tk.with_preview(out, "text", chars, f"p{chars}")
    return out.drop("text")


@query(
    "first_per_class",
    """SELECT source, doc_id, substr(text, 1, 200) AS example FROM documents
    WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY source)""",
)
def first_per_class(spark, sf):
    return tk.first_per_class(table(spark, sf, "documents"), "source", "doc_id")


# --- sampling and splitting ---------------------------------------------------
@query("head_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100")
def head_n(spark, sf):
    return sampling.head(table(spark, sf, "documents").select("doc_id", "text"), 100, "doc_id")


@query(
    "sample_n",
    "SELECT doc_id, source FROM documents ORDER BY md5(doc_id || '-42'), doc_id LIMIT 100",
)
def sample_n(spark, sf):
    return sampling.random_sample(table(spark, sf, "documents").select("doc_id", "source"), 100, "doc_id")


def _line_items(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_shipdate", "l_quantity")


_LINE_ITEMS_SQL = "SELECT l_orderkey * 10 + l_linenumber AS line_id, l_shipdate, l_quantity FROM lineitem"


@query("head_20000", f"SELECT * FROM ({_LINE_ITEMS_SQL}) ORDER BY line_id LIMIT 20000")
def head_20000(spark, sf):
    """A long head: found by its last key, rows filtered where they are."""
    return sampling.head(_line_items(spark, sf), 20_000, "line_id")


@query("sample_20000", f"SELECT * FROM ({_LINE_ITEMS_SQL}) ORDER BY md5(line_id || '-42'), line_id LIMIT 20000")
def sample_20000(spark, sf):
    return sampling.random_sample(_line_items(spark, sf), 20_000, "line_id")


@query(
    "holdout",
    f"""SELECT doc_id, CASE WHEN substr(md5(doc_id || '-42'), 1, 8) < '{int(0.05 * 16**8):08x}' THEN 'val'
    ELSE 'train' END AS part FROM documents""",
)
def holdout(spark, sf):
    return sampling.holdout(table(spark, sf, "documents").select("doc_id"), "doc_id")


_SPLIT_SQL = """
WITH strata AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
total AS (SELECT sum(n)::BIGINT AS n, (sum(n) - ceil(sum(n) * 0.3))::BIGINT AS n_train FROM strata),
shares AS (SELECT source, s.n, s.n * t.n_train::DOUBLE / t.n AS exact, t.n_train AS draws FROM strata s, total t),
first_cut AS (SELECT source, n, floor(exact)::BIGINT + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact)
  DESC, source) <= draws - (SELECT sum(floor(exact)) FROM shares) THEN 1 ELSE 0 END AS n_train FROM shares),
held AS (SELECT sum(n - n_train)::BIGINT AS h FROM first_cut),
second AS (SELECT source, n, n_train, n - n_train AS h, (held.h - ceil(held.h * 0.5))::BIGINT AS draws,
  (n - n_train) * (held.h - ceil(held.h * 0.5))::DOUBLE / held.h AS exact FROM first_cut, held),
quotas AS (SELECT source, n, n_train, floor(exact)::BIGINT + CASE WHEN row_number() OVER (ORDER BY exact -
  floor(exact) DESC, source) <= draws - (SELECT sum(floor(exact)) FROM second) THEN 1 ELSE 0 END AS n_val FROM second),
placed AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || '-42')) AS r
  FROM documents),
split AS (SELECT doc_id, p.source, CASE WHEN r <= n_train THEN 'train' WHEN r <= n_train + n_val THEN 'val'
  ELSE 'test' END AS split FROM placed p JOIN quotas q ON p.source = q.source)
"""


def _split_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return sampling.stratified_split(docs, "doc_id", "source")


@query("stratified_split", _SPLIT_SQL + "SELECT doc_id, source, split FROM split")
def stratified_split(spark, sf):
    return _split_documents(spark, sf)


@query(
    "split_sizes",
    _SPLIT_SQL + "SELECT coalesce(split, 'total') AS split, count(*) AS n_rows FROM split GROUP BY ROLLUP (split)",
)
def split_sizes(spark, sf):
    from ticketgrain.operators.profiling import split_sizes as sizes

    return sizes(_split_documents(spark, sf))


@query(
    "review_template",
    """SELECT row_number() OVER (ORDER BY conv_id, turn) AS id, substr(input, 1, 500) AS input,
    substr(reference, 1, 500) AS reference, substr(prediction, 1, 500) AS prediction, '' AS relevance,
    '' AS professionalism, '' AS completeness, '' AS tone, '' AS overall, '' AS comments
    FROM (SELECT conv_id, turn, prediction AS input, reference, prediction FROM (""" + m.PAIRS_SQL + """)
    ORDER BY conv_id, turn LIMIT 100)""",
)
def review_template(spark, sf):
    samples = m.pairs(spark, sf).select(
        F.struct("conv_id", "turn").alias("sample"), F.col("prediction").alias("input"), "reference", "prediction"
    )
    return sampling.review_template(samples, "sample")


# --- instruction samples and prompts ------------------------------------------
_TYPE, _QUEUE, _PRIORITY = "coalesce(type, 'Unknown')", "coalesce(queue, 'Unknown')", "coalesce(priority, 'medium')"
_BODY = sql_clean_text("body")
_MULTI_SQL = f"""SELECT doc_id, {sql_text(V.MULTI_TASK_INSTRUCTION)} AS instruction, {_sql_input()} AS input,
'Classification:' || chr(10) || '- Type: ' || {_TYPE} || chr(10) || '- Queue: ' || {_QUEUE} || chr(10) ||
'- Priority: ' || {_PRIORITY} || chr(10) || '- Tags: None' || chr(10) || chr(10) || 'Response:' || chr(10) || {_BODY}
AS output FROM {_LABELLED}"""


def _answered(spark, sf):
    """Labelled tickets whose answer is their body."""
    return m.labelled(spark, sf).withColumn("answer", F.col("body"))


def _samples(spark, sf, task):
    return tk.valid_samples(tk.instruction_samples(_answered(spark, sf), task, keep=["doc_id"]))


@query("instruct_multi_task", f"SELECT * FROM ({_MULTI_SQL}) WHERE input <> '' AND output <> ''")
def instruct_multi_task(spark, sf):
    return _samples(spark, sf, "multi_task")


_CLASSIFY_SQL = f"""SELECT doc_id, {sql_text(V.CLASSIFICATION_INSTRUCTION)} AS instruction, {_sql_input()} AS input,
'Type: ' || {_TYPE} || ' | Queue: ' || {_QUEUE} || ' | Priority: ' || {_PRIORITY} AS output FROM {_LABELLED}"""


@query("instruct_classify", f"SELECT * FROM ({_CLASSIFY_SQL}) WHERE input <> '' AND output <> ''")
def instruct_classify(spark, sf):
    return _samples(spark, sf, "classification")


_RESPONSE_SQL = f"""SELECT doc_id, {sql_text(V.RESPONSE_INSTRUCTION)} AS instruction, {_sql_input()} AS input,
{_BODY} AS output FROM {_LABELLED}"""


@query("instruct_response", f"SELECT * FROM ({_RESPONSE_SQL}) WHERE input <> '' AND output <> ''")
def instruct_response(spark, sf):
    return _samples(spark, sf, "response_generation")


@query(
    "sample_counts",
    f"""SELECT count(*) FILTER (input <> '' AND output <> '') AS kept,
    count(*) FILTER (NOT (input <> '' AND output <> '')) AS skipped FROM ({_RESPONSE_SQL})""",
)
def sample_counts(spark, sf):
    return tk.sample_counts(tk.instruction_samples(_answered(spark, sf), "response_generation"))


_TURNS_SQL = f"""SELECT conv_id, turn, {sql_text(V.RESPONSE_INSTRUCTION)} AS instruction, text AS input
FROM conversations"""


@query(
    "chat_prompt",
    f"""SELECT conv_id, turn, {sql_prompt(V.CHAT_LAYOUT)} AS chat, {sql_prompt(V.PLAIN_LAYOUT)} AS plain
    FROM ({_TURNS_SQL})""",
)
def chat_prompt(spark, sf):
    turns = table(spark, sf, "conversations")
    instruction = F.lit(V.RESPONSE_INSTRUCTION)
    return turns.select(
        "conv_id",
        "turn",
        prompts.build_prompt(instruction, F.col("text")).alias("chat"),
        prompts.build_prompt(instruction, F.col("text"), "plain").alias("plain"),
    )


# --- extraction ---------------------------------------------------------------
_W = r"[\p{L}\p{N}_]"


def _sql_fields(text: str) -> str:
    """Type, queue, priority and response of a rendered output."""
    response = f"nullif(regexp_extract({text}, '(?is)Response:[{WS}]*(.+)', 1), '')"
    return f"""nullif(regexp_extract({text}, '(?i)Type:[{WS}]*({_W}+)', 1), '') AS type,
    {sql_strip(f"nullif(regexp_extract({text}, '(?i)Queue:[{WS}]*([^{chr(92)}n]+)', 1), '')")} AS queue,
    lower(nullif(regexp_extract({text}, '(?i)Priority:[{WS}]*({_W}+)', 1), '')) AS priority,
    {sql_strip(f"coalesce({response}, {text})")} AS response"""


@query("extract_fields", f"SELECT doc_id, {_sql_fields('output')} FROM ({_MULTI_SQL})")
def extract_fields(spark, sf):
    outputs = tk.instruction_samples(_answered(spark, sf), "multi_task", keep=["doc_id"])
    output = F.col("output")
    return outputs.select(
        "doc_id",
        extraction.extract_classification(output).alias("_c"),
        extraction.extract_response(output).alias("response"),
    ).select("doc_id", "_c.*", "response")


@query(
    "extract_one_line",
    f"SELECT doc_id, type, queue, priority FROM (SELECT doc_id, {_sql_fields('output')} FROM ({_CLASSIFY_SQL}))",
)
def extract_one_line(spark, sf):
    """On the one-line layout the queue takes the rest of the line."""
    outputs = tk.instruction_samples(_answered(spark, sf), "classification", keep=["doc_id"])
    return outputs.select("doc_id", extraction.extract_classification(F.col("output")).alias("_c")).select(
        "doc_id", "_c.*"
    )


# Orders rendered as model outputs; the predicted type is missing for some.
_RENDERED_SQL = f"""SELECT o_orderkey, truth, prediction,
'- Type: ' || CASE WHEN o_orderkey % 5 > 0 THEN 'Incident' ELSE '' END || chr(10) || '- Queue: Sales ' ||
(o_orderkey % 3) || chr(10) || '- Priority: ' || upper(prediction) AS output FROM ({m.CLASSIFIED_SQL})"""


def _rendered(spark, sf):
    key = F.col("o_orderkey")
    return m.classified(spark, sf).withColumn(
        "output",
        F.concat(
            F.lit("- Type: "), F.when(key % 5 > 0, "Incident").otherwise(""),
            F.lit("\n- Queue: Sales "), (key % 3).cast("string"),
            F.lit("\n- Priority: "), F.upper("prediction"),
        ),
    )


@query(
    "field_accuracy",
    sql_rounded(
        f"""SELECT avg((type IS NOT DISTINCT FROM 'Incident')::INT) AS type_accuracy,
    avg((queue IS NOT DISTINCT FROM CASE WHEN o_orderkey % 2 = 0 THEN 'Sales 1' END)::INT) AS queue_accuracy,
    avg((priority IS NOT DISTINCT FROM truth)::INT) AS priority_accuracy
    FROM (SELECT o_orderkey, truth, {_sql_fields('output')} FROM ({_RENDERED_SQL}))""",
        "type_accuracy queue_accuracy priority_accuracy",
    ),
)
def field_accuracy(spark, sf):
    expected = F.struct(
        F.lit("Incident").alias("type"),
        F.when(F.col("o_orderkey") % 2 == 0, "Sales 1").alias("queue"),
        F.col("truth").alias("priority"),
    )
    rendered = _rendered(spark, sf).select(
        extraction.extract_classification(F.col("output")).alias("predicted"), expected.alias("expected")
    )
    return rounded(classification.field_accuracy(rendered))
