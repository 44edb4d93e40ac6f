"""Queries that measure classifiers and generated replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.operators import classification as cl
from ticketgrain.operators import generation as gen
from ticketgrain.operators.scaling import stage
from ticketgrain.plans import mappings as m
from ticketgrain.plans.registry import query, rounded, sql_rounded, sql_words

# --- classifiers --------------------------------------------------------------
_CELLS = f"cells AS (SELECT truth, prediction, count(*) AS n FROM ({m.CLASSIFIED_SQL}) GROUP BY ALL)"
_CLASSES = f"""{_CELLS}, sides AS (
  SELECT truth AS label, n AS support, 0 AS predicted, CASE WHEN truth = prediction THEN n ELSE 0 END AS tp FROM cells
  UNION ALL SELECT prediction, 0, n, 0 FROM cells),
sums AS (SELECT label, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted, sum(tp)::BIGINT AS tp
         FROM sides GROUP BY label),
classes AS (SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE tp::DOUBLE / predicted END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END AS recall,
  CASE WHEN predicted + support = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (predicted + support) END AS f1, support, tp FROM sums)"""


def _cells(spark, sf):
    return cl.confusion_counts(m.classified(spark, sf))


@query("confusion_sparse", f"WITH {_CELLS} SELECT * FROM cells")
def confusion_sparse(spark, sf):
    return _cells(spark, sf)


@query("accuracy", f"WITH {_CELLS} SELECT round(sum(n) FILTER (truth = prediction)::DOUBLE / sum(n), 6) AS accuracy FROM cells")
def accuracy(spark, sf):
    return rounded(cl.accuracy(_cells(spark, sf)))


@query(
    "class_metrics",
    f"WITH {_CLASSES} " + sql_rounded("SELECT label, precision, recall, f1, support FROM classes", "precision recall f1"),
)
def class_metrics(spark, sf):
    return rounded(cl.class_metrics(_cells(spark, sf)).drop("tp"))


@query(
    "accuracy_f1",
    f"WITH {_CLASSES} "
    + sql_rounded(
        """SELECT sum(tp)::DOUBLE / sum(support) AS accuracy, avg(f1) AS f1_macro,
    sum(tp)::DOUBLE / sum(support) AS f1_micro, sum(f1 * support) / sum(support) AS f1_weighted,
    avg(precision) AS precision_macro, avg(recall) AS recall_macro FROM classes""",
        "accuracy f1_macro f1_micro f1_weighted precision_macro recall_macro",
    ),
)
def accuracy_f1(spark, sf):
    return rounded(cl.summary_metrics(_cells(spark, sf)))


@query(
    "class_report",
    f"WITH {_CLASSES} "
    + sql_rounded(
        """SELECT label, precision, recall, f1, support FROM classes
    UNION ALL SELECT 'accuracy', sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support),
      sum(tp)::DOUBLE / sum(support), sum(support)::BIGINT FROM classes
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM classes
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support)::BIGINT FROM classes""",
        "precision recall f1",
    ),
)
def class_report(spark, sf):
    return rounded(cl.class_report(stage(_cells(spark, sf))))


@query(
    "confusion",
    f"""WITH {_CELLS}, labels AS (SELECT truth AS label FROM cells UNION SELECT prediction FROM cells)
    SELECT a.label AS truth, b.label AS prediction, coalesce(n, 0) AS n FROM labels a CROSS JOIN labels b
    LEFT JOIN cells ON truth = a.label AND prediction = b.label""",
)
def confusion(spark, sf):
    return cl.dense_confusion(_cells(spark, sf), sorted(V.TICKET_PRIORITIES))


@query(
    "confusion_view",
    f"""WITH {_CELLS} SELECT truth, coalesce(sum(n) FILTER (prediction = 'high'), 0)::BIGINT AS high,
    coalesce(sum(n) FILTER (prediction = 'low'), 0)::BIGINT AS low,
    coalesce(sum(n) FILTER (prediction = 'medium'), 0)::BIGINT AS medium FROM cells GROUP BY truth""",
)
def confusion_view(spark, sf):
    return cl.confusion_matrix(_cells(spark, sf), sorted(V.TICKET_PRIORITIES))


@query(
    "confusion_pct",
    f"WITH {_CELLS} SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY truth), 6) AS pct FROM cells",
)
def confusion_pct(spark, sf):
    return rounded(cl.confusion_percent(stage(_cells(spark, sf))))


@query(
    "random_gap",
    f"WITH {_CELLS} "
    + sql_rounded(
        """SELECT *, accuracy - random_accuracy AS gap FROM (SELECT sum(n) FILTER (truth = prediction)::DOUBLE / sum(n)
    AS accuracy, 1.0::DOUBLE / count(DISTINCT truth) AS random_accuracy FROM cells)""",
        "accuracy random_accuracy gap",
    ),
)
def random_gap(spark, sf):
    return rounded(cl.random_gap(_cells(spark, sf)))


# --- generated replies --------------------------------------------------------
def _overlap_sql(pairs_sql: str) -> str:
    """Unstemmed n-gram overlaps per pair: o, p, q for rouge1/2 (r) and bleu1..4 (b)."""

    def rouge(text: str) -> str:
        spaced = f"regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g')"
        return f"list_filter(string_split({spaced}, ' '), lambda x: x <> '')"

    def bleu(text: str) -> str:
        return sql_words(f"lower({text})")

    sides = " UNION ALL ".join(
        f"SELECT conv_id, turn, '{side}' AS side, '{kind}' AS kind, {expr(column)} AS toks FROM pairs"
        for side, column in (("p", "prediction"), ("q", "reference"))
        for kind, expr in (("r", rouge), ("b", bleu))
    )
    grams = " UNION ALL ".join(
        f"SELECT conv_id, turn, side, kind || '{n}' AS family, unnest(list_transform(range(1, greatest(len(toks) - "
        f"{n - 1}, 0) + 1), lambda i: array_to_string(toks[i:i + {n - 1}], ' '))) AS gram FROM sides"
        + (" WHERE kind = 'b'" if n > 2 else "")
        for n in (1, 2, 3, 4)
    )
    figures = ", ".join(
        f"coalesce(sum({c}) FILTER (family = '{f}'), 0)::BIGINT AS {c}_{f}"
        for f in ("r1", "r2", "b1", "b2", "b3", "b4")
        for c in ("o", "p", "q")
    )
    return f"""
WITH pairs AS MATERIALIZED ({pairs_sql}), sides AS MATERIALIZED ({sides}), grams AS ({grams}),
counts AS (SELECT conv_id, turn, family, gram, count(*) FILTER (side = 'p') AS p, count(*) FILTER (side = 'q') AS q
           FROM grams GROUP BY ALL),
wide AS (SELECT conv_id, turn, {figures} FROM (SELECT *, least(p, q) AS o FROM counts) GROUP BY conv_id, turn),
scored AS (SELECT pairs.conv_id, pairs.turn, {", ".join(
    f"coalesce({c}_{f}, 0) AS {c}_{f}" for f in ("r1", "r2", "b1", "b2", "b3", "b4") for c in ("o", "p", "q")
)} FROM pairs LEFT JOIN wide ON wide.conv_id = pairs.conv_id AND wide.turn = pairs.turn)"""


def _prf_sql(f: str, name: str) -> str:
    return (
        f"CASE WHEN p_{f} = 0 THEN 0 ELSE o_{f}::DOUBLE / p_{f} END AS {name}_p, "
        f"CASE WHEN q_{f} = 0 THEN 0 ELSE o_{f}::DOUBLE / q_{f} END AS {name}_r, "
        f"CASE WHEN p_{f} + q_{f} = 0 THEN 0 ELSE 2.0::DOUBLE * o_{f} / (p_{f} + q_{f}) END AS {name}_f"
    )


_LOGS = " + ".join(
    f"0.25 * ln((CASE WHEN o_b{n} = 0 THEN 0.1 ELSE o_b{n} END)::DOUBLE / greatest(p_b{n}, 1))" for n in (1, 2, 3, 4)
)
_BLEU_SQL = f"""CASE WHEN o_b1 = 0 THEN 0 ELSE exp({_LOGS}) *
CASE WHEN p_b1 > q_b1 THEN 1 ELSE exp(1 - q_b1::DOUBLE / greatest(p_b1, 1)) END END"""
_SCORES_SQL = f"""SELECT conv_id, turn, {_prf_sql("r1", "rouge1")}, {_prf_sql("r2", "rouge2")}, {_BLEU_SQL} AS bleu,
p_b1 AS pred_length, q_b1 AS ref_length FROM scored"""
_ROUGE_COLUMNS = "rouge1_p rouge1_r rouge1_f rouge2_p rouge2_r rouge2_f"
_WITH = _overlap_sql(m.PAIRS_SQL)


def _scores(spark, sf):
    return gen.overlap_scores(m.pairs(spark, sf), m.PAIR_KEYS, use_stemmer=False)


@query(
    "rouge_n",
    _WITH + sql_rounded(f"SELECT conv_id, turn, {_ROUGE_COLUMNS.replace(' ', ', ')} FROM ({_SCORES_SQL})", _ROUGE_COLUMNS),
)
def rouge_n(spark, sf):
    return rounded(_scores(spark, sf).select(*m.PAIR_KEYS, *_ROUGE_COLUMNS.split()))


@query("bleu", _WITH + sql_rounded(f"SELECT conv_id, turn, bleu FROM ({_SCORES_SQL})", "bleu"))
def bleu(spark, sf):
    return rounded(_scores(spark, sf).select(*m.PAIR_KEYS, "bleu"))


@query("pair_lengths", _WITH + f"SELECT conv_id, turn, pred_length, ref_length FROM ({_SCORES_SQL})")
def pair_lengths(spark, sf):
    return gen.pair_lengths(m.pairs(spark, sf), m.PAIR_KEYS)


_SUMMARY_COLUMNS = "avg_rouge1_f std_rouge1_f avg_rouge2_f std_rouge2_f avg_bleu avg_pred_length avg_ref_length"


@query(
    "gen_summary",
    _WITH
    + sql_rounded(
        f"""SELECT avg(rouge1_f) AS avg_rouge1_f, stddev_pop(rouge1_f) AS std_rouge1_f, avg(rouge2_f) AS avg_rouge2_f,
    stddev_pop(rouge2_f) AS std_rouge2_f, avg(bleu) AS avg_bleu, avg(pred_length) AS avg_pred_length,
    avg(ref_length) AS avg_ref_length, count(*) AS sample_count FROM ({_SCORES_SQL})""",
        _SUMMARY_COLUMNS,
    ),
)
def gen_summary(spark, sf):
    return rounded(gen.aggregate_samples(_scores(spark, sf)))


@query(
    "length_ratio",
    _WITH
    + sql_rounded(
        f"""SELECT avg(pred_length) AS avg_pred_length, avg(ref_length) AS avg_ref_length,
    avg(pred_length) / avg(ref_length) AS ratio FROM ({_SCORES_SQL})""",
        "avg_pred_length avg_ref_length ratio",
    ),
)
def length_ratio(spark, sf):
    return rounded(gen.length_ratio(gen.pair_lengths(m.pairs(spark, sf), m.PAIR_KEYS)))


@query("rouge_stemmed")
def rouge_stemmed(spark, sf):
    """Stemmed words: needs a stemmer, so it is checked by unit tests."""
    scores = gen.overlap_scores(m.pairs(spark, sf), m.PAIR_KEYS)
    return rounded(scores.select(*m.PAIR_KEYS, *_ROUGE_COLUMNS.split()))


@query("rouge_l")
def rouge_l(spark, sf):
    """Subsequences of whole texts: too slow in SQL, checked against brute force in tests."""
    return rounded(gen.rouge_l(m.pairs(spark, sf), keep=m.PAIR_KEYS))


# Longest common subsequences by dynamic programming, one reference token in each step: a cell is the
# largest so far of the cell before the step and, where the tokens agree, one more than its left neighbour.
_ROUGE_L_SQL = f"""
WITH RECURSIVE pairs AS MATERIALIZED ({m.PAIRS_SQL}),
toks AS MATERIALIZED (SELECT conv_id, turn, {{p}} AS p, {{q}} AS q FROM pairs),
a AS MATERIALIZED (SELECT conv_id, turn, unnest(p) AS tok, generate_subscripts(p, 1) AS j FROM toks),
b AS MATERIALIZED (SELECT conv_id, turn, unnest(q) AS tok, generate_subscripts(q, 1) AS i FROM toks),
dp AS (
  SELECT conv_id, turn, tok, j, 0::BIGINT AS i, 0::BIGINT AS v FROM a
  UNION ALL
  SELECT conv_id, turn, tok, j, i, max(v) OVER (PARTITION BY conv_id, turn ORDER BY j) FROM (
    SELECT d.conv_id, d.turn, d.tok, d.j, b.i, greatest(d.v, CASE WHEN d.tok = b.tok
      THEN coalesce(lag(d.v) OVER (PARTITION BY d.conv_id, d.turn ORDER BY d.j), 0) + 1 ELSE 0 END) AS v
    FROM dp d JOIN b ON b.conv_id = d.conv_id AND b.turn = d.turn AND b.i = d.i + 1)),
longest AS (SELECT conv_id, turn, max(v) AS o FROM dp GROUP BY ALL),
scored AS (SELECT t.conv_id, t.turn, coalesce(o, 0) AS o_l, len(p) AS p_l, len(q) AS q_l
  FROM toks t LEFT JOIN longest l ON l.conv_id = t.conv_id AND l.turn = t.turn),
rouge_l AS (SELECT conv_id, turn, {_prf_sql("l", "rougeL")} FROM scored)""".format(
    **{
        side: f"list_filter(string_split(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
        for side, text in (("p", "prediction"), ("q", "reference"))
    }
)


@query(
    "rouge_l_plain",
    _ROUGE_L_SQL
    + sql_rounded('SELECT conv_id, turn, "rougeL_p", "rougeL_r", "rougeL_f" FROM rouge_l', "rougeL_p rougeL_r rougeL_f"),
)
def rouge_l_plain(spark, sf):
    return rounded(gen.rouge_l(m.pairs(spark, sf), use_stemmer=False, keep=m.PAIR_KEYS))


@query(
    "rouge_l_bands",
    _ROUGE_L_SQL
    + """SELECT band, count(f) AS n, round(count(f)::DOUBLE / (SELECT count(*) FROM rouge_l), 6) AS share
    FROM (VALUES ('excellent'), ('good'), ('fair')) AS x(band) LEFT JOIN (SELECT "rougeL_f" AS f, CASE WHEN "rougeL_f" > 0.5
      THEN 'excellent' WHEN "rougeL_f" >= 0.3 THEN 'good' ELSE 'fair' END AS band FROM rouge_l) USING (band) GROUP BY band""",
)
def rouge_l_bands(spark, sf):
    return rounded(gen.rouge_l_bands(gen.rouge_l(m.pairs(spark, sf), use_stemmer=False)))


# The pairs as multi-task outputs: fields before the reply, some of them wrong.
_RENDERED_PAIRS_SQL = f"""SELECT conv_id, turn,
'Classification:' || chr(10) || '- Type: Incident' || chr(10) || '- Queue: Sales' || chr(10) || '- Priority: High' ||
chr(10) || chr(10) || 'Response:' || chr(10) || prediction AS prediction, reference FROM ({m.PAIRS_SQL})"""


def _rendered_pairs(spark, sf):
    head = "Classification:\n- Type: Incident\n- Queue: Sales\n- Priority: High\n\nResponse:\n"
    turn = F.col("turn")
    expected = F.struct(
        F.lit("Incident").alias("type"),
        F.when(turn % 4 == 0, "Sales").otherwise("IT Support").alias("queue"),
        F.when(F.col("conv_id") % 2 == 0, "high").alias("priority"),
    )
    pairs = m.pairs(spark, sf)
    return pairs.withColumns(
        {"prediction": F.concat(F.lit(head), F.col("prediction")), "expected": expected}
    )


@query(
    "eval_samples",
    # The reply after the label is the original text, stripped.
    _overlap_sql(m.PAIRS_SQL)
    + sql_rounded(
        f"""SELECT conv_id, turn, {_ROUGE_COLUMNS.replace(" ", ", ")}, bleu, pred_length, ref_length,
    'Incident' AS pred_type, 'Sales' AS pred_queue, 'high' AS pred_priority, 1::BIGINT AS type_ok,
    (turn % 4 = 0)::BIGINT AS queue_ok, (conv_id % 2 = 0)::BIGINT AS priority_ok FROM ({_SCORES_SQL})""",
        _ROUGE_COLUMNS + " bleu",
    ),
)
def eval_samples(spark, sf):
    """Everything per sample except ROUGE-L (see ``rouge_l``)."""
    samples = gen.evaluate_samples(_rendered_pairs(spark, sf), m.PAIR_KEYS, use_stemmer=False)
    return rounded(
        samples.select(
            *m.PAIR_KEYS,
            *_ROUGE_COLUMNS.split(),
            "bleu",
            "pred_length",
            "ref_length",
            *[F.col(f"predicted_fields.{f}").alias(f"pred_{f}") for f in ("type", "queue", "priority")],
            *[
                F.col(f"classification_correct.{f}").cast("long").alias(f"{f}_ok")
                for f in ("type", "queue", "priority")
            ],
        )
    )


@query("eval_report")
def eval_report(spark, sf):
    """The complete evaluation run with stemming, fields and ROUGE-L."""
    samples = gen.evaluate_samples(_rendered_pairs(spark, sf), m.PAIR_KEYS)
    return rounded(gen.aggregate_samples(samples))
