"""Queries that profile tables: quality, lengths, counts, weights, vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx
from ticketgrain.operators import features, profiling
from ticketgrain.operators.scaling import stage
from ticketgrain.plans import mappings as m
from ticketgrain.plans.registry import query, rounded, sql_basic_clean, sql_rounded, sql_words, table

_LENGTHS_SQL = f"""SELECT length(text)::BIGINT AS n_chars, len({sql_words("text")})::BIGINT AS n_words FROM documents"""


# --- flagship -----------------------------------------------------------------
_CLASS_SQL = f"""
SELECT quality, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct,
       avg(length(cleaned)) AS mean_chars, avg(len({sql_words("cleaned")})) AS mean_words
FROM (SELECT quality::BIGINT AS quality, {sql_basic_clean("text")} AS cleaned
      FROM documents JOIN labels USING (doc_id)) GROUP BY quality"""


@query("class_profile", sql_rounded(_CLASS_SQL, "pct mean_chars mean_words"))
def class_profile(spark, sf):
    """Clean the documents, attach their class and profile each class."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    lengths = profiling.labelled_lengths(table(spark, sf, "documents"), labels, "doc_id", "quality")
    return rounded(profiling.class_profile(lengths, "quality"))


# --- lengths ------------------------------------------------------------------
def _lengths(spark, sf):
    return profiling.with_lengths(table(spark, sf, "documents"))


def _per_measure(sql: str) -> str:
    return " UNION ALL ".join(sql.format(c=c) for c in ("n_chars", "n_words"))


_STATS = _per_measure(
    "SELECT '{c}' AS measure, min({c}) AS min, max({c}) AS max, avg({c}) AS mean, median({c}) AS median, "
    "stddev_pop({c}) AS std, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.75) AS p75 FROM lengths"
)
_DESCRIBE = _per_measure(
    "SELECT '{c}' AS measure, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, "
    "quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, "
    "max({c}) AS max FROM lengths"
)


@query(
    "length_stats",
    f"WITH lengths AS ({_LENGTHS_SQL}) " + sql_rounded(_STATS, "mean median std p25 p75"),
)
def length_stats(spark, sf):
    return rounded(profiling.length_stats(_lengths(spark, sf)))


@query(
    "length_describe",
    f"WITH lengths AS ({_LENGTHS_SQL}) " + sql_rounded(_DESCRIBE, "mean std p25 p50 p75"),
)
def length_describe(spark, sf):
    return rounded(profiling.describe(_lengths(spark, sf)))


_HISTOGRAM = f"""
WITH lengths AS ({_LENGTHS_SQL}), r AS (SELECT min(n_words)::DOUBLE lo, max(n_words)::DOUBLE hi FROM lengths),
c AS (SELECT least(floor((n_words - lo) / (hi - lo) * 50), 49)::BIGINT AS bin, count(*) AS n FROM lengths, r
      GROUP BY ALL)
SELECT b.bin::BIGINT AS bin, lo + b.bin * (hi - lo) / 50 AS bin_start, lo + (b.bin + 1) * (hi - lo) / 50 AS bin_end,
       coalesce(n, 0) AS n
FROM range(50) b(bin) CROSS JOIN r LEFT JOIN c ON c.bin = b.bin"""


@query("length_histogram", sql_rounded(_HISTOGRAM, "bin_start bin_end"))
def length_histogram(spark, sf):
    return rounded(profiling.histogram(_lengths(spark, sf), "n_words", 50))


@query(
    "quality_profile",
    sql_rounded(
        """SELECT count(*) AS n_rows, count(*) FILTER (trim(coalesce(text, '')) = '') AS n_blank,
    count(*) - count(DISTINCT coalesce(text, '')) AS n_duplicates, min(length(text))::BIGINT AS min_chars,
    max(length(text))::BIGINT AS max_chars, avg(length(text)) AS mean_chars, stddev_pop(length(text)) AS std_chars
    FROM documents""",
        "mean_chars std_chars",
    ),
)
def quality_profile(spark, sf):
    return rounded(profiling.quality_profile(table(spark, sf, "documents")))


# --- counts and weights -------------------------------------------------------
@query(
    "value_counts",
    """SELECT 'lang' AS column, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang
    UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source""",
)
def value_counts(spark, sf):
    return profiling.value_counts(table(spark, sf, "documents"), ["lang", "source", "priority"])


@query(
    "label_distribution",
    sql_rounded(
        """SELECT o_orderpriority, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM orders
    GROUP BY o_orderpriority""",
        "pct",
    ),
)
def label_distribution(spark, sf):
    return rounded(profiling.label_distribution(table(spark, sf, "orders"), "o_orderpriority"))


@query(
    "class_weights",
    sql_rounded(
        """SELECT lang, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*))::DOUBLE AS weight
    FROM documents GROUP BY lang""",
        "weight",
    ),
)
def class_weights(spark, sf):
    return rounded(profiling.class_weights(table(spark, sf, "documents"), "lang"))


@query(
    "oversample_weights",
    sql_rounded(
        "SELECT lang, count(*) AS n, max(count(*)) OVER () / count(*)::DOUBLE AS weight FROM documents GROUP BY lang",
        "weight",
    ),
)
def oversample_weights(spark, sf):
    return rounded(profiling.oversample_weights(table(spark, sf, "documents"), "lang"))


@query(
    "oversampled_docs",
    """WITH w AS (SELECT lang, round(max(count(*)) OVER () / count(*)::DOUBLE)::BIGINT AS k FROM documents
    GROUP BY lang) SELECT doc_id, lang, unnest(range(1, k + 1)) AS copy FROM documents JOIN w USING (lang)""",
)
def oversampled_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    out = profiling.oversample(docs, "lang")
    return out.select("doc_id", "lang", F.col("copy").cast("long").alias("copy"))


@query(
    "label_index",
    "SELECT lang AS label, row_number() OVER (ORDER BY lang) - 1 AS id FROM (SELECT DISTINCT lang FROM documents)",
)
def label_index(spark, sf):
    return features.label_index(table(spark, sf, "documents"), "lang")


@query(
    "encoded_labels",
    """SELECT doc_id, id AS label_id FROM documents JOIN (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS id
    FROM (SELECT DISTINCT lang FROM documents)) USING (lang)""",
)
def encoded_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return features.encode_labels(docs, "lang", features.label_index(docs, "lang")).select("doc_id", "label_id")


@query(
    "epoch_metrics",
    sql_rounded(
        f"""SELECT exp, epoch, avg(loss) AS avg_loss, sum(correct)::DOUBLE / sum(total) AS accuracy
    FROM ({m.STEPS_SQL}) GROUP BY exp, epoch""",
        "avg_loss accuracy",
        9,
    ),
)
def epoch_metrics(spark, sf):
    return rounded(profiling.epoch_metrics(m.steps(spark, sf)), 9)


# --- words and vocabularies ---------------------------------------------------
_WORDS_SQL = f"SELECT unnest({sql_words('lower(text)')}) AS word FROM documents"


@query("top_words", f"SELECT word, count(*) AS n FROM ({_WORDS_SQL}) GROUP BY word ORDER BY n DESC, word LIMIT 10")
def top_words(spark, sf):
    return profiling.top_words(table(spark, sf, "documents"))


@query("vocabulary_size", f"SELECT count(DISTINCT word) AS distinct_words, count(*) AS total_words FROM ({_WORDS_SQL})")
def vocabulary_size(spark, sf):
    return profiling.vocabulary_size(table(spark, sf, "documents"))


_CLEAN_SQL = f"SELECT doc_id, {sql_words(sql_basic_clean('text'))} AS words FROM documents"
_TOKENS_SQL = f"""SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM ({_CLEAN_SQL})"""
_TOKEN_COUNTS_SQL = f"""SELECT token, count(*) AS n, min(doc_id * 2147483648 + pos) AS first FROM ({_TOKENS_SQL})
GROUP BY token"""


def _vocab_top_sql(size: int) -> str:
    return f"""SELECT token, n, row_number() OVER (ORDER BY n DESC, first) + 1 AS id FROM ({_TOKEN_COUNTS_SQL})
QUALIFY id <= {size} + 1"""


def _cleaned(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.basic_clean(F.col("text")).alias("text"))


@query("vocab_top", _vocab_top_sql(20000))
def vocab_top(spark, sf):
    return features.vocabulary_top(_cleaned(spark, sf), "doc_id")


@query(
    "vocabulary",
    f"SELECT token, n, row_number() OVER (ORDER BY first) + 1 AS id FROM ({_TOKEN_COUNTS_SQL}) WHERE n >= 2",
)
def vocabulary(spark, sf):
    return features.vocabulary_all(_cleaned(spark, sf), "doc_id", min_freq=2)


_IDS_SQL = f"""
WITH vocab AS ({_vocab_top_sql(20000)}),
ids AS (SELECT t.doc_id, list(coalesce(v.id, 1) ORDER BY t.pos) AS ids FROM ({_TOKENS_SQL}) t
        LEFT JOIN vocab v USING (token) WHERE t.pos <= 128 GROUP BY t.doc_id)
SELECT d.doc_id, list_resize(coalesce(ids, []), 128, 0) AS ids FROM documents d LEFT JOIN ids USING (doc_id)"""


def _encoded(spark, sf):
    docs = _cleaned(spark, sf)
    return features.encode_padded(docs, "doc_id", features.vocabulary_top(docs, "doc_id"))


@query("encoded_docs", f"SELECT doc_id, array_to_string(ids, ' ') AS ids FROM ({_IDS_SQL})")
def encoded_docs(spark, sf):
    ids = F.col("ids").cast("array<string>")
    return _encoded(spark, sf).select("doc_id", F.array_join(ids, " ").alias("ids"))


# Every fifth document is left out of the fit, so that some words are unknown.
_TRAIN_SQL = "doc_id % 5 <> 0"
_ALL_IDS_SQL = f"""
WITH toks AS MATERIALIZED ({_TOKENS_SQL}),
vocab AS (SELECT token, row_number() OVER (ORDER BY first) + 1 AS id
          FROM (SELECT token, min(doc_id * 2147483648::HUGEINT + pos) AS first FROM toks WHERE {_TRAIN_SQL} GROUP BY token)),
ids AS (SELECT t.doc_id, list(coalesce(v.id, 1) ORDER BY t.pos) AS ids FROM toks t
        LEFT JOIN vocab v USING (token) WHERE t.pos <= 256 GROUP BY t.doc_id)
SELECT d.doc_id, array_to_string(list_resize(coalesce(ids, []), 256, 0), ' ') AS ids FROM documents d LEFT JOIN ids USING (doc_id)"""


@query("encoded_docs_all", _ALL_IDS_SQL)
def encoded_docs_all(spark, sf):
    """256 ids of a vocabulary that has every word of the training documents."""
    docs = _cleaned(spark, sf)
    vocabulary = stage(features.vocabulary_all(docs.filter(_TRAIN_SQL), "doc_id"))
    encoded = features.encode_joined(docs, "doc_id", vocabulary, max_len=V.LONG_SEQUENCE)
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "attention_mask",
    f"""SELECT doc_id, array_to_string(list_transform(ids, lambda i: CASE WHEN i = 0 THEN 0 ELSE 1 END), ' ') AS mask
    FROM ({_IDS_SQL})""",
)
def attention_mask(spark, sf):
    mask = features.attention_mask(F.col("ids")).cast("array<string>")
    return _encoded(spark, sf).select("doc_id", F.array_join(mask, " ").alias("mask"))


# --- TF-IDF -------------------------------------------------------------------
_STOP_WORDS = ("and", "the", "of", "that", "is", "die", "der", "und", "le", "la", "de", "que")


_CLEAN_TEXT_SQL = f"SELECT doc_id, {sql_basic_clean('text')} AS text FROM documents"


def _tfidf_sql(min_chars: int, min_df: int, max_features: int, stop_words=(), fitted: str = "true") -> str:
    """``fitted`` says on which documents the terms are chosen; all are transformed."""
    tokens = f"regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{{min_chars},}}')"
    if stop_words:
        listed = ", ".join(f"'{w}'" for w in stop_words)
        tokens = f"list_filter({tokens}, lambda t: t NOT IN ({listed}))"
    return f"""
WITH toks AS MATERIALIZED (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
                           FROM (SELECT doc_id, {tokens} AS t FROM ({_CLEAN_TEXT_SQL}))),
terms AS (SELECT doc_id, tok AS term FROM toks UNION ALL
          SELECT doc_id, tok || ' ' || nxt FROM (SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos)
          AS nxt FROM toks) WHERE nxt IS NOT NULL),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
fit AS MATERIALIZED (SELECT doc_id FROM documents WHERE {fitted}),
top AS MATERIALIZED (SELECT term, count(*) AS df, sum(tf) AS total FROM tf JOIN fit USING (doc_id) GROUP BY term HAVING count(*) >= {min_df}
        ORDER BY total DESC, term LIMIT {max_features}),
idf AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS feature,
        ln((1 + (SELECT count(*) FROM fit))::DOUBLE / (1 + df)) + 1 AS idf FROM top),
raw AS (SELECT doc_id, term, feature, tf * idf AS w FROM tf JOIN idf USING (term))
SELECT doc_id, term, feature, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""


@query("tfidf_terms", _tfidf_sql(2, 1, 10_000))
def tfidf_terms(spark, sf):
    """The plain preset on cleaned text: tokens of two characters and more, 10,000 features."""
    docs = _cleaned(spark, sf)
    return rounded(features.fit_tfidf(docs, **V.TFIDF_PLAIN).transform_long(docs, "doc_id"))


@query("tfidf_terms_stop_words", _tfidf_sql(1, 5, 50_000, _STOP_WORDS))
def tfidf_terms_stop_words(spark, sf):
    """The full preset with a given stop-word list."""
    docs = _cleaned(spark, sf)
    return rounded(features.fit_tfidf(docs, stop_words=_STOP_WORDS, **V.TFIDF_FULL).transform_long(docs, "doc_id"))


@query("tfidf_unseen", _tfidf_sql(2, 1, 10_000, fitted="lang <> 'es'"))
def tfidf_unseen(spark, sf):
    """Fitted without one language, then applied to all documents: that one brings unseen terms."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", tx.basic_clean(F.col("text")).alias("text"))
    model = features.fit_tfidf(docs.filter("lang <> 'es'"), **V.TFIDF_PLAIN)
    return rounded(model.transform_long(docs, "doc_id"))
