"""SQL that the queries must equal, where SQL can say it (document ids are unique in the driver tables)."""

from __future__ import annotations

from ticketgrain.llm import importance_resampling, lexical_search, line_dedup, quality_rules

_BLANK = r"[\x20\x09-\x0D]+"


def _words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{_BLANK}'), lambda x: x <> '')"


def quality_sql() -> str:
    langs = ", ".join(f"'{lang}'" for lang in sorted(quality_rules.COMMON_WORDS))
    bins = ", ".join(f"({i}, '{w}')" for i, w in enumerate(quality_rules.WORD_BINS))
    others = len(quality_rules.WORD_BINS)
    return rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: {_words("l")} <> []) AS ls
  FROM documents),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n
  FROM (SELECT rid, i, ws[i:i + {quality_rules.GRAM - 1}] AS g FROM w, unnest(range(1, len(ws) - {quality_rules.GRAM - 2})) AS r(i))),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM g, range({quality_rules.GRAM}) AS r(k) WHERE n > 1 GROUP BY rid),
c AS MATERIALIZED (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    [up, digit, n_chars - up - digit - wide - blank - low, wide, blank, low] AS classes
  FROM (SELECT rid, doc_id, lang, len(ws) AS n_words, length(t) AS n_chars, length(array_to_string(ws, '')) AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS up,
      length(regexp_replace(t, '[^0-9]+', '', 'g')) AS digit, length(regexp_replace(t, '[\x00-\x7F]+', '', 'g')) AS wide,
      length(t) - length(array_to_string(ws, '')) AS blank, length(regexp_replace(t, '[^a-z]+', '', 'g')) AS low
    FROM w LEFT JOIN rep USING (rid))),
bins(bin, word) AS (VALUES {bins}),
found AS (SELECT rid, bin, count(*) AS n FROM (SELECT rid, unnest(ws) AS x FROM w) JOIN bins ON lower(x) = word GROUP BY ALL),
hist AS MATERIALIZED (
  SELECT rid, 'class' AS kind, i AS bin, classes[i + 1] AS n, n_chars AS total FROM c, range(6) AS r(i)
  UNION ALL SELECT rid, 'word', bin, coalesce(n, 0), n_words FROM c CROSS JOIN bins LEFT JOIN found USING (rid, bin)
  UNION ALL SELECT rid, 'word', {others}, n_words - coalesce(s, 0), n_words
    FROM c LEFT JOIN (SELECT rid, sum(n) AS s FROM found GROUP BY rid) USING (rid)),
ref AS (
  SELECT lang, kind, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang, kind) AS q FROM hist JOIN c USING (rid)
  WHERE NOT base_failed AND lang IN ({langs}) GROUP BY lang, kind, bin),
dist AS (
  SELECT rid, kind, min(x) AS x FROM (
    SELECT rid, kind, lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS x
    FROM (SELECT rid, kind, bin, n / total AS p FROM hist WHERE total > 0) JOIN ref USING (kind, bin) GROUP BY ALL)
  GROUP BY ALL),
near AS (
  SELECT c.*, CASE WHEN (lang IS NULL OR lang IN ({langs})) AND n_chars >= {quality_rules.MIN_CHARS} THEN a.x END AS by_class,
    CASE WHEN (lang IS NULL OR lang IN ({langs})) AND n_words >= {quality_rules.MIN_COMMON_WORDS} THEN b.x END AS by_word
  FROM c LEFT JOIN dist a ON a.rid = c.rid AND a.kind = 'class' LEFT JOIN dist b ON b.rid = c.rid AND b.kind = 'word')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(by_class, 6) AS class_distance,
  round(by_word, 6) AS word_distance, NOT base_failed AND coalesce(by_class, 0) <= {quality_rules.MAX_CLASS_DISTANCE}
    AND coalesce(by_word, 0) <= {quality_rules.MAX_WORD_DISTANCE} AS kept
FROM near"""


def line_dedup_sql() -> str:
    least = line_dedup.MIN_WORDS
    return f"""
WITH l AS MATERIALIZED (
  SELECT doc_id, p, line, {_words("line")} AS ws
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents)),
u AS MATERIALIZED (
  SELECT doc_id, p, row_number() OVER o AS i, len(ws) AS n, array_to_string(ws, ' ') AS x, sum(len(ws)) OVER o AS upto
  FROM l WHERE len(ws) > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
runs AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {least - 1}
  WHERE b.upto - a.upto + a.n >= {least} GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i), b.i FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {least - 1}
  WHERE b.upto - a.upto + a.n >= {least} GROUP BY b.doc_id, b.i),
texts AS (SELECT r.doc_id, s, e, string_agg(x, chr(10) ORDER BY i) AS content
  FROM runs r JOIN u ON u.doc_id = r.doc_id AND u.i BETWEEN s AND e GROUP BY ALL),
later AS (SELECT * FROM texts QUALIFY (doc_id, s) <> min((doc_id, s)) OVER (PARTITION BY content)),
gone AS MATERIALIZED (
  SELECT DISTINCT u.doc_id, i, p, n FROM later r JOIN u ON u.doc_id = r.doc_id AND u.i BETWEEN s AND e),
between_gone AS (SELECT DISTINCT l.doc_id, l.p FROM l JOIN gone a ON a.doc_id = l.doc_id AND a.p <= l.p
  LEFT JOIN gone b ON b.doc_id = a.doc_id AND b.i = a.i + 1 WHERE l.p = a.p OR l.p < b.p)
SELECT doc_id, count(*) AS n_lines, count(d.p) AS n_removed_lines, coalesce(sum(n) FILTER (d.p IS NOT NULL), 0)::BIGINT AS n_removed_words,
  coalesce(string_agg(line, chr(10) ORDER BY l.p) FILTER (d.p IS NULL), '') AS text
FROM (SELECT doc_id, p, line, len(ws) AS n FROM l) l LEFT JOIN between_gone d USING (doc_id, p) GROUP BY doc_id"""


def _lower(expr: str) -> str:
    return f"translate(coalesce({expr}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def search_sql() -> str:
    terms = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_lower("text"))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {terms} AS ws FROM documents),
q AS MATERIALIZED (
  SELECT qid, item_id, term, count(*) AS k
  FROM (SELECT qid, item_id, unnest(ws) AS term FROM (SELECT row_number() OVER () AS qid, item_id, {terms} AS ws FROM benchmark))
  GROUP BY ALL),
g AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d),
p AS MATERIALIZED (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 75 + (25 * len(ws) * n_docs) // n_terms AS m FROM d, g WHERE len(ws) > 0),
s AS (
  SELECT qid, item_id, rid, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM p JOIN w USING (term) JOIN m USING (rid) JOIN q USING (term) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {lexical_search.TOP}"""


def resampling_sql() -> str:
    """CRC-32 by its table, over the bytes of each distinct word."""
    r = importance_resampling
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_lower("text"))
    table = (
        "(SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) "
        "ORDER BY i) FROM range(256) AS t(i))"
    )
    data = "list_transform(range(len(hex(encode(word)))::BIGINT // 2), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)"
    crc = f"xor(list_reduce({data}, lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"
    return f"""
WITH tab AS MATERIALIZED (SELECT {table} AS tab),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
dw AS MATERIALIZED (SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(ws) AS word FROM d) GROUP BY ALL),
bw AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY ALL),
b AS MATERIALIZED (
  SELECT word, {crc} % {r.BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)), tab),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dw JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bw JOIN b USING (word) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::BIGINT AS s_all, coalesce((SELECT sum(t) FROM t), 0)::BIGINT AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + {r.BUCKETS})
    / ((coalesce(s, 0) + 1) * (t_all + {r.BUCKETS}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), sums),
w AS (SELECT rid, sum(n * gain)::BIGINT AS weight FROM dw JOIN b USING (word) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('{r.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (rid)),
places AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored
  WHERE n_features >= {r.MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {r.DRAW_PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN places USING (rid)"""


ORACLES = {
    "op6_quality_rules": quality_sql(), "op10_line_dedup": line_dedup_sql(), "op11_lexical_search": search_sql(),
    "op12_importance_resampling": resampling_sql(),
}
