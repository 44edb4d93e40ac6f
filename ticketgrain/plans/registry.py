"""Registry of the queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketgrain.functions.fixed_values import WHITESPACE_CHARS, WHITESPACE_CLASS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


# The driver's tables of long texts are single files without splits.
_TEXT_KEYS = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"], "pages": ["page_id"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in _TEXT_KEYS and len(df.inputFiles()) == 1:
        return df.repartition(*_TEXT_KEYS[name])  # costly work per row: not all in one scan task
    return df


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so summation order cannot show."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def sql_rounded(sql: str, columns: str, digits: int = 6) -> str:
    """The same for an oracle; ``columns`` are the names, separated by blanks."""
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in columns.split())}) FROM ({sql})"


# --- SQL fragments for the oracles --------------------------------------------
def sql_strip(expr: str) -> str:
    chars = "||".join(f"chr({ord(c)})" for c in WHITESPACE_CHARS)
    return f"trim({expr}, {chars})"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WS = WHITESPACE_CLASS


def sql_words(expr: str) -> str:
    """Whitespace tokens as a list."""
    return f"list_filter(regexp_split_to_array({expr}, '[{WS}]+'), lambda t: t <> '')"


def sql_basic_clean(expr: str) -> str:
    out = f"lower(coalesce({expr}, ''))"
    for pattern in (
        "https?://[a-z0-9!$-_]+",
        r"www\.[a-z0-9!$-_]+",
        f"[^{WS}]+@[^{WS}]+",
        f"[^a-z0-9{WS}]",
    ):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return sql_strip(f"regexp_replace({out}, '[{WS}]+', ' ', 'g')")


def sql_clean_text(expr: str) -> str:
    out = f"regexp_replace(coalesce({expr}, ''), '\\n[{WS}]*\\n', chr(10) || chr(10), 'g')"
    return sql_strip(f"regexp_replace({out}, ' +', ' ', 'g')")


def sql_prompt(layout: str) -> str:
    """A prompt layout over the columns instruction and input."""
    head, rest = layout.split("{instruction}")
    middle, tail = rest.split("{input}")
    return f"{sql_text(head)} || instruction || {sql_text(middle)} || input || {sql_text(tail)}"
