"""Counts and ids are made inside tasks: what is shuffled grows with distinct words, and slices are bounded."""

import pyarrow as pa
from pyspark.sql import functions as F

from ticketgrain.functions import batches
from ticketgrain.functions import text as tx
from ticketgrain.operators import features


def test_terms_are_counted_before_the_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "red green red blue") for k in range(500)] + [(900, None)], "id long, text string").coalesce(1)
    tokens = features._kept_tokens(docs, "text", 2, ())
    found = {r.term: (r.df, r.tf) for r in features._term_counts(tokens).collect()}
    assert found == {
        "red": (500, 1000), "green": (500, 500), "blue": (500, 500),
        "red green": (500, 500), "green red": (500, 500), "red blue": (500, 500),
    }
    assert features._term_counts(tokens).count() == 6  # partial rows, not 3,500
    monkeypatch.setattr(features, "_COUNTED", 2)
    assert features.fit_tfidf(docs, min_df=1, max_features=2, min_token_chars=2, stop_words=()).terms.count() == 2


def test_tokens_are_counted_before_the_shuffle(spark):
    docs = spark.createDataFrame([(5, "b a"), (3, "a c a"), (None, "d a"), (4, None)], "id long, text string").coalesce(1)
    counts = features._token_counts(docs, "id", tx.words(F.col("text")))
    found = {r.token: (r.n, r.first and int(r.first)) for r in counts.collect()}
    assert found == {"a": (4, 3 * 2**31), "b": (1, 5 * 2**31), "c": (1, 3 * 2**31 + 1), "d": (1, None)}
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_rows_are_encoded_together(spark, monkeypatch):
    monkeypatch.setattr(features, "_BLOCK", 3)
    rows = [(k % 7, " ".join(f"w{j}" for j in range(k % 5))) for k in range(40)] + [(None, "w1 odd"), (1, None)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    words = spark.createDataFrame([(f"w{j}", j + 2) for j in range(4)], "token string, id long")
    joined = features.encode_joined(docs, "id", words, max_len=4)
    got = sorted(map(repr, ((r.id, r.ids) for r in joined.collect())))
    want = [(i, ([{"odd": 1}.get(w) or int(w[1:]) + 2 for w in (t or "").split()] + [0] * 4)[:4]) for i, t in rows]
    assert got == sorted(map(repr, want))
    assert "Generate" not in joined._jdf.queryExecution().executedPlan().toString()


def test_long_rows_are_unpacked_in_slices():
    tokens = pa.array([["word"] * 1000] * 300 + [[]] + [["long"] * 500_000])
    sizes = [len(rows) for (rows,) in batches.unpacked(tokens, size=100_000)]
    assert sum(sizes) == 302 and max(sizes) < 30
    assert [list(r) for (rows,) in batches.unpacked(tokens, size=100_000) for r in rows] == tokens.to_pylist()
    assert list(batches.unpacked(pa.array([], pa.list_(pa.string())))) == []
