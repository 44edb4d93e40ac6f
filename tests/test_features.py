import math
import re
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketgrain.operators import features

DOCS = [
    (1, "the printer is down again"),
    (2, "Down DOWN the printer, a café ½ _x"),
    (3, ""),
    (4, "a b c"),
    (5, None),
]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string")


def slow_tfidf(docs, min_chars, min_df, max_features, stop=()):
    def terms(text):
        tokens = [t for t in re.findall(r"\w+", (text or "").lower()) if len(t) >= min_chars and t not in stop]
        return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]

    tf = {i: Counter(terms(t)) for i, t in docs}
    df, total = Counter(), Counter()
    for counts in tf.values():
        total.update(counts)
        df.update(counts.keys())
    kept = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:max_features]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, counts in tf.items():
        raw = {t: n * idf[t] for t, n in counts.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.update({(i, t): w / norm for t, w in raw.items()})
    return out, sorted(kept)


@pytest.mark.parametrize(
    "options",
    [
        {"min_token_chars": 1, "min_df": 1, "max_features": 100},
        {"min_token_chars": 2, "min_df": 2, "max_features": 100},
        {"min_token_chars": 1, "min_df": 1, "max_features": 4, "stop_words": ("the", "is", "a")},
    ],
)
def test_tfidf_equals_formula_in_long_and_vector_form(spark, docs, options):
    expected, kept = slow_tfidf(
        DOCS, options["min_token_chars"], options["min_df"], options["max_features"], options.get("stop_words", ())
    )
    model = features.fit_tfidf(docs, **{"use_stop_words": False} | options)
    assert [r["term"] for r in model.terms.orderBy("feature").collect()] == kept
    long = {(r["id"], r["term"]): r["weight"] for r in model.transform_long(docs, "id").collect()}
    assert long.keys() == expected.keys()
    assert all(long[k] == pytest.approx(expected[k], abs=1e-12) for k in expected)
    vectors = model.to_pipeline().transform(docs).select("id", vector_to_array("features").alias("v")).collect()
    for row in vectors:
        for j, term in enumerate(kept):
            assert row["v"][j] == pytest.approx(expected.get((row["id"], term), 0.0), abs=1e-12)


def test_unseen_terms_are_ignored(spark, docs):
    model = features.fit_tfidf(docs, min_df=1)
    new = spark.createDataFrame([(9, "printer zzz"), (10, "zzz")], "id long, text string")
    assert {r["term"] for r in model.transform_long(new, "id").collect()} == {"printer"}


def test_vocabulary_ties_follow_first_occurrence(spark):
    data = spark.createDataFrame([(2, "b a a"), (1, "c b"), (3, "d c")], "id long, text string")
    # counts: a 2, b 2, c 2, d 1; first seen: c (1,0), b (1,1), a (2,1), d (3,0)
    assert rows(features.vocabulary_top(data, "id", size=3), "id", "token") == [(2, "c"), (3, "b"), (4, "a")]
    assert rows(features.vocabulary_all(data, "id"), "id", "token") == [(2, "c"), (3, "b"), (4, "a"), (5, "d")]
    assert rows(features.vocabulary_all(data, "id", min_freq=2), "id", "token") == [(2, "c"), (3, "b"), (4, "a")]


def test_encode_and_pad(spark):
    data = spark.createDataFrame([(1, "x y z w"), (2, ""), (3, None), (4, "q x")], "id long, text string")
    vocab = spark.createDataFrame([("x", 2), ("y", 3)], "token string, id long")
    got = {r["id"]: r["ids"] for r in features.encode_padded(data, "id", vocab, max_len=3).collect()}
    assert got == {1: [2, 3, 1], 2: [0, 0, 0], 3: [0, 0, 0], 4: [1, 2, 0]}
    masked = features.encode_padded(data, "id", vocab, max_len=3)
    masks = {r[0]: r[1] for r in masked.select("id", features.attention_mask(F.col("ids"))).collect()}
    assert masks[4] == [1, 1, 0]


def test_label_index_is_alphabetical_and_fixed(spark):
    train = spark.createDataFrame([("medium",), ("high",), ("low",), (None,)], "priority string")
    index = features.label_index(train, "priority")
    assert rows(index, "label", "id") == [("high", 0), ("low", 1), ("medium", 2)]
    # a split without one class keeps the ids of the training split
    other = spark.createDataFrame([("medium",), ("high",)], "priority string")
    assert rows(features.encode_labels(other, "priority", index), "priority", "label_id") == [("high", 0), ("medium", 2)]


def test_joined_encoding_equals_the_lookup(spark):
    """The way for vocabularies of any size gives the ids of the small one; odd rows keep their rows."""
    texts = [(1, "a b a c"), (1, "a b a c"), (None, "b zz"), (None, None), (2, ""), (3, " ".join(f"w{i % 50}" for i in range(400)))]
    docs = spark.createDataFrame(texts, "id long, text string").repartition(3)
    vocabulary = features.vocabulary_all(docs.filter("text not like '%zz%'"), "id")
    for length in (3, 128, 256):
        found = features.encode_joined(docs, "id", vocabulary, max_len=length)
        wanted = features.encode_padded(docs, "id", vocabulary, max_len=length)
        assert rows(found) == rows(wanted) and found.schema["ids"].dataType == wanted.schema["ids"].dataType
    assert features.encode_joined(docs.limit(0), "id", vocabulary).count() == 0


def test_encoding_takes_a_vocabulary_beyond_the_lookup(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"common t{i} t{i + 1}") for i in range(40)], "id long, text string")
    vocabulary = features.vocabulary_all(docs, "id")
    wanted = rows(features.encode_padded(docs, "id", vocabulary, max_len=5))
    monkeypatch.setattr(features.V, "VOCABULARY_SIZE", 10)
    assert rows(features.encode_padded(docs, "id", vocabulary, max_len=5)) == wanted
