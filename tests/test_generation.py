"""ROUGE, BLEU, stemming and subsequences against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketgrain.functions.lcs import lcs_length
from ticketgrain.functions.porter import stem
from ticketgrain.operators import generation as gen

# Examples printed in the paper, plus the irregular and short words.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "dying": "die", "news": "news", "is": "is", "died": "die", "spied": "spi", "enjoy": "enjoy",
}


@pytest.mark.parametrize("word", STEMS)
def test_stem(word):
    assert stem(word) == STEMS[word]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = previous + 1 if x == y else max(row[j], row[j - 1])
            previous = keep
    return row[-1]


def test_lcs_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice("abcde") for _ in range(rng.randrange(90))]
        b = [rng.choice("abcde") for _ in range(rng.randrange(90))]
        assert lcs_length(a, b) == slow_lcs(a, b)
    assert lcs_length([str(i % 50) for i in range(20_000)], [str(i % 50) for i in range(20_000)]) == 20_000


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def slow_scores(prediction, reference, stemmed):
    def rouge_tokens(text):
        cleaned = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower())
        return [stem(t) if stemmed and len(t) > 3 else t for t in cleaned.split()]

    def prf(hits, n_pred, n_ref):
        p, r = hits / max(n_pred, 1), hits / max(n_ref, 1)
        return p, r, (2 * p * r / (p + r) if p + r else 0.0)

    p, q = rouge_tokens(prediction), rouge_tokens(reference)
    out = {}
    for n in (1, 2):
        a, b = grams(p, n), grams(q, n)
        out[f"rouge{n}"] = prf(sum((a & b).values()), sum(a.values()), sum(b.values()))
    out["rougeL"] = prf(slow_lcs(p, q), len(p), len(q))

    hyp, ref = prediction.lower().split(), reference.lower().split()
    logs = 0.0
    for n in (1, 2, 3, 4):
        a, b = grams(hyp, n), grams(ref, n)
        hits, size = sum((a & b).values()), max(sum(a.values()), 1)
        if n == 1 and hits == 0:
            out["bleu"] = 0.0
            break
        logs += 0.25 * math.log((hits or 0.1) / size)
    else:
        brevity = 1.0 if len(hyp) > len(ref) else math.exp(1 - len(ref) / len(hyp))
        out["bleu"] = brevity * math.exp(logs)
    return out, len(hyp), len(ref)


def pair_texts():
    rng = random.Random(5)
    words = "the agent replied to running customers quickly Running, issue-42 and é relational".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(60)]
    edge = [("", ""), ("", "a b"), ("a", ""), ("a b c d e", "a b c d e"), ("x", "x"), ("!!", "??"), ("no", "yes")]
    return edge + list(zip(texts[:30], texts[30:]))


@pytest.mark.parametrize("stemmed", [True, False])
def test_scores_equal_brute_force(spark, stemmed):
    texts = pair_texts()
    pairs = spark.createDataFrame(
        [(i, p, q) for i, (p, q) in enumerate(texts)], "sample_id long, prediction string, reference string"
    )
    samples = gen.evaluate_samples(pairs, ["sample_id"], task="response_generation", use_stemmer=stemmed)
    got = {r["sample_id"]: r for r in samples.collect()}
    assert len(got) == len(texts)
    for i, (prediction, reference) in enumerate(texts):
        expected, n_pred, n_ref = slow_scores(prediction, reference, stemmed)
        for name in ("rouge1", "rouge2", "rougeL"):
            values = [got[i][f"{name}_{x}"] for x in "prf"]
            assert values == pytest.approx(expected[name], abs=1e-12), (name, prediction, reference)
        assert got[i]["bleu"] == pytest.approx(expected["bleu"], abs=1e-12)
        assert (got[i]["pred_length"], got[i]["ref_length"]) == (n_pred, n_ref)


def test_nothing_is_shuffled(spark):
    pairs = spark.createDataFrame([(1, "a b", "b c")], "k long, prediction string, reference string")
    plan = gen.overlap_scores(pairs, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 0


def test_multi_task_fields_and_aggregate(spark):
    text = "Type: {}\nQueue: {}\nPriority: {}\n\nResponse:\n{}"
    rows = [
        (1, text.format("Incident", "Sales", "HIGH", "thank you"), "Response: thank you", ("Incident", "Sales", "high")),
        (2, "just a reply", "just a reply", (None, None, "low")),
    ]
    schema = (
        "sample_id long, prediction string, reference string, "
        "expected struct<type: string, queue: string, priority: string>"
    )
    pairs = spark.createDataFrame(rows, schema)
    samples = gen.evaluate_samples(pairs, ["sample_id"])
    ok = {r["sample_id"]: tuple(r["classification_correct"]) for r in samples.collect()}
    assert ok == {1: (True, True, True), 2: (True, True, False)}  # two nulls agree
    total = gen.aggregate_samples(samples).first()
    assert total["avg_rougeL_f"] == 1.0 and total["std_rouge1_f"] == 0.0
    assert (total["type_accuracy"], total["priority_accuracy"], total["sample_count"]) == (1.0, 0.5, 2)


def test_bands_edges(spark):
    scores = spark.createDataFrame([(0.5,), (0.51,), (0.3,), (0.29,), (None,)], "rougeL_f double")
    got = {r["band"]: (r["n"], r["share"]) for r in gen.rouge_l_bands(scores).collect()}
    assert got == {"excellent": (1, 0.2), "good": (2, 0.4), "fair": (2, 0.4)}


def test_published_band_shares(spark):
    # 1354 / 1559 / 1327 of 4240
    value = F.when(F.col("id") < 1354, 0.6).when(F.col("id") < 2913, 0.4).otherwise(0.1)
    bands = gen.rouge_l_bands(spark.range(4240).select(value.alias("rougeL_f"))).collect()
    assert {r["band"]: round(r["share"] * 100, 1) for r in bands} == {"excellent": 31.9, "good": 36.8, "fair": 31.3}


def test_pairs_share_a_key(spark):
    predictions = spark.createDataFrame([(1, "a"), (2, "b")], "sample_id long, prediction string")
    references = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "sample_id long, reference string")
    assert gen.pair_by_key(predictions, references, ["sample_id"]).count() == 2
