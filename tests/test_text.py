"""Text functions against plain-Python models written from their description."""

import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketgrain.functions import extraction, prompts, routing
from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx

PIECES = [
    "http://a.b/c?d=e", "https://Ä.x", "HTTPS://X~Y", "www.site.org", "www.", "me@x.y", "@a@b", "@@a", "a@", "@", "@@@",
    "é", "İ", "Straße", "\n", "\n \n", "\n\t\n\n", "  ", "\t", " ", "\x1c", "\x85", " ", " ", "!", "~", "^_", "a-b",
    "Word", "42", "Type: X", "Queue: IT Support ", "Priority: HIGH", "Response:", "漢字", "x" * 40, "​", "½", "",
]
fragments = st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=12).map("".join)
batches = st.lists(fragments.filter(lambda t: not re.search("[\ud800-\udfff]", t)), min_size=20, max_size=60)
spark_property = settings(
    max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)


def apply(spark, texts, fn):
    data = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    return [r[0] for r in data.select("i", fn(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


def model_basic(text, keep=False):
    text = text.lower()
    if keep:
        text = re.sub(r"(http|www)\S+", "", text)
        return " ".join(re.sub(r"\S+@\S+", "", text).split())
    for head in ("https?://", r"www\."):
        text = re.sub(head + "[a-z0-9!$-_]+", "", text)
    text = re.sub(r"\S+@\S+", "", text)
    return " ".join("".join(c for c in text if c.isspace() or c in "abcdefghijklmnopqrstuvwxyz0123456789").split())


def model_layout(text):
    return re.sub(" {2,}", " ", re.sub(r"\n\s*\n", "\n\n", text)).strip()


@spark_property
@given(batches)
def test_cleaning_equals_model(spark, texts):
    assert apply(spark, texts, tx.basic_clean) == [model_basic(t) for t in texts]
    assert apply(spark, texts, lambda c: tx.basic_clean(c, True)) == [model_basic(t, True) for t in texts]
    assert apply(spark, texts, tx.clean_text) == [model_layout(t) for t in texts]
    assert apply(spark, texts, tx.strip) == [t.strip() for t in texts]


@spark_property
@given(batches)
def test_measures_equal_model(spark, texts):
    assert apply(spark, texts, tx.words) == [t.split() for t in texts]
    assert apply(spark, texts, tx.word_count) == [len(t.split()) for t in texts]
    assert apply(spark, texts, tx.char_count) == [len(t) for t in texts]
    assert apply(spark, texts, tx.is_blank) == [not t.strip() for t in texts]
    assert apply(spark, texts, tx.rouge_words) == [re.findall("[a-z0-9]+", t.lower()) for t in texts]
    assert apply(spark, texts, lambda c: tx.preview(c, 5)) == [t[:5] for t in texts]


@spark_property
@given(batches)
def test_extraction_equals_model(spark, texts):
    def field(pattern, text):
        found = re.search(pattern, text, re.I)
        return found.group(1) if found else None

    def response(text):
        found = re.search(r"Response:\s*(.+)", text, re.I | re.S)
        return (found.group(1) if found else text).strip()

    got = apply(spark, texts, extraction.extract_classification)
    for text, row in zip(texts, got):
        queue, priority = field(r"queue:\s*([^\n]+)", text), field(r"priority:\s*(\w+)", text)
        assert row["type"] == field(r"type:\s*(\w+)", text)
        assert row["queue"] == (queue.strip() if queue is not None else None)
        assert row["priority"] == (priority.lower() if priority else None)
    assert apply(spark, texts, extraction.extract_response) == [response(t) for t in texts]


def test_null_texts(spark):
    assert apply(spark, [None], tx.basic_clean) == [""]
    assert apply(spark, [None], tx.clean_text) == [""]
    assert apply(spark, [None], tx.words) == [[]]
    assert apply(spark, [None], tx.is_blank) == [True]


def test_one_very_long_run_is_linear(spark):
    texts = ["x" * 400_000, "http://" + "y" * 300_000, "z" * 200_000 + "@", "a@" * 100_000]
    assert apply(spark, texts, tx.basic_clean) == ["x" * 400_000, "", "z" * 200_000, ""]


def test_ticket_text_keeps_separator(spark):
    data = spark.createDataFrame([("s", "b"), (None, "b"), ("s", None), (None, None)], "s string, b string")
    got = [r[0] for r in data.select(tx.ticket_text(F.col("s"), F.col("b"))).collect()]
    assert got == ["s\n\nb", "\n\nb", "s\n\n", "\n\n"]


def test_tags(spark):
    data = spark.createDataFrame([("a", "", None), (None, "", ""), ("x", "y", "z")], "t1 string, t2 string, t3 string")
    got = [r[0] for r in data.select(tx.format_tags([F.col(c) for c in data.columns])).collect()]
    assert got == ["a", "None", "x, y, z"]


def test_ngrams(spark):
    data = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = data.select(*[tx.ngrams(F.col("t"), n).alias(str(n)) for n in (1, 2, 3, 4)]).collect()
    assert [list(r) for r in got] == [
        [["a", "b", "c"], ["a b", "b c"], ["a b c"], []],
        [["a"], [], [], []],
        [[], [], [], []],
    ]


def test_one_line_layout_lets_queue_take_the_rest(spark):
    (row,) = apply(spark, ["Type: Incident | Queue: Sales | Priority: Low"], extraction.extract_classification)
    assert tuple(row) == ("Incident", "Sales | Priority: Low", "low")


def test_routing_substrings_and_order(spark):
    cases = [
        ("Please", "download fails", ("Request", "Technical Support", "high")),  # 'down' inside 'download'
        ("Question", "is the product slow", ("Problem", "Product Support", "low")),
        ("URGENT question", "billing error for product", ("Incident", "Billing and Payments", "high")),
        ("Hello", "new feature", ("Change", "Product Support", "medium")),
        ("Hello", "my login", ("Request", "Customer Service", "medium")),
    ]
    data = spark.createDataFrame([(s, b) for s, b, _ in cases], "s string, b string")
    routed = data.select(routing.classify_ticket(F.col("s"), F.col("b")).alias("c")).select("c.*").collect()
    assert [tuple(r)[:3] for r in routed] == [expected for *_, expected in cases]
    assert {r["confidence"] for r in routed} == {0.85}


def test_reply_uses_template_and_short_subject(spark):
    subject = "s" * 80
    data = spark.createDataFrame([(subject, "high"), (subject, "low"), (subject, "other")], "s string, p string")
    got = [r[0] for r in data.select(routing.suggest_reply(F.col("s"), F.col("p"))).collect()]
    for reply, name in zip(got, ("high", "low", "medium")):
        assert reply == V.REPLY_TEMPLATES[name].format(subject="s" * 50)


def test_prompts(spark):
    data = spark.createDataFrame([("do", "this")], "i string, u string")
    chat, plain = data.select(
        prompts.build_prompt(F.col("i"), F.col("u")), prompts.build_prompt(F.col("i"), F.col("u"), "other")
    ).first()
    assert chat == "<|im_start|>system\ndo<|im_end|>\n<|im_start|>user\nthis<|im_end|>\n<|im_start|>assistant\n"
    assert plain.endswith("### Instruction:\ndo\n\n### Input:\nthis\n\n### Response:\n")


def test_cleaning_random_mix(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(15))) for _ in range(2000)]
    assert apply(spark, texts, tx.basic_clean) == [model_basic(t) for t in texts]
