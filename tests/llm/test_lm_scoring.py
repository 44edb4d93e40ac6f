import math
import zlib
from collections import Counter

import numpy as np

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.lm_scoring import (
    Pairs, build_lookup, log_probabilities, model_size, normalisers, pair_counts, score_documents, train, with_fold, word_class, word_counts,
)


def tokens(text):
    return (text or "").encode().lower().split()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_rows(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update([*tokens(text), b""])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        words = [*tokens(text), b""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.append((doc_id, held_out(doc_id), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    return Counter(out), counts


def base_columns(df):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_base_whole_table(spark):
    assert base_columns(queries.op4_lm_scores(spark, SF)) == base_rows(odd.sf_texts(spark, SF))[0]


def test_base_odd_rows(spark):
    docs = odd.table(spark)
    assert base_columns(score_documents(docs)) == base_rows(odd.ROWS)[0]
    # few words at the tasks: the join finds the rest; none at all: it finds everything
    for head, model in ((6, 3), (0, 0)):
        assert base_columns(score_documents(docs, head, model)) == base_rows(odd.ROWS)[0]
    assert score_documents(odd.empty(spark)).count() == 0
    only = next(i for i in range(100) if held_out(i))
    assert base_columns(score_documents(odd.table(spark, [(only, "unseen words")]))) == base_rows([(only, "unseen words")])[0]


def pairs_of(counts):
    at = np.flatnonzero(counts)
    return Pairs(*counts.shape, at, counts.ravel()[at])


def log_table(model, batch=256):
    """log10 probabilities of all symbols (columns) after all contexts."""
    shape = len(model[0]), len(model[1])
    contexts, symbols = (x.ravel() for x in np.indices(shape))
    return log_probabilities(model, normalisers(model, batch), contexts, symbols).reshape(shape)


def test_rows_are_probabilities():
    rng = np.random.default_rng(1)
    counts = rng.poisson(3, (12, 11)) * rng.integers(0, 2, (12, 11))
    table = log_table(train(pairs_of(counts), rounds=20), batch=5)
    assert table.shape == (12, 11) and np.allclose((10.0**table).sum(axis=1), 1, atol=1e-5)


def test_training_finds_the_pairs():
    """With enough rounds the conditional frequencies come out."""
    counts = np.array([[900, 50, 50], [50, 900, 50], [200, 100, 700]])
    table = 10.0 ** log_table(train(pairs_of(counts), dimensions=4, rounds=600))
    assert np.abs(table - counts / counts.sum(axis=1, keepdims=True)).max() < 0.03


def test_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    pairs = pairs_of(rng.poisson(2, (12, 11)))
    whole = log_table(train(pairs, rounds=20))
    monkeypatch.setattr("ticketgrain.llm.lm_scoring._CELLS", 30)
    assert len(list(pairs.blocks())) == 6
    assert np.allclose(whole, log_table(train(pairs, rounds=20)), atol=1e-3)


def model_words(spark, counts):
    words = spark.createDataFrame([(w.encode(), c) for w, c in counts.items()], "word binary, c long")
    lookup = build_lookup(words)
    return int((lookup.log_class[: len(lookup.index)] == 0).sum())


def test_model_grows_with_the_words(spark):
    """Copies of one text (many words of equal counts) fill the model like any other words."""
    sizes = []
    for distinct in (1_000, 8_000, 64_000):
        counts = {f"w{i}": 1 + 100_000 // (i + 1) for i in range(distinct)}
        sizes.append(model_words(spark, counts))
        assert 0.95 * model_size(distinct) <= sizes[-1] <= model_size(distinct)
    assert sizes[0] < 0.6 * sizes[1] < 0.36 * sizes[2]
    counts.update({f"copy{i}": 5_000_000 for i in range(1_200)})
    assert 0.95 * model_size(len(counts)) <= model_words(spark, counts) <= model_size(len(counts))
    counts.update({f"copy{i}": 5_000_000 for i in range(1_200, 3_000)})
    assert 0.95 * model_size(len(counts)) <= model_words(spark, counts) <= model_size(len(counts))


def test_score_is_the_models(spark):
    """Scores from the tables, word by word, and open-vocabulary sums to one."""
    rows = odd.sf_texts(spark, SF)
    docs = odd.table(spark, rows)
    training = with_fold(docs, "doc_id", "text").filter("not held_out")
    words = word_counts(training)
    lookup = build_lookup(words, 200, 40)
    pairs = pair_counts(training, lookup)
    counts = base_rows(rows)[1]
    assert pairs.n.sum() == sum(counts.values()) and (np.diff(pairs.at) > 0).all()
    table = log_table(train(pairs)).astype(float)
    in_model = {w: int(lookup.symbol[i]) for w, i in lookup.index.items() if lookup.log_class[i] == 0}
    models = len(in_model)
    share = Counter()
    for w, c in counts.items():
        if w and w not in in_model:
            share[word_class(w)] += c + 1
    found = {r.doc_id: r.score for r in score_documents(docs, 200, 40).collect()}
    for doc_id, text in rows[:60]:
        context, wanted = lookup.symbols, 0.0
        for w in [*tokens(text), b""]:
            symbol = lookup.end if not w else in_model.get(w, models + word_class(w))
            wanted += table[context, symbol]
            if w and w not in in_model:
                wanted += math.log10((counts[w] + 1) / (share[word_class(w)] + 1))
            context = symbol
        assert abs(found[doc_id] - wanted) < 1e-3 + 1e-6 * abs(wanted)


def test_better_than_base(spark):
    rows = queries.op4_lm_scores(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.7 * len(held)
