import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import lexical_search, queries
from ticketgrain.llm.lexical_search import Best, Block, item_blocks, search, search_block


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top=20):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    words = [words_of(t) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    held = Counter(w for ws in words for w in set(ws))
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, doc), ws in zip(docs, words, strict=True):
            tf, score = Counter(ws), 0
            m = 75 + 25 * len(ws) * n_docs // max(1, n_terms)
            for t in words_of(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0, doc or ""))
        for rank, (score, known, doc_id, _) in enumerate(sorted(found)[:top], 1):
            out.append((item_id, rank, doc_id if known else None, -score))
    return Counter(out)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, rank string, place string")


def check(spark, docs, items, **options):
    found = search(odd.table(spark, docs), items_table(spark, [(i, t, "?", "?") for i, t in items]), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert odd.bag(found) == brute(docs, items, options.get("top", 20))
    return found


ITEMS = [
    (1, "river HILL words again, again"), (2, None), (3, ""), (None, "the text"), (1, "river HILL words again, again"),
    (4, "nothing-of-this zzzz"), (5, "Ünïcödé 漢字 don't 1234 x"), (6, " ".join(f"w{i}" for i in range(200)) + " plain text"),
]


def test_odd_tables(spark):
    check(spark, odd.ROWS, ITEMS)
    check(spark, odd.ROWS, ITEMS, top=2)
    empty = odd.empty(spark)
    assert search(empty, items_table(spark, [(1, "a", "?", "?")])).count() == 0
    assert search(odd.table(spark), items_table(spark, [])).count() == 0
    assert search(odd.table(spark, [(1, None), (2, " ")]), items_table(spark, [(1, "a", "?", "?")])).count() == 0


@pytest.mark.parametrize("block", [3, 4096])
def test_ties_and_many_terms(spark, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCUMENTS", block)
    rng = random.Random(block)
    names = [f"t{i}" for i in range(90)]
    docs = [(i, " ".join(rng.choices(names, k=rng.randint(0, 12)))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(300, 400)]  # a group of copies, all of one score
    items = [(0, " ".join(names)), (1, docs[7][1]), (2, "t1 t1 t2 t3"), (3, "t5")]
    check(spark, docs, items)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 2)
    items = items_table(spark, [(i, "river", "?", "?") for i in range(5)])
    assert [len(b) for b in item_blocks(items, "item_id", "text")] == [2, 2, 1]
    check(spark, odd.ROWS, ITEMS)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 4)
    assert [len(b) for b in item_blocks(items, "item_id", "text")] == [1] * 5


def test_groups_that_cannot_enter_are_left():
    """Masks are evaluated by descending bound, and only while they may still enter."""
    rng = np.random.default_rng(5)
    n, t = 4000, 12
    held = rng.random((n, t)) < np.linspace(0.02, 0.9, t)
    terms = [np.flatnonzero(row).astype(np.int32) for row in held]
    counts = [rng.integers(1, 4, len(x)).astype(np.int32) for x in terms]
    columns = [
        pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([len(x) + 3 for x in terms], pa.int64()),
        pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
    ]
    batch = pa.record_batch(columns, ["key", "tie", "n", "terms", "counts"])
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * held[:, j].sum() + 1))) for j in range(t)], np.int64)
    block, best = Block(batch, weights, n, sum(len(x) + 3 for x in terms)), Best(20)
    item = (np.arange(t), np.ones(t, np.int64))
    group, bounds = block.groups(*item)
    assert len(bounds) == len({row.tobytes() for row in held}) and (np.bincount(group) > 0).all()
    taken = search_block(block, item, np.zeros(t, np.int64), best)
    scores = np.array([block.gains[s : s + k].sum() for s, k in zip(block.starts, block.sizes, strict=True)])
    assert (bounds[group] >= scores).all()
    assert [tuple(r[:2]) for r in best.rows] == sorted(((s, k) for k, s in enumerate(scores)), key=lambda r: (-r[0], r[1]))[:20]
    assert taken < n / 4


def test_whole_table(spark):
    found = queries.op11_lexical_search(spark, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert odd.bag(found) == brute(odd.sf_texts(spark, SF), items)
