"""Ranked lexical search: each item's best documents, by groups of documents that hold the same terms.

Two passes.  The first reads every whole text once and writes, for each document, its length and
the counts of those terms that some item asks for; from these come N, L and the document
frequencies.  The second takes blocks of documents: each term has a bitmap over the block, the
bitmaps of an item's terms laid side by side give every document its mask of matched terms, and
documents of equal masks are one group.  The largest score a mask can reach is the sum of its
terms' largest gains in the block.  Groups are evaluated by descending largest score until the next
one lies below the item's last place, which a task carries from block to block; equal scores are
still evaluated, since the smaller id wins.  Every task returns at most ``top`` rows an item.

The items are a stated query set.  They are taken in blocks of bounded size, each against all
documents, so what tasks get with their code is bounded whatever the number of items.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.llm.common import id_and_text, map_texts, order_id, staged

TOP = 20
# Documents of a block, fewer where so many terms are asked for that their bitmaps would take more bytes.
BLOCK_DOCUMENTS, BITMAP_BYTES = 4096, 32 * 1024 * 1024
# Items of one pass: at most so many, and so many bytes of text (or one item).
BLOCK_ITEMS, BLOCK_BYTES = 256, 2 * 1024 * 1024
# First documents evaluated of a block; each further step takes twice as many.
FIRST_STEP = 64
# Tasks' candidates are cut to the top in so many parts before one task sees an item's rest.
PARTS = 64
# Maximal runs of digits, letters and all that is not ASCII, on bytes with A-Z in lower case.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_POSTINGS = "doc_id long, key long, tie long, n long, terms array<int>, counts array<int>"


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: number of its terms, ids and counts of those in ``vocabulary``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, ids, counts = [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = terms_of(text)
            held = {vocabulary[w]: n for w, n in Counter(words).items() if w in vocabulary}
            lengths.append(len(words))
            ids.append(list(held))
            counts.append(list(held.values()))
        columns = [batch.column(c) for c in ("doc_id", "key", "tie")]
        columns += [pa.array(lengths, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
        return pa.record_batch(columns, ["doc_id", "key", "tie", "n", "terms", "counts"])

    rows = id_and_text(docs, id_col, text_col).select("doc_id", order_id().alias("key"), F.xxhash64("text").alias("tie"), "text")
    return map_texts(rows, run, _POSTINGS)


class Block:
    """Some documents: their postings by document, and a bitmap for each term."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.rows = batch.num_rows
        self.keys = batch.column("key").to_numpy()
        self.ties = batch.column("tie").to_numpy()
        lists = batch.column("terms")
        self.sizes = np.diff(lists.offsets.to_numpy())
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.terms = lists.flatten().to_numpy()
        tf = batch.column("counts").flatten().to_numpy().astype(np.int64)
        longer = [100 - 25 + 25 * n * n_docs // n_terms for n in batch.column("n").to_pylist()]  # whole numbers of any size
        self.gains = weights[self.terms] * (1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(np.array(longer, np.int64), self.sizes)))
        self.bitmaps = np.zeros((len(weights), self.rows), bool)
        self.bitmaps[self.terms, np.repeat(np.arange(self.rows), self.sizes)] = True
        self.largest = np.zeros(len(weights), np.int64)
        np.maximum.at(self.largest, self.terms, self.gains)

    def groups(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group of each document by its mask of ``terms``, and each group's largest possible score."""
        held = self.bitmaps[terms]
        packed = np.packbits(held, axis=0)
        words = -(-packed.shape[0] // 8)
        masks = np.zeros((self.rows, 8 * words), np.uint8)
        masks[:, : packed.shape[0]] = packed.T
        masks = masks.view(np.uint64)
        if words == 1:
            _, first, group = np.unique(masks[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, group = np.unique(masks, axis=0, return_index=True, return_inverse=True)
        return group.reshape(-1), (times * self.largest[terms]) @ held[:, first].astype(np.int64)

    def scores(self, docs: np.ndarray, by_term: np.ndarray) -> np.ndarray:
        """Scores of ``docs``, each of which holds a posting; ``by_term`` counts the item's terms."""
        sizes = self.sizes[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[docs] - (ends - sizes), sizes)
        return np.add.reduceat(by_term[self.terms[at]] * self.gains[at], ends - sizes)


class Best:
    """An item's best documents so far, as rows (score, key, tie) in order."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.rows = np.zeros((0, 3), np.int64)

    def floor(self) -> int:
        """Below this no document can enter."""
        return int(self.rows[-1, 0]) if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, keys: np.ndarray, ties: np.ndarray) -> None:
        enough = scores >= self.floor()
        new = np.stack([scores[enough], keys[enough], ties[enough]], axis=1)
        rows = np.concatenate([self.rows, new])
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.top]]


def search_block(block: Block, item: tuple[np.ndarray, np.ndarray], by_term: np.ndarray, best: Best) -> int:
    """Take the block's best documents of one item into ``best``; the number of documents evaluated."""
    terms, times = item
    group, bounds = block.groups(terms, times)
    bound = bounds[group]
    docs = np.flatnonzero(bound >= best.floor())
    docs = docs[np.argsort(-bound[docs], kind="stable")]
    by_term[terms] = times
    at, step = 0, FIRST_STEP
    while at < len(docs) and bound[docs[at]] >= best.floor():
        # whole groups: up to the last document whose mask has the bound that the step ends with
        end = min(at + step, len(docs))
        end += int(np.searchsorted(-bound[docs[end:]], -bound[docs[end - 1]], side="right"))
        part = docs[at:end]
        best.add(block.scores(part, by_term), block.keys[part], block.ties[part])
        at, step = end, step * 2
    by_term[terms] = 0
    return at


def ranked(posts: DataFrame, items: list[list[tuple[int, int]]], weights: list[int], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """place (of the item in ``items``), key, tie, score: at most ``top`` rows an item and task."""
    weight = np.array(weights, np.int64)
    size = max(1, min(BLOCK_DOCUMENTS, BITMAP_BYTES // max(1, len(weights))))
    asked = [tuple(np.array(column, np.int64) for column in zip(*terms, strict=True)) if terms else None for terms in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in asked]
        by_term = np.zeros(len(weight), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                block = Block(batch.slice(start, size), weight, n_docs, n_terms)
                for item, rows in zip(asked, best, strict=True):
                    if item is not None:
                        search_block(block, item, by_term, rows)
        for place, rows in enumerate(best):
            if len(rows.rows):
                columns = [pa.array(np.full(len(rows.rows), place), pa.int32()), *(pa.array(rows.rows[:, c]) for c in (1, 2, 0))]
                yield pa.record_batch(columns, ["place", "key", "tie", "score"])

    return posts.select("key", "tie", "n", "terms", "counts").filter("size(terms) > 0").mapInArrow(
        run, "place int, key long, tie long, score long"
    )


def cut(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "key", "tie")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    block: list[tuple[int | None, bytes]] = []
    size = 0
    for row in id_and_text(items, id_col, text_col).toLocalIterator():
        text = row["text"].encode()
        if block and (len(block) == BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row["doc_id"], text))
        size += len(text)
    if block:
        yield block


def search_items(docs: DataFrame, block: list[tuple[int | None, bytes]], top: int, id_col: str, text_col: str) -> DataFrame:
    """The result of one block of items."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for _, text in block:
        items.append([(vocabulary.setdefault(term, len(vocabulary)), n) for term, n in Counter(terms_of(text)).items()])
    posts = staged(postings(docs, vocabulary, id_col, text_col), "search-postings")
    total = posts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held = dict(posts.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # one row a term that is asked for
    weights = [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary))]
    found = ranked(posts, items, weights, total["docs"], total["terms"], top)
    parts = cut(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))), ["place", "part"], top)
    ids = spark.createDataFrame([(place, item_id) for place, (item_id, _) in enumerate(block)], "place int, item_id long")
    lists = cut(parts.drop("part", "rank"), ["place"], top)
    # the smallest long stands for a null id only
    doc_id = F.when(F.col("key") != F.lit(-(2**63)), F.col("key")).alias("doc_id")
    return lists.join(ids, "place").select("item_id", F.col("rank").cast("int"), doc_id, "score")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each row of ``items`` with a score above 0.

    Equal scores go by ascending doc_id, null ids first, then by a hash of the text; rows equal in
    both each have a place.  Null and empty texts hold no term: such items and documents have no
    rows.  A repeated item row has a list of its own, with the same item_id.
    """
    parts = [search_items(docs, block, top, id_col, text_col) for block in item_blocks(items, item_col, item_text_col)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
