"""Packing of documents into training sequences, in id order, by dynamic programming.

The token stream of a bucket of documents is cut into windows of at most ``size`` tokens.
Cuts lie at document or sentence ends; a cut inside a document costs a truncation penalty,
a window that is not full costs its padding.  The cheapest chain of cuts is found with a
monotone queue over the last ``size`` tokens, plus the windows that are a power of two long
and need no padding either.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ticketgrain.llm.common import id_and_text, slices
from ticketgrain.llm.ordering import in_buckets
from ticketgrain.llm.word_bpe import word_encoder

SEQUENCE_TOKENS = 2048
END_ID = 1
SENTENCE_PENALTY = 4  # tokens of padding that a cut at a sentence end is worth
FORCED_PENALTY = 64  # a cut inside a sentence that fills a whole window
SLICE_BYTES = 8 * 1024 * 1024  # text encoded at once: more words are met twice
BLOCK_TOKENS = 1 << 18  # planned at once; documents longer than this are planned alone
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def sentence_end_ids(tokenizer_path: str) -> np.ndarray:
    """Whether a sentence may end after the token, by id."""
    vocab = json.loads(Path(tokenizer_path).read_text(encoding="utf-8"))["model"]["vocab"]
    ends = np.zeros(max(vocab.values()) + 3, dtype=bool)
    for token, token_id in vocab.items():
        word_end = token.endswith("</w>")
        mark = token.removesuffix("</w>")
        ends[token_id] = word_end and mark[-1:] in (".", "!", "?") and not any(c.isalnum() for c in mark)
    return ends


def cheapest_cuts(ends: np.ndarray, penalties: np.ndarray, size: int = SEQUENCE_TOKENS) -> tuple[list[float], list[int]]:
    """Cost of the cheapest chain of windows up to each place (ascending, from 0 on), and the place before it."""
    n = len(ends)
    index = np.full(int(ends[-1]) + 1, -1)
    index[ends] = np.arange(n)
    # windows of exactly a power of two tokens: pairs of places, by the later one
    later, earlier = [], []
    power = 1
    while power < size:
        first = int(np.searchsorted(ends, power))
        source = index[ends[first:] - power]
        fits = np.flatnonzero(source >= 0)
        later.append(fits + first)
        earlier.append(source[fits])
        power *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    sources = earlier[order].tolist()
    begins = np.searchsorted(later[order], np.arange(n + 1)).tolist()

    positions, fines = ends.tolist(), penalties.tolist()
    cost, back, weight = [0.0] * n, [0] * n, [0.0] * n
    queue = deque([0])  # places by ascending weight: cost and position
    for i in range(1, n):
        here = positions[i]
        while positions[queue[0]] < here - size:
            queue.popleft()
        source = queue[0]
        best = weight[source] + size - here
        for j in sources[begins[i] : begins[i + 1]]:
            if cost[j] < best:
                best, source = cost[j], j
        cost[i] = best = best + fines[i]
        back[i] = source
        weight[i] = best = best + here
        while queue and weight[queue[-1]] >= best:
            queue.pop()
        queue.append(i)
    return cost, back


def plan_cuts(
    doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int, final: bool, size: int = SEQUENCE_TOKENS
) -> list[int]:
    """Ascending cuts, from 0 on.

    Candidates are document and sentence ends; stretches of over ``size`` tokens without one get
    a candidate every ``size`` tokens.  A final plan ends at ``total``: what a last window lacks
    is made up by windows of powers of two tokens.  Any other plan may stop up to ``size`` tokens
    earlier, where it is cheapest, and the rest goes to the next plan.
    """
    is_doc, is_sentence = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    is_doc[doc_ends], is_sentence[sentence_ends] = True, True
    marks = is_doc | is_sentence
    marks[[0, total]] = True
    ends = np.flatnonzero(marks)
    for i in np.flatnonzero(np.diff(ends) > size).tolist():
        marks[ends[i] + size : ends[i + 1] : size] = True
    ends = np.flatnonzero(marks)
    penalties = np.where(is_doc[ends], 0.0, np.where(is_sentence[ends], SENTENCE_PENALTY, FORCED_PENALTY))
    cost, back = cheapest_cuts(ends, penalties, size)
    near = np.flatnonzero(ends > total - size)
    if final:  # the rest behind each place as powers of two, each further one cut inside a sentence
        rests = [max(0, int(total - ends[i]).bit_count() - 1) * FORCED_PENALTY for i in near.tolist()]
    else:
        near = near[near > 0]
        rests = [0] * len(near)
    last = min(zip(near.tolist(), rests, strict=True), key=lambda x: cost[x[0]] + x[1])[0] if len(near) else 0
    cuts = [int(ends[last])]
    while last:
        last = back[last]
        cuts.append(int(ends[last]))
    cuts.reverse()
    if final:
        left = total - cuts[-1]
        for bit in range(left.bit_length() - 1, -1, -1):
            if left >> bit & 1:
                cuts.append(cuts[-1] + (1 << bit))
    return cuts


class Packer:
    """Streams documents of one bucket and yields their pieces."""

    def __init__(self, bucket: int, sentence_ends: np.ndarray, size: int, block: int):
        self.next_id = bucket << 32
        self.sentence_ends, self.size, self.block = sentence_ends, size, block
        self.docs: list[tuple[int | None, int, bytes]] = []  # id, first token not yet placed, ids
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        self.docs.append((doc_id, 0, ids))
        self.tokens += len(ids) // 4
        if self.tokens >= self.block:
            yield from self.place(final=False)

    def place(self, final: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        stream = np.frombuffer(b"".join(memoryview(ids)[4 * start :] for _, start, ids in self.docs), dtype="<u4")
        lengths = [len(ids) // 4 - start for _, start, ids in self.docs]
        doc_ends = np.cumsum(lengths)
        marks = self.sentence_ends[np.minimum(stream, len(self.sentence_ends) - 1)]
        cuts = plan_cuts(doc_ends, np.flatnonzero(marks) + 1, len(stream), final, self.size)
        at, passed = 0, 0  # the document that holds the next token, tokens before it
        for begin, end in zip(cuts, cuts[1:], strict=False):
            here = begin
            while here < end:
                doc_id, start, ids = self.docs[at]
                stop = min(end, passed + lengths[at])
                first, length = start + here - passed, stop - here
                crc = zlib.crc32(memoryview(ids)[4 * first : 4 * (first + length)])
                yield doc_id, first, length, crc, len(ids) // 4, self.next_id, here - begin
                here = stop
                if stop == passed + lengths[at]:
                    passed += lengths[at]
                    at += 1
            self.next_id += 1
        if at < len(self.docs):
            doc_id, start, ids = self.docs[at]
            self.docs = [(doc_id, start + cuts[-1] - passed, ids), *self.docs[at + 1 :]]
        else:
            self.docs = []
        self.tokens = len(stream) - cuts[-1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    size: int = SEQUENCE_TOKENS,
    block: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of a document in a sequence of at most ``size`` tokens (a power of two).

    doc_id, start (the document's tokens before it), length, ids_crc32 (of the little-endian 32-bit
    ids), doc_tokens, sequence_id, offset (in the sequence).  A document is its text's ids and
    ``end_id``; a null or empty text is ``end_id`` alone.  Documents come in ascending (id, hash of
    the text) order, null ids first; repeated rows are packed as often as they stand.  Sequences do
    not reach over the buckets of documents that tasks pack on their own; sequence ids ascend with
    the documents.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ends = word_encoder(tokenizer_path), sentence_end_ids(tokenizer_path)
        packer, bucket = None, None
        pieces: list[tuple] = []
        for part in slices(batches, size=SLICE_BYTES):
            texts = encoder.encode(part.column("text").cast(pa.binary()).to_pylist())
            for number, doc_id, ids in zip(part.column("bucket").to_pylist(), part.column("doc_id").to_pylist(), texts, strict=True):
                if number != bucket:
                    if packer:
                        pieces.extend(packer.place(final=True))
                    packer, bucket = Packer(number, ends, size, block), number
                pieces.extend(packer.add(doc_id, ids + end))
            if pieces:
                yield as_batch(pieces)
                pieces = []
        if packer:
            pieces.extend(packer.place(final=True))
        if pieces:
            yield as_batch(pieces)

    rows = in_buckets(id_and_text(docs, id_col, text_col)).select("bucket", "doc_id", "text")
    return rows.mapInArrow(run, PIECES)


def as_batch(pieces: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in PIECES.split(", ")]
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], names)
