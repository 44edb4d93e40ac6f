"""Byte-level BPE by a rank file with the tiktoken library: encode whole texts, decode ids.

Long texts are cut before a space that follows an ASCII letter, digit or mark: no match of
the pre-splitting pattern reaches over such a place, so the parts' ids join to the whole's.
Very long white space, on which the library's own splitting fails, is one match but for a last
character before other text, and is merged as such.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from ticketgrain.llm.common import id_and_text, map_texts

PART_CHARS = 32_768
_LONG_SPACE = regex.compile(r"\p{White_Space}{4096,}+")
_SAFE_CUT = regex.compile(r"(?<=[A-Za-z0-9.,;:!?])(?= )")


class ByteCodec:
    def __init__(self, rank_path: str, pattern: str):
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # everything is one match: merges a piece that was split off before
        self.piece = tiktoken.Encoding("piece", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.digits = {rank: str(rank).encode() for rank in ranks.values()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= PART_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for space in _LONG_SPACE.finditer(text):
            end = space.end() if space.end() == len(text) else space.end() - 1
            for part in safe_parts(text[at : space.start()]):
                ids += self.encoding.encode_ordinary(part)
            ids += self.piece.encode_ordinary(text[space.start() : end])
            at = end
        for part in safe_parts(text[at:]):
            ids += self.encoding.encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def written(self, ids: list[int]) -> bytes:
        """Decimal ids joined by commas."""
        return b",".join(map(self.digits.__getitem__, ids))


def safe_parts(text: str, size: int = PART_CHARS) -> list[str]:
    """Parts of at least ``size`` characters, cut at the next safe place; none: one part."""
    parts, start = [], 0
    while len(text) - start > size:
        found = _SAFE_CUT.search(text, start + size)
        if not found:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


_CODECS: dict[tuple[str, str], ByteCodec] = {}


def byte_codec(rank_path: str, pattern: str) -> ByteCodec:
    """One codec for each Python worker."""
    key = (rank_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = ByteCodec(rank_path, pattern)
    return _CODECS[key]


def encode_texts(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids: token ids of every row's whole text; null or empty texts have none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = byte_codec(rank_path, pattern)
        ids = pa.array([codec.encode(text) for text in batch.column("text").to_pylist()], pa.list_(pa.int32()))
        return pa.record_batch([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, raw: the bytes that ``ids`` stand for (they need not be valid UTF-8); null ids: no bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = byte_codec(rank_path, pattern)
        raw = pa.array([codec.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.binary())
        return pa.record_batch([batch.column("doc_id"), raw], ["doc_id", "raw"])

    return map_texts(encoded.select("doc_id", "ids"), run, "doc_id long, raw binary", text="ids")


def round_trip(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 of every row.

    The ids are made, written, decoded and dropped row by row inside the task, so no array of
    ids has to leave it.  A null or empty text has no ids; both digests are those of no bytes.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = byte_codec(rank_path, pattern)
        counts, written, decoded = [], [], []
        for text in batch.column("text").to_pylist():
            ids = codec.encode(text)
            counts.append(len(ids))
            written.append(hashlib.sha256(codec.written(ids)).hexdigest())
            decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(id_and_text(docs, id_col, text_col), run, schema)
