"""Document fingerprints from prefix polynomial hashes.

With S[i] = sum of c[j] * B^j for j < i (modulo p), any span's hash is (S[b] - S[a]) * B^-a:
one subtraction and one product compare two spans, and a binary search over lengths finds the
longest common extension of two places.  Two bases make 62 bits.

A fingerprint is text: the length, the whole text's hash, hashes of prefixes and of suffixes at
every ``step`` characters (a power of two, at most 32 of each), and the smallest hashes of all
spans of 16 characters.  It is enough to compare two texts later without either of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ticketgrain.llm.common import id_and_text, slices
from ticketgrain.llm.ordering import in_buckets

PRIME = np.uint64(2**31 - 1)
BASES = (1_000_003, 998_244_353)
CHECKPOINTS = 32
SPAN = 16
SKETCH = 24
# Spans whose hash is under a bound are looked at first; about so many of a long text are.
SKETCH_POOL = 512
COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class _Powers:
    """B^i and B^-i modulo the prime, grown as longer texts come."""

    def __init__(self, base: int):
        prime = int(PRIME)
        self.base, self.inverse = base % prime, pow(base, prime - 2, prime)
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) <= n:
            size, prime = len(self.up), int(PRIME)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, prime)) % PRIME])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, prime)) % PRIME])
        return self.up, self.down


_POWERS = tuple(_Powers(b) for b in BASES)


class PrefixHashes:
    """Modular prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums, self.down = [], []
        for powers in _POWERS:
            up, down = powers.upto(self.n)
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(codes * up[: self.n] % PRIME, out=sums[1:])  # under 2^31 each: exact below 2^33 characters
            self.sums.append(sums % PRIME)
            self.down.append(down)

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [begin, end)."""
        parts = [(s[end] + PRIME - s[begin]) * d[begin] % PRIME for s, d in zip(self.sums, self.down, strict=True)]
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, begin: int, end: int) -> int:
        return int(self.spans(np.array([begin]), np.array([end]))[0])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` characters, in order."""
        count = self.n - width + 1
        parts = [
            (s[width:] + PRIME - s[:count]) * d[:count] % PRIME for s, d in zip(self.sums, self.down, strict=True)
        ]
        return parts[0] << np.uint64(31) | parts[1]

    def common_extension(self, at: int, other: PrefixHashes, other_at: int) -> int:
        """Characters that agree from ``at`` here and ``other_at`` there onwards."""
        low, high = 0, min(self.n - at, other.n - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(at, at + middle) == other.span(other_at, other_at + middle):
                low = middle
            else:
                high = middle - 1
        return low


@dataclass(frozen=True)
class Fingerprint:
    n: int
    whole: int
    step: int
    prefixes: tuple[int, ...]
    suffixes: tuple[int, ...]
    sketch: tuple[int, ...]

    def __str__(self) -> str:
        lists = (".".join(f"{h:08x}" for h in x) for x in (self.prefixes, self.suffixes, self.sketch))
        return f"{self.n:x}:{self.whole:016x}:{self.step:x}:" + ":".join(lists)

    @classmethod
    def parse(cls, written: str) -> Fingerprint:
        n, whole, step, *lists = written.split(":")
        return cls(int(n, 16), int(whole, 16), int(step, 16), *(tuple(int(h, 16) for h in x.split(".") if h) for x in lists))


def fingerprint(text: str) -> Fingerprint:
    hashes = PrefixHashes(text)
    n, step = hashes.n, 1
    while n // step > CHECKPOINTS:
        step *= 2
    marks = np.arange(step, n + 1, step)
    zeros, ends = np.zeros(len(marks), dtype=np.int64), np.full(len(marks), n)
    low = np.uint64(0xFFFFFFFF)
    return Fingerprint(
        n,
        hashes.span(0, n),
        step,
        tuple((hashes.spans(zeros, marks) & low).tolist()),
        tuple((hashes.spans(n - marks, ends) & low).tolist()),
        _smallest(hashes),
    )


def _smallest(hashes: PrefixHashes) -> tuple[int, ...]:
    """The SKETCH smallest distinct span hashes (32 bits); a text shorter than a span has one, an empty one none."""
    if hashes.n < SPAN:
        return (hashes.span(0, hashes.n) & 0xFFFFFFFF,) if hashes.n else ()
    # the low bits of a product of residues are not even: spread them once more
    spread = (hashes.windows(SPAN) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    bound = np.uint64(2**32 * SKETCH_POOL // len(spread))
    found = np.unique(spread[spread < bound])
    if len(found) < SKETCH:  # short or repetitive
        found = np.unique(spread)
    return tuple(found[:SKETCH].tolist())


def _agreeing(mine: tuple[int, ...], step: int, theirs: tuple[int, ...], their_step: int) -> int:
    """Longest agreeing prefix (or suffix) that the checkpoints show, by binary search."""
    wide = max(step, their_step)
    a, b = mine[wide // step - 1 :: wide // step], theirs[wide // their_step - 1 :: wide // their_step]
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return low * wide


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1; 1 for equal texts.

    The larger of two shares: what the common prefix and the common suffix cover of the longer
    text, and the estimated share of common spans.
    """
    if (a.n, a.whole) == (b.n, b.whole):
        return 1.0
    if not a.n or not b.n:
        return 0.0
    ends = _agreeing(a.prefixes, a.step, b.prefixes, b.step) + _agreeing(a.suffixes, a.step, b.suffixes, b.step)
    covered = min(ends, min(a.n, b.n)) / max(a.n, b.n)
    mine, theirs = set(a.sketch), set(b.sketch)
    both = sorted(mine | theirs)[:SKETCH]
    spans = sum(h in mine and h in theirs for h in both) / len(both)
    return max(covered, spans)


def edited(text: str, following: str) -> str:
    """The text whose second half is replaced by the beginning of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: see COLUMNS.

    The next document is the one after it in ascending (id, hash of the text) order, null ids
    first; the last one's next is the first.  Repeated rows follow each other.  A null text counts
    as empty; empty texts have equal fingerprints.
    """
    names = [field.split()[0] for field in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the document that still waits for the one after it
        bucket, doc_id, text, print_ = None, None, None, None
        for part in slices(batches):
            rows = []
            columns = [part.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")]
            for next_bucket, guest, next_id, next_text in zip(*columns, strict=True):
                next_print = fingerprint(next_text)
                if bucket == next_bucket:
                    changed = edited(text, next_text)
                    changed_print = fingerprint(changed)
                    rows.append(
                        (
                            doc_id,
                            len(text),
                            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            str(print_),
                            str(changed_print),
                            likeness(print_, changed_print),
                            likeness(print_, next_print),
                        )
                    )
                # a bucket ends with its first guest; copies of the guest are passed over
                bucket, doc_id, text, print_ = None if guest else next_bucket, next_id, next_text, next_print
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                yield pa.record_batch(arrays, names)

    ordered = in_buckets(id_and_text(docs, id_col, text_col), first_of_next=True)
    return ordered.select("bucket", "guest", "doc_id", "text").mapInArrow(run, COLUMNS)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
