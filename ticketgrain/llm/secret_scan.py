"""Secret scans: fixed patterns and a token-efficiency test for random strings.

Random strings need many tokens: a run of key characters with few characters per token under a
byte-level vocabulary is reported unless it is a known kind of digest or identifier.  A run with
separators is judged by its parts: words, numbers, dates and names are left out first, then each long
part is tested, and each string of mixed parts.  Names are excluded only where their tokens are about
as long as words'.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.byte_bpe import byte_codec
from ticketgrain.llm.common import id_and_text, map_texts, quoted

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
MIN_ASSIGNED, MIN_ACCESS = 8, 16
# Candidates of the method: runs of key characters, and their parts, of at least this length.
MIN_RUN = 16
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_WORD_PART = re.compile(r"[A-Za-z0-9]+")
# Parts at the ends of such a string that are not mixed belong to it if + joins them, or if / does and they are this short.
_EDGE = re.compile(r"(?=.*[A-Z0-9])[A-Za-z0-9]{1,5}")
_INTEGRITY = re.compile(r"(?<![A-Za-z0-9])sha(?:1|256|384|512)-[A-Za-z0-9+/_-]{27,88}={0,2}")
MAX_CHARS_PER_TOKEN = 2.2
# Strings of words and numbers alone: the length from which the same ratio tells, and the ratio of several such parts.
MIN_NAME = 20
MAX_CHARS_PER_NAME_TOKEN = 1.8
# Parts of a run with separators: mixed ones have fewer characters for each change of kind than this; one of a string has at
# least so many characters; between two of a string stand at most so many others.  The ratio is that of the whole string.
MAX_PIECE_CHARS = 3
MIN_MIXED = 6
MAX_LOOSE_CHARS = 5
MAX_CHARS_PER_STRETCH_TOKEN = 1.9
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# A text without any of these (a superset of all patterns, in the linear-time regex dialect) has no span.
_MAY_HOLD = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]|AKIA[A-Z0-9]|[A-Za-z0-9+/_=-]{16}"""
)
Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, code points, end exclusive."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # leftmost runs of hexadecimal digits, without the short ones
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return found


def is_known(run: str, piece_chars: int = 6) -> bool:
    """Digests of usual lengths, UUIDs, numbers, and names made of words and numbers."""
    if _HEX_ONLY.fullmatch(run) and len(run) in DIGEST_LENGTHS or _UUID.fullmatch(run):
        return True
    parts = [p for p in re.split(r"[+/_=-]+", run) if p]
    # fooBar, SNAKE_CASE and path/to/page2 are few, long parts; random strings change kind every few characters
    pieces = [p for part in parts for p in _PART.findall(part)]
    return len(run) >= piece_chars * len(pieces)


_IDENTIFIER = re.compile(rf"(?<![A-Za-z0-9]){_UUID.pattern}(?![A-Za-z0-9])")
_NUMBERS = re.compile(r"[0-9+/_=-]+")


def is_digest(run: str) -> bool:
    return bool(_HEX_ONLY.fullmatch(run) and len(run) in DIGEST_LENGTHS or _UUID.fullmatch(run))


def is_random(run: str, codec, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """The token test of one string."""
    if is_digest(run) or (_NUMBERS.fullmatch(run) and (len(run) < MIN_NAME or is_known(run))):
        return False
    if len(run) < MIN_NAME and is_known(run, 4):  # names this short have shorter words
        return False
    if is_known(run):
        if not run.isalnum():  # its parts are tested too
            most = min(most, MAX_CHARS_PER_NAME_TOKEN)
    return len(run) < most * len(codec.encode(run))


class Taken:
    """Places of spans, merged and ascending, so that one search tells whether a stretch is free."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        at = bisect_left(self.starts, b)
        return at > 0 and self.ends[at - 1] > a


def is_mixed(part: str) -> bool:
    """Whether a part changes between capitals, small letters and digits as random strings do, every few characters."""
    pieces = _PART.findall(part)
    return len(pieces) > 1 and len(part) < MAX_PIECE_CHARS * len(pieces)


def random_stretches(run: str, codec) -> list[tuple[int, int]]:
    """Places of random strings in a run with separators, judged by its parts.

    Words, numbers, dates and names are no evidence and are left out first.  What remains is parts that
    are mixed; those that stand together, with parts of a few characters between them, are one string,
    which is tested as a whole.  Long parts are tested alone too.  Digests and identifiers are left out.
    """
    parts = list(_WORD_PART.finditer(run))
    digests = [m.span() for m in parts if len(m[0]) >= MIN_RUN and is_digest(m[0])]
    avoid = Taken([*digests, *(m.span() for pattern in (_INTEGRITY, _IDENTIFIER) for m in pattern.finditer(run))])
    found = [m.span() for m in parts if len(m[0]) >= MIN_RUN and not avoid.meets(*m.span()) and is_random(m[0], codec)]
    groups: list[list[int]] = []
    for i, m in enumerate(parts):
        if is_mixed(m[0]) and not avoid.meets(*m.span()):
            last = parts[groups[-1][-1]].end() if groups else 0
            if not groups or m.start() - last > MAX_LOOSE_CHARS or avoid.meets(last, m.start()):
                groups.append([])
            groups[-1].append(i)

    def joined(left: int, right: int, edge: int) -> bool:
        between = run[parts[left].end() : parts[right].start()]
        return between == "+" or between == "/" and _EDGE.fullmatch(parts[edge][0]) is not None

    for group in groups:
        sizes = [len(parts[i][0]) for i in group]
        first, last = group[0], group[-1]
        text = run[parts[first].start() : parts[last].end()]
        if max(sizes) < MIN_MIXED or sum(sizes) < MIN_RUN or len(text) >= MAX_CHARS_PER_STRETCH_TOKEN * len(codec.encode(text)):
            continue
        while first > 0 and joined(first - 1, first, first - 1):
            first -= 1
        while last + 1 < len(parts) and joined(last, last + 1, last + 1):
            last += 1
        found.append((parts[first].start(), parts[last].end()))
    return found


def random_spans(text: str, codec, taken: list[Span], most: float = MAX_CHARS_PER_TOKEN) -> list[Span]:
    """Runs without separators are tested whole, others by their parts; what meets a span of ``taken`` is left out."""
    base, found = Taken((a, b) for a, b, _ in taken), []
    for m in _RUN.finditer(text):
        begin, end, run = m.start(), m.end(), m[0]
        if run.isalnum():
            spans = [(begin, end)] if is_random(run, codec, most) else []
        else:
            merged = Taken(random_stretches(run, codec))
            spans = [(begin + a, begin + b) for a, b in zip(merged.starts, merged.ends, strict=True)]
        found += [(a, b, "random") for a, b in spans if not base.meets(a, b)]
    return found


def written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in ordered)


def scan_text(text: str, codec) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns, and those that the token test adds."""
    base = base_spans(text)
    return base, random_spans(text, codec, base)


def redact_text(text: str, spans: list[Span], mark: str) -> str:
    """Overlapping spans become one mark."""
    out, at = [], 0
    for begin, end, _ in sorted(spans):
        if begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


_NO_BASE = hashlib.sha256(b"").hexdigest()


def scan_secrets(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans: one row for each row of ``docs``.

    Null and empty texts have no spans; repeated rows are reported each.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = byte_codec(rank_path, pattern)
        texts = batch.column("text")
        counts = [[0] * texts.__len__() for _ in KINDS]
        digests, spans = [_NO_BASE] * len(texts), [""] * len(texts)
        for i in pc.indices_nonzero(pc.match_substring_regex(texts, _MAY_HOLD)).to_pylist():
            base, more = scan_text(texts[i].as_py(), codec)
            for _, _, kind in base + more:
                counts[KINDS.index(kind)][i] += 1
            digests[i] = hashlib.sha256(written(base).encode()).hexdigest()
            spans[i] = written(base + more)
        columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans)]
        return pa.record_batch(columns, ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    numbers = ", ".join(f"n_{kind} long" for kind in KINDS)
    schema = f"doc_id long, {numbers}, base_sha256 string, spans string"
    return map_texts(id_and_text(docs, id_col, text_col), run, schema)


def redact_secrets(
    docs: DataFrame, rank_path: str, pattern: str, mark: str = "[secret]", text_col: str = "text"
) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; all other columns, nulls and texts as they were."""

    @F.pandas_udf("string")
    def redact(texts):
        codec = byte_codec(rank_path, pattern)
        held = pc.match_substring_regex(pa.array(texts, pa.string()), _MAY_HOLD).fill_null(False)
        clean = texts.copy()
        for i in pc.indices_nonzero(held).to_pylist():
            clean.iat[i] = redact_text(texts.iat[i], sum(scan_text(texts.iat[i], codec), []), mark)
        return clean

    return docs.withColumn(text_col, redact(quoted(text_col)))
