"""Token counts, byte-level BPE and packing against the libraries on whole texts."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.byte_bpe import byte_codec, decode_ids, encode_texts, round_trip, safe_parts
from ticketgrain.llm.packing import cheapest_cuts, pack, plan_cuts
from ticketgrain.llm.token_counts import count_tokens, read_cache, tokenizer_version
from ticketgrain.llm.word_bpe import WordEncoder
from ticketgrain.session import scratch_path

WORD = queries.WORD_BPE
MULTI = (queries.MULTI_RANKS, queries.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def tik():
    with open(MULTI[0], "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=MULTI[1], mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_word_encoder_equals_library(library):
    bits = list(" \n\t\r\x0b\x0c\x1c\x85\xa0aAbÉéßİıΣσ'’´̀́.,!?<|>0123½ñ·ªº–​ 　漢字🙂")
    bits += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'re", "the", "The,", "tion***"]
    random.seed(7)
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    encoder = WordEncoder(WORD)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text), repr(text)


def test_counts_whole_table(spark, library):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op3_token_counts(spark, SF).collect()}
    for doc_id, text in odd.sf_texts(spark, SF):
        n = len(ids_of(library, text))
        assert found.pop(doc_id) == (len(text.encode()), n, n > 2048)
    assert not found


def test_cache(spark, library):
    path = scratch_path(spark, "test-cache")
    first = odd.bag(count_tokens(odd.table(spark), WORD, path, limit=10))
    texts = [t or "" for _, t in odd.ROWS]
    assert first == odd.Counter(
        (i, len((t or "").encode()), n := len(ids_of(library, t or "")), n > 10) for i, t in odd.ROWS
    )
    contents = len({t.strip(" \t\n\x0b\x0c\r") for t in texts})
    assert read_cache(spark, path).count() == contents
    # a second run encodes only what is new; a wrong stored count shows that stored ones are used
    spark.createDataFrame(
        [(hashlib.sha256(b"stored").hexdigest(), tokenizer_version(WORD), 77), (hashlib.sha256(b"other").hexdigest(), "older", 1)],
        "content_digest string, tokenizer_digest string, n_tokens long",
    ).write.mode("append").parquet(path)
    more = odd.table(spark, [(1, " stored\n"), (2, "other"), (3, None)])
    assert {r.doc_id: r.n_tokens for r in count_tokens(more, WORD, path).collect()} == {1: 77, 2: len(ids_of(library, "other")), 3: 0}
    assert read_cache(spark, path).count() == contents + 3
    assert count_tokens(odd.empty(spark), WORD, path).count() == 0
    assert count_tokens(odd.empty(spark), WORD, scratch_path(spark, "test-cache")).count() == 0


def test_safe_parts(tik):
    random.seed(3)
    bits = [" ", "  ", "\n", "a", "Zz", "9", "'s", "'", "é", "字", ".", " ", " ", "!?", "́"]
    for size in (1, 2, 5, 17):
        for _ in range(300):
            text = "".join(random.choice(bits) for _ in range(random.randint(0, 40)))
            parts = safe_parts(text, size)
            assert "".join(parts) == text
            assert [i for p in parts for i in tik.encode_ordinary(p)] == tik.encode_ordinary(text)


def test_long_texts(tik):
    codec = byte_codec(*MULTI)
    for text in (odd.LONG, "ab" * 60_000, "word " * 20_000 + "\n" * 500 + "x"):
        assert codec.encode(text) == tik.encode_ordinary(text)


def test_long_white_space(tik, monkeypatch):
    """What the library gives while it can, and no failure beyond."""
    codec = byte_codec(*MULTI)
    for length in (9, 10, 11, 5000):
        for blank in (" ", "\n", " \t", "\u3000 ", "\x1c "):
            for after in ("", "x", "9", "?", "\u00e9", "'s"):
                text = "a b" + (blank * length)[:length] + after
                monkeypatch.setattr("ticketgrain.llm.byte_bpe.PART_CHARS", 0)
                monkeypatch.setattr("ticketgrain.llm.byte_bpe._LONG_SPACE", regex.compile(r"\p{White_Space}{10,}+"))
                assert codec.encode(text) == tik.encode_ordinary(text), repr((blank, length, after))
                monkeypatch.undo()
    for text in (" " * 300_000 + "x", "\n" * 300_000, "y" + " " * 300_000):
        assert codec.decode(codec.encode(text)).decode() == text


def byte_rows(rows, tik):
    out = odd.Counter()
    for doc_id, text in rows:
        ids = tik.encode_ordinary(text or "")
        raw = tik.decode_bytes(ids)
        assert raw == (text or "").encode()
        out[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()] += 1
    return out


def test_bytes_whole_table(spark, tik):
    assert odd.bag(queries.op5_byte_bpe(spark, SF)) == byte_rows(odd.sf_texts(spark, SF), tik)


def test_bytes_odd_rows(spark, tik):
    docs = odd.table(spark)
    assert odd.bag(round_trip(docs, *MULTI)) == byte_rows(odd.ROWS, tik)
    back = decode_ids(encode_texts(docs, *MULTI), *MULTI)
    assert odd.Counter((r.doc_id, bytes(r.raw)) for r in back.collect()) == odd.Counter((i, (t or "").encode()) for i, t in odd.ROWS)
    assert round_trip(odd.empty(spark), *MULTI).count() == 0
    odd_ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.raw) for r in decode_ids(odd_ids, *MULTI).collect()} == {b""}


def test_cuts_are_cheapest():
    """The queue finds what a plain quadratic loop finds."""
    random.seed(5)
    for _ in range(40):
        ends = np.unique([0, *random.sample(range(1, 200), 30)])
        if max(np.diff(ends)) > 32:
            continue
        fines = np.array([0.0] + [random.choice([0.0, 2.0, 5.0]) for _ in ends[1:]])
        cost, _ = cheapest_cuts(ends, fines, 32)
        best = [0.0]
        for i in range(1, len(ends)):
            steps = [(best[j], int(ends[i] - ends[j])) for j in range(i) if ends[i] - ends[j] <= 32]
            best.append(fines[i] + min(c + (0 if n & (n - 1) == 0 else 32 - n) for c, n in steps))
        assert cost == best


def test_plan_covers_all():
    for total in (1, 5, 31, 32, 33, 100, 257):
        for final in (True, False):
            cuts = plan_cuts(np.array([total]), np.array([], dtype=int), total, final, 32)
            assert cuts[0] == 0 and all(0 < b - a <= 32 for a, b in zip(cuts, cuts[1:]))
            assert cuts[-1] == total if final else total - 32 < cuts[-1] <= total


def check_packing(rows, pieces, library, end_id=1, size=2048, waste=0.02):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append([*ids_of(library, text or ""), end_id])
    assert set(by_doc) == set(wanted)
    for doc_id, lists in wanted.items():
        assert sum(p.length for p in by_doc[doc_id]) == sum(map(len, lists))
        if len(lists) == 1:
            ids, at = lists[0], 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(ids))
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
                at += p.length
            assert at == len(ids)
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding <= waste * total
    low = -(2**63)
    order = [low if p.doc_id is None else p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    assert order == sorted(order)


def test_packing_whole_table(spark, library):
    check_packing(odd.sf_texts(spark, SF), queries.op8_packing(spark, SF).collect(), library)


def test_packing_odd_rows(spark, library):
    check_packing(odd.ROWS, pack(odd.table(spark), WORD).collect(), library)
    small = pack(odd.table(spark), WORD, size=64, block=500).collect()
    check_packing(odd.ROWS, small, library, size=64, waste=0.2)
    assert pack(odd.empty(spark), WORD).count() == 0
