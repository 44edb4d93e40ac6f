import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.fingerprints import (
    Fingerprint, PrefixHashes, edited, fingerprint, fingerprint_documents, likeness,
)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=80), st.data())
def test_span_equality_and_extension(text, data):
    hashes = PrefixHashes(text)
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(0, len(text)))
    size = data.draw(st.integers(0, len(text) - max(a, b)))
    assert (hashes.span(a, a + size) == hashes.span(b, b + size)) == (text[a : a + size] == text[b : b + size])
    common = 0
    while max(a, b) + common < len(text) and text[a + common] == text[b + common]:
        common += 1
    assert hashes.common_extension(a, hashes, b) == common


def test_windows_are_spans():
    hashes = PrefixHashes("the cat sat on the mat and the cat sat")
    assert [int(h) for h in hashes.windows(7)] == [hashes.span(i, i + 7) for i in range(hashes.n - 6)]


def test_likeness():
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    other = " ".join(f"term{i * 104729 % 1000}" for i in range(400))
    near = text.replace("word5 ", "word6 ").replace("word77 ", "")
    assert likeness(fingerprint(text), fingerprint(text)) == 1
    assert likeness(fingerprint(text), fingerprint(near)) > 0.6
    assert 0.45 < likeness(fingerprint(text), fingerprint(edited(text, other))) < 0.7
    assert likeness(fingerprint(text), fingerprint(other)) < 0.1
    assert likeness(fingerprint(text), fingerprint("")) == 0
    assert likeness(fingerprint(""), fingerprint("")) == 1
    assert likeness(fingerprint("aaaa"), fingerprint("aaa")) < 1


@pytest.mark.parametrize("text", ["", "a", "ab" * 5000, odd.LONG])
def test_written_form(text):
    print_ = fingerprint(text)
    assert Fingerprint.parse(str(print_)) == print_


def expected(rows):
    """Plain loop over the documents in order."""
    low = -(2**63)
    ordered = sorted(rows, key=lambda r: (low if r[0] is None else r[0]))
    out = []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        changed = edited(text, after)
        prints = [fingerprint(t) for t in (text, changed, after)]
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), str(prints[0]), str(prints[1]),
             likeness(prints[0], prints[1]), likeness(prints[0], prints[2]))
        )
    return sorted(out)


def test_whole_table(spark):
    found = sorted(tuple(r) for r in queries.op1_fingerprints(spark, SF).collect())
    assert found == expected(odd.sf_texts(spark, SF))


def test_odd_rows(spark):
    rows = fingerprint_documents(odd.table(spark)).collect()
    assert len(rows) == len(odd.ROWS)
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t in odd.ROWS)
    plain = [r for r in rows if r.doc_id in (5, 12) and r.n_chars == 58]
    assert len(plain) == 3 and len({r.fingerprint for r in plain}) == 1
    assert 1.0 in {r.near_next for r in plain}  # the repeated row is its own next
    assert fingerprint_documents(odd.empty(spark)).count() == 0
    (alone,) = fingerprint_documents(odd.table(spark, [(1, "one document")])).collect()
    assert alone.near_next == 1 and alone.edited_sha256 == hashlib.sha256(edited("one document", "one document").encode()).hexdigest()
