"""Token ids of a word-level BPE file (tokenizers library), each distinct word encoded once.

The file's pre-tokenizer drops white space, so a text's ids are those of its words in turn.
A word of plain letters followed by ASCII punctuation is two such pieces; its letters may be
lower-cased beforehand, as the file's normalizer would.  All other words, among them any with
a special token's string, go to the library as they are.

Words are cut, numbered and cut into pieces as columns of bytes; only distinct pieces become
Python objects, and the ids of all words are put together from the columns of distinct ones.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

# letters whose lower case is one letter of the same set, composed as NFC wants them; ASCII punctuation but "'"
LETTERS = re.compile(b"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])++")
_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, list(b" \t\n\r\x0b\x0c"))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122)
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~np.isin(_BYTES, list(b"'0123456789"))
# À to ÿ but the two signs among them: this byte, and one of those
_LATIN = 0xC3
_LATIN_LETTER = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & ~np.isin(_BYTES, [0x97, 0xB7])
_LATIN_UPPER = _LATIN_LETTER & (_BYTES <= 0x9E)
MEMO_ENTRIES = 250_000
JOINED = 2_000


class _Memo(dict):
    """Keeps what is asked for again soon; most words come once and would only take room."""

    def __init__(self, entries: int):
        super().__init__()
        self.entries = entries
        self.young: set = set()

    def missing(self, wanted: set) -> list:
        """What to learn for ``wanted``; forgets what was learnt last time and is not wanted again."""
        new = wanted.difference(self)
        for key in self.young.difference(wanted):
            self.pop(key, None)
        if len(self) > self.entries:
            self.clear()
            new = wanted
        self.young = new
        return list(new)


class WordEncoder:
    """Little-endian unsigned 32-bit ids of UTF-8 texts."""

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        # the same model for pieces that need no normalizing and no further splitting
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.plain = Tokenizer(self.whole.model)  # ASCII letters stand for themselves
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.whole.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known = _Memo(entries)

    def encode(self, texts: Iterable[bytes]) -> list[bytes]:
        texts = list(texts)
        data = np.frombuffer(b"\n".join([b"", *texts, b""]), dtype=np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # where words begin and end, in turn
        begins, ends = edges[::2], edges[1::2]
        if not len(begins):
            return [b""] * len(texts)
        words = _column(data[~space], ends - begins).dictionary_encode()
        ids = self._ids(words.dictionary).take(words.indices)
        _, places, held = ids.buffers()
        places, held = np.frombuffer(places, np.int64, len(ids) + 1, 8 * ids.offset), memoryview(held or b"")
        at = places[np.searchsorted(begins, np.cumsum([1, *(len(t) + 1 for t in texts)]))].tolist()
        return [bytes(held[a:b]) for a, b in zip(at, at[1:], strict=False)]

    def _ids(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, none of them empty."""
        letters, tails = (p.dictionary_encode() for p in pieces(words))
        keys, tail_keys = (p.dictionary.to_numpy(zero_copy_only=False).tolist() for p in (letters, tails))
        self._learn(self.known.missing({*keys, *tail_keys}))
        first, second = (
            pa.array(map(self.known.__getitem__, k), pa.large_binary()).take(p.indices)
            for k, p in ((keys, letters), (tail_keys, tails))
        )
        return pc.binary_join_element_wise(first, second, pa.scalar(b"", pa.large_binary()))

    def _learn(self, missing: list[bytes]) -> None:
        ascii_only = [p for p in missing if p.isalpha()]  # of bytes: only ASCII letters
        others = [p for p in missing if not p.isalpha()]
        simple = [p for p in others if LETTERS.fullmatch(p)]
        self._joined(self.plain, ascii_only)
        self._joined(self.letters, simple)
        rest = list(set(others).difference(simple))
        self.known.update(zip(rest, self._whole([p.decode("utf-8", "replace") for p in rest]), strict=True))

    def _joined(self, tokenizer: Tokenizer, words: list[bytes]) -> None:
        """A word's last token, and no other, ends a word."""
        for i in range(0, len(words), JOINED):
            part = words[i : i + JOINED]
            (done,) = tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            tokens = np.array(done.ids, dtype="<u4")
            ends = [0, *(4 * (np.flatnonzero(self.last[tokens]) + 1)).tolist()]
            ids = tokens.tobytes()
            self.known.update(zip(part, [ids[a:b] for a, b in zip(ends, ends[1:])], strict=True))

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.whole.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]


def _column(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Pieces of ``data`` of these lengths, one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def pieces(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The lower-cased letters of each word and the punctuation behind them; any other word whole, and nothing."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    begins, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    inner = np.ones(len(data), bool)  # not a word's first byte
    inner[begins] = False
    latin = np.zeros(len(data), bool)  # the second bytes of letters beyond ASCII
    latin[1:] = (data[:-1] == _LATIN) & _LATIN_LETTER[data[1:]] & inner[1:]
    letter, mark = _LETTER[data] | latin, _MARK[data]
    letter[:-1] |= latin[1:]
    odd = ~(letter | mark) | mark & ~inner
    odd[1:] |= letter[1:] & mark[:-1] & inner[1:]
    plain = ~np.logical_or.reduceat(odd, begins)
    head = np.where(plain, np.add.reduceat(letter, begins, dtype=np.int32), lengths)
    lowered = np.where((_UPPER[data] | latin & _LATIN_UPPER[data]) & np.repeat(plain, lengths), data + 32, data)
    in_head = np.arange(len(data)) < np.repeat(begins + head, lengths)
    return _column(lowered[in_head], head), _column(data[~in_head], lengths - head)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, entries: int = MEMO_ENTRIES) -> WordEncoder:
    """One encoder for each Python worker."""
    if (path, entries) not in _ENCODERS:
        _ENCODERS[path, entries] = WordEncoder(path, entries)
    return _ENCODERS[path, entries]
