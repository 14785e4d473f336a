"""Token ids by a ``tokenizers`` file, at the cost of distinct words rather than of all words.

No token of a tokenizer that drops white space spans it, so a text's ids are those of its words
in turn. A worker keeps the ids of words it has met in a bounded hash table; only new words go
through the library. Words of ASCII and Latin-1 letters are cut further, into runs of letters,
single digits and runs of other signs, as the tokenizer's own splitting does; words with other
characters, apostrophes or the start of a special token go through whole. The cutting is tested
against encoding whole texts. The path of the vocabulary file is a parameter.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from bourseloom.llm.arrays import IS_SPACE, LOWER, span_hashes, text_slices, word_spans

_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[IS_SPACE] = 0
_encoders: dict[tuple[str, int], WordEncoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str, most_words: int = 1 << 20) -> WordEncoder:
    """The worker's encoder for a vocabulary file, kept between batches and tasks."""
    key = path, most_words
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, most_words)
    return _encoders[key]


class WordEncoder:
    def __init__(self, path: str, most_words: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocab_size = max(vocab.values()) + 1
        self.closes = np.zeros(self.vocab_size, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.dtype = np.uint16 if self.vocab_size <= 1 << 16 else np.uint32
        self.most = most_words
        self._clear()

    def _clear(self) -> None:
        self.slots = 1 << max(12, (2 * self.most - 1).bit_length())
        self.keys = np.zeros(self.slots, np.uint64)
        self.value = np.zeros(self.slots, np.int32)
        self.count = 0
        self.size = np.zeros(1 << 12, np.int32)
        self.at = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, self.dtype)
        self.used = 0

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(20)).astype(np.int64) & (self.slots - 1)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Index of each known word, -1 for others."""
        out = np.full(len(h), -1, np.int32)
        rest, slot = None, self._slot(h)
        while True:
            key = self.keys[slot]
            want = h if rest is None else h[rest]
            hit = key == want
            where = np.flatnonzero(hit) if rest is None else rest[hit]
            out[where] = self.value[slot[hit]]
            go = ~hit & (key != 0)
            if not go.any():
                return out
            rest = np.flatnonzero(go) if rest is None else rest[go]
            slot = (slot[go] + 1) & (self.slots - 1)

    def _insert(self, h: np.ndarray, lists: np.ndarray, sizes: np.ndarray) -> None:
        n, total = len(h), len(lists)
        while self.count + n > len(self.size):
            self.size, self.at = np.resize(self.size, 2 * len(self.size)), np.resize(self.at, 2 * len(self.at))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.size[self.count:self.count + n] = sizes
        self.at[self.count:self.count + n] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = lists
        value, slot, rest = np.arange(self.count, self.count + n), self._slot(h), np.arange(n)
        while len(rest):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            taken = free[first]
            self.keys[slot[taken]] = h[rest[taken]]
            self.value[slot[taken]] = value[rest[taken]]
            left = np.ones(len(rest), bool)
            left[taken] = False
            rest, slot = rest[left], (slot[left] + 1) & (self.slots - 1)
        self.count += n
        self.used += total

    def _encode_words(self, words: list[str], single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end, and ids per word. ``single``: makes one run of tokens."""
        sizes = np.zeros(len(words), np.int64)
        parts: list[np.ndarray | None] = [None] * len(words)
        alone = np.flatnonzero(~single)
        runs = np.flatnonzero(single)
        for lo in range(0, len(runs), 5000):
            own = runs[lo:lo + 5000]
            got = np.array(self.tokenizer.encode(
                " ".join(words[i] for i in own), add_special_tokens=False).ids, self.dtype)
            ends = np.flatnonzero(self.closes[got]) + 1
            if len(ends) != len(own) or (len(ends) and ends[-1] != len(got)):
                alone = np.concatenate([alone, own])
                continue
            for i, piece in zip(own, np.split(got, ends[:-1]), strict=True):
                parts[i] = piece
        encoded = self.tokenizer.encode_batch([words[i] for i in alone], add_special_tokens=False)
        for i, e in zip(alone, encoded, strict=True):
            parts[i] = np.array(e.ids, self.dtype)
        sizes[:] = [len(p) for p in parts]
        return np.concatenate(parts), sizes

    def slices(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of rows as (first row, end row, ids end to end, offsets of the rows in them)."""
        for lo, hi, data, offs in text_slices(column, 1 << 21):
            ids, at = self._slice(data, offs)
            yield lo, hi, ids, at

    def _slice(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, counts = word_spans(data, offs)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offs), np.int64)
        odd = (data < 32) | (data == 39) | (data == 127)
        high = data >= 128
        if high.any():
            lead = np.zeros(len(data), bool)
            lead[1:] = data[:-1] == 0xC3
            latin = (data == 0xC3) | (lead & high & (data != 0x97) & (data != 0xB7))
            odd |= high & ~latin
            upper = lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        else:
            upper = None
        bar = np.flatnonzero(data[1:] == 124)
        odd[bar[data[bar] == 60]] = True
        total = np.concatenate([[0], np.cumsum(odd & ~IS_SPACE[data])])
        whole = total[ends] > total[starts]
        low = LOWER[data]
        if upper is not None:
            low[upper] += 0x20
        kind = _CLASS[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        cut &= kind != 0
        if whole.any():
            for s, e in zip(starts[whole], ends[whole], strict=True):
                cut[s:e] = False
                low[s:e] = data[s:e]
        cut[starts] = True
        begin = np.flatnonzero(cut)
        word = np.searchsorted(starts, begin, "right") - 1
        stop = ends[word].copy()
        same = word[1:] == word[:-1]
        stop[:-1][same] = begin[1:][same]
        single = ~whole[word]
        h = span_hashes(low, begin, stop)
        h[~single] ^= np.uint64(0x5BF03635)
        h[h == 0] = 1
        found = self._find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, first = np.unique(h[new], return_index=True)
            if self.count + len(fresh) > self.most and self.count:
                self._clear()
                fresh, new = h, np.arange(len(h))
                fresh, first = np.unique(h, return_index=True)
            if len(fresh) > self.slots // 2:
                self.most = len(fresh)
                self._clear()
            pick = new[first]
            raw = low.tobytes()
            words = [raw[a:b].decode() for a, b in zip(begin[pick], stop[pick], strict=True)]
            self._insert(fresh, *self._encode_words(words, single[pick]))
            found = self._find(h)
        sizes = self.size[found].astype(np.int64)
        out_at = np.concatenate([[0], np.cumsum(sizes)])
        pos = np.repeat(self.at[found] - out_at[:-1], sizes) + np.arange(out_at[-1])
        rows = np.searchsorted(begin, offs)
        return self.ids[pos], out_at[rows]
