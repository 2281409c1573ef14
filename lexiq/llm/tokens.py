"""Token ids of whole texts, with a public tokenizer file and the ``tokenizers`` library.

A tokenizer that drops white space gives for a text the ids of its words, one after the other;
one that also folds case and separates letters from marks gives for a word the ids of its small
letters and then those of the full stops and commas at its end. For such a file (``Encoder`` probes
it) the ids of words are kept in a table with ``SLOTS`` places, by
hash, and only words that are not in it are encoded; it starts anew at ``KEPT_IDS`` ids. Any other
file encodes whole texts. The path is a parameter and must be readable on every executor.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from . import words as W

SLOTS, KEPT_IDS = 1 << 21, 8_000_000
ROW = 64
_SLOT_SHIFT = np.uint64(64 - SLOTS.bit_length() + 1)
#: Texts on which a tokenizer that drops white space must agree with its own words.
_MARKS = np.isin(np.arange(256), np.frombuffer(b".,", np.uint8))
_ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
#: Texts, and the pieces of each, on which a tokenizer that folds case and splits marks must agree.
_PIECES = (("Stop, NOW... ok., 1.", ["stop", ",", "now", "...", "ok", ".,", "1", "."]), ("It's a'B.", ["it's", "a'b", "."]))
_PROBES = ("a b", " a  b\n", "it's  là 12 3", "x́ ́y <|endoftext|> z", "Don't\tSTOP, now!")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = all(self._whole([t])[0] == sum(self._whole(t.split()), []) for t in _PROBES)
        self.by_piece = self.by_word and all(self._whole([t])[0] == sum(self._whole(p), []) for t, p in _PIECES)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if self.by_word and suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._clear()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, w: W.Words) -> tuple[W.Words, np.ndarray]:
        """Words without the marks at their ends, those marks, and the hashes of both."""
        if not self.by_piece:
            return w, w.hashes()
        cut = w.ends.copy()
        live = np.flatnonzero(_MARKS[w.data[cut - 1]])
        while len(live):
            cut[live] -= 1
            live = live[cut[live] > w.starts[live]]
            live = live[_MARKS[w.data[cut[live] - 1]]]
        split = (cut < w.ends) & (cut > w.starts)
        split[split] = _ALNUM[w.data[cut[split] - 1]]
        starts = np.sort(np.concatenate([w.starts, cut[split]]), kind="stable")
        ends = np.sort(np.concatenate([w.ends, cut[split]]), kind="stable")
        x = W.Words(w.row, w.data, w.offsets, starts, ends, np.searchsorted(starts, w.offsets))
        hashes = x.hashes(lower=True)
        # special tokens are told by case, and only they hold this sign
        marked = np.unique(np.searchsorted(starts, np.flatnonzero(w.data == ord("<")), "right") - 1)
        if len(marked):
            hashes[marked] = W.mix(W.span_hashes(x.data, starts[marked], ends[marked]) + np.uint64(1))
        return x, hashes

    def _clear(self) -> None:
        self.known = np.zeros(SLOTS, np.uint64)
        self.begin, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int32)
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0

    def _learn(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode words and append their ids to the table: (first id, number of ids) of each."""
        found: list[list[int]] = [[]] * len(texts)
        alone = list(range(len(texts)))
        if self.ends is not None:
            # words of letters only are encoded in rows; the ids that end a word part them again.
            # A word that yields more than one ending makes its row's endings too many: told apart below
            plain = [i for i, t in enumerate(texts) if t.isalpha()]
            rows = [plain[i:i + ROW] for i in range(0, len(plain), ROW)]
            parted = set()
            for row, ids in zip(rows, self._whole([" ".join([texts[i] for i in row]) for row in rows])):
                at = np.flatnonzero(self.ends[ids]) + 1
                if len(at) == len(row):
                    parted.update(row)
                    for i, x, y in zip(row, [0, *at[:-1].tolist()], at.tolist()):
                        found[i] = ids[x:y]
            alone = [i for i in alone if i not in parted]
        for i, ids in zip(alone, self._whole([texts[i] for i in alone])):
            found[i] = ids
        count = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(count.sum()))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + len(flat), np.int32)])
        self.ids[self.used:self.used + len(flat)] = flat
        begin = self.used + np.cumsum(count) - count
        self.used += len(flat)
        return begin, count

    def _words(self, w: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first id, number of ids) in the table for every piece of a slice."""
        if self.used > KEPT_IDS:
            self._clear()
        slot = (hashes >> _SLOT_SHIFT).astype(np.int64)
        begin, count = self.begin[slot], self.count[slot].astype(np.int64)
        new = np.flatnonzero(self.known[slot] != hashes)
        if len(new):
            distinct, at, where = np.unique(hashes[new], return_index=True, return_inverse=True)
            at, data = new[at], w.data.tobytes()
            first, number = self._learn([data[a:b].decode("utf-8", "replace")
                                         for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist())])
            begin[new], count[new] = first[where], number[where]
            # of two words with one slot the last stays
            slot = (distinct >> _SLOT_SHIFT).astype(np.int64)
            self.known[slot] = distinct
            kept = self.known[slot] == distinct
            self.begin[slot[kept]], self.count[slot[kept]] = first[kept], number[kept]
        return begin, count

    def lengths(self, w: W.Words) -> np.ndarray:
        """Ids of every document of a slice, without an end id."""
        if not self.by_word:
            return np.fromiter(map(len, self._whole(_texts(w))), np.int64, w.n_docs)
        if not len(w.starts):
            return np.zeros(w.n_docs, np.int64)
        w, hashes = self._pieces(w)
        return W.per_doc(self._words(w, hashes)[1], w.first)

    def encode(self, w: W.Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents of a slice, each with its end id, ids per document)."""
        if not self.by_word:
            found = [ids + [end_id] for ids in self._whole(_texts(w))]
            return (np.fromiter((i for ids in found for i in ids), np.int32),
                    np.fromiter(map(len, found), np.int64, len(found)))
        if not len(w.starts):
            return np.full(w.n_docs, end_id, np.int32), np.ones(w.n_docs, np.int64)
        w, hashes = self._pieces(w)
        begin, count = self._words(w, hashes)
        lengths = W.per_doc(count, w.first) + 1
        out = np.full(int(lengths.sum()), end_id, np.int32)
        # piece k of document d lies after all ids of earlier pieces and d end ids
        target = np.cumsum(count) - count + w.doc_of_word()
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        out[np.repeat(target, count) + step] = self.ids[np.repeat(begin, count) + step]
        return out, lengths


def _texts(w: W.Words) -> list[str]:
    data = w.data.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(w.offsets[:-1], w.offsets[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def lists(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
