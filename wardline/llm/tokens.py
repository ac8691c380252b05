"""Whole texts to token ids with the tokenizers library, each distinct word encoded once.

Both kinds of tokenizer cut a text at white space before anything else, so a text's ids are the ids of
its words one after the other. Texts whose white space is not plain are encoded whole. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from wardline.llm.words import WordHasher, mix, slices

#: Distinct words whose ids a worker keeps; beyond that it starts anew.
REMEMBERED = 1_500_000
NEAR_BITS = 21


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """``path``: a file of the tokenizers library; ``spaces``: whether ids depend on the white space before a word."""

    #: White space that only one of Python, Unicode and the tokenizers counts as such, or that is not ASCII.
    _ODD = re.compile(r"[\x1c-\x1f]|[^\S\x20\x09-\x0d]")

    def __init__(self, path: str, spaces: bool, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.spaces, self.remembered = Tokenizer.from_file(path), spaces, remembered
        self.hasher = WordHasher(31, fold=not spaces)
        if spaces:
            words = self.tokenizer.get_vocab()
            self.begins = np.zeros(max(words.values()) + 1, bool)
            self.begins[[i for t, i in words.items() if t[0] in "ĠĊ"]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.names = np.zeros(0, np.uint64)  # hashes of the words, in order
        self.place = np.zeros(0, np.int64)   # which entry of the ids each has
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # The word last met at each of many places, by the first bits of its hash; common words are found here.
        self.near, self.entry = np.zeros(1 << NEAR_BITS, np.uint64), np.zeros(1 << NEAR_BITS, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, words: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words, some hundreds together, and how many each word has; with its white space where that counts."""
        ids, lengths = [], []
        for a in range(0, len(words), 1000):
            some = words[a : a + 1000]
            raw = (b"" if self.spaces else b" ").join(some)
            if self.spaces:
                found = self.whole(raw.decode())
                starts = np.flatnonzero(self.begins[found])
            else:
                got = self.tokenizer.encode(raw.decode(), add_special_tokens=False)
                found = np.array(got.ids, np.uint32)
                sizes = np.fromiter(map(len, some), np.int64, len(some)) + 1
                characters = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)])
                places = np.fromiter((x for x, _ in got.offsets), np.int64, len(found))
                starts = np.searchsorted(places, characters[np.cumsum(sizes) - sizes])
            if len(starts) == len(some) and starts[0] == 0:
                ids.append(found)
                lengths.append(np.diff(np.append(starts, len(found))))
            else:  # special tokens among them: one by one
                each = [self.whole(w.decode()) for w in some]
                ids += each
                lengths.append(np.array([len(x) for x in each], np.int64))
        return ids, lengths

    def _learn(self, names: np.ndarray, words: list[bytes]) -> None:
        """Keeps the ids of words under their hashes, which are in order."""
        first = np.array([self.spaces and w[:1] not in (b" ", b"\n") for w in words], bool)
        order = np.concatenate([np.flatnonzero(~first), np.flatnonzero(first)])
        ids, lengths = self._encode([words[k] for k in np.flatnonzero(~first)])
        alone = [self.whole(words[k].decode()) for k in np.flatnonzero(first)]
        lengths = np.concatenate([*lengths, np.array([len(x) for x in alone], np.int64)])
        if len(self.names) + len(names) > self.remembered:
            self._forget()
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names)) + len(self.starts) - 1
        self.ids = np.concatenate([self.ids, *ids, *alone])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        at = np.searchsorted(self.names, names)
        self.names, self.place = np.insert(self.names, at, names), np.insert(self.place, at, place)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that are the words one after the other; where spaces count, one blank or new line between them."""
        rows = np.ones(len(offsets) - 1, bool)
        raw = data.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                rows[np.searchsorted(offsets, at, "right") - 1] = False
                at = raw.find(token, at + 1)
        odd = _ODD_LEAD[data]
        if self.spaces:
            blank = (data == 32) | (data == 10)
            odd = odd | _ODD_BLANK[data]
            double = blank.copy()
            double[1:] &= blank[:-1]
            double[:1] = False
            edges = np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1])
            double[edges[blank[edges]]] = True
            rows[np.searchsorted(offsets, np.flatnonzero(double | _ODD_BLANK[data]), "right") - 1] = False
        for r in np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1).tolist():
            if rows[r] and self._ODD.search(data[offsets[r] : offsets[r + 1]].tobytes().decode()):
                rows[r] = False
        return rows

    def encode(self, column: pa.Array, limit: int = 4 << 20):
        """``(first row, ids, offsets of the rows in them)`` for slices of a text column; null is the empty text."""
        for i, j, data, offsets in slices(column, limit):
            plain = self._plain(data, offsets)
            cuts = None
            if not self.spaces and len(data):
                # Letters, digits and signs are cut apart by these tokenizers; beyond ASCII, and at an
                # apostrophe, the words are left to them.
                kind = _KIND[data]
                cuts = (kind[:-1] != kind[1:]) & (kind[:-1] > 0) & (kind[1:] > 0)
            words = self.hasher.words(data, offsets, cuts)
            names = words.hash
            if self.spaces:
                before = np.where(words.start == offsets[words.doc], 0, data[np.maximum(words.start - 1, 0)])
                names = mix(names + before.astype(np.uint64))
            used = plain[words.doc]
            names, doc, start, stop = (x[used] for x in (names, words.doc, words.start, words.stop))
            spot = (names >> np.uint64(64 - NEAR_BITS)).astype(np.int64)
            met = self.near[spot] == names
            entry = self.entry[spot].astype(np.int64)
            far = np.flatnonzero(~met)
            unique, first, back = np.unique(names[far], return_index=True, return_inverse=True)
            first = far[first]
            at = np.minimum(np.searchsorted(self.names, unique), max(0, len(self.names) - 1))
            missing = np.flatnonzero(self.names[at] != unique) if len(self.names) else np.arange(len(unique))
            if len(missing):
                if len(self.names) + len(missing) > self.remembered:
                    self._forget()
                    far = np.arange(len(names))
                    unique, first, back = np.unique(names, return_index=True, return_inverse=True)
                    missing = np.arange(len(unique))
                raw = data.tobytes()
                a, b = start[first[missing]], stop[first[missing]]
                if self.spaces:
                    a = a - (a > offsets[doc[first[missing]]])
                self._learn(unique[missing], [raw[x:y] for x, y in zip(a.tolist(), b.tolist())])
                at = np.searchsorted(self.names, unique)
            if len(far):
                found = self.place[at]
                entry[far] = found[back]
                spot = (unique >> np.uint64(64 - NEAR_BITS)).astype(np.int64)
                self.near[spot], self.entry[spot] = unique, found
            lengths = (self.starts[1:] - self.starts[:-1])[entry]
            ends = np.cumsum(lengths)
            ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[entry] - (ends - lengths), lengths)]
            sizes = np.bincount(doc, lengths, minlength=j - i).astype(np.int64)
            for r in np.flatnonzero(~plain).tolist():
                other = self.whole(data[offsets[r] : offsets[r + 1]].tobytes().decode())
                cut = int(sizes[:r].sum())
                ids, sizes[r] = np.concatenate([ids[:cut], other, ids[cut:]]), len(other)
            yield i, ids, np.concatenate([[0], np.cumsum(sizes)])


_ODD_LEAD = np.zeros(256, bool)
_ODD_LEAD[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True  # the last four begin white space beyond ASCII
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]], _KIND[48:58], _KIND[128:], _KIND[39] = 1, 2, 0, 0
_ODD_BLANK = np.zeros(256, bool)
_ODD_BLANK[[0x09, 0x0B, 0x0C, 0x0D]] = True
_LOADED: dict[tuple, WordTokens] = {}


def tokens_of(path: str, spaces: bool) -> WordTokens:
    """This worker's tokenizer with the words it has met."""
    if (path, spaces) not in _LOADED:
        _LOADED[path, spaces] = WordTokens(path, spaces)
    return _LOADED[path, spaces]


def forget_tokens() -> None:
    """Frees this worker's tokenizers and their words."""
    _LOADED.clear()
