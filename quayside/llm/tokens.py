"""Token ids of whole texts by the word BPE tokenizer, through a cache of words.

The tokenizer lower-cases, cuts a text into letter runs, single digits and runs
of other signs, and encodes each piece by itself.  So the ids of a text are the
ids of its pieces, and a piece needs encoding once per worker.  Texts made of
Latin-1 characters without contractions are cut with numpy and looked up by
64-bit piece hash; all other texts go to the tokenizer as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import numpy as np

from quayside.llm.common import hash_ranges, slices

#: Cached pieces per worker; the cache starts anew beyond that.
MAX_CACHED = 400_000
#: Slots of an empty table; it doubles before it is more than half full.
_SLOTS = 1 << 16
#: Characters given to the tokenizer at a time: its results take some hundred bytes a token.
_ENCODED = 1 << 17
_SIZE_BITS = 24
_SIZE = (1 << _SIZE_BITS) - 1
#: A contraction is a piece of its own; special token strings are no text.
_OWN_WAY = re.compile(r"'(?:[stmd]|re|ve|ll)|<\|(?:start|end)oftext\|>", re.IGNORECASE)


def _classes() -> bytes:
    """0 white space, 1 letter, 2 digit or other number, 3 other, by Latin-1 code."""
    out = bytearray(256)
    for code in range(256):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if code in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
            out[code] = 0
        else:
            out[code] = {"L": 1, "N": 2}.get(kind[0], 3)
    return bytes(out)


_CLASS = _classes()


class WordTokenizer:
    """Encodes batches of texts to uint16 id arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit 16-bit ids")
        self.is_end = np.zeros(1 << 16, bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.is_end[i] = piece.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        """Empty the piece table: open addressing, piece hash -> begin and size of its ids."""
        self._empty_table(_SLOTS)
        self.known = 0
        self.ids = np.zeros(0, np.uint16)

    def _empty_table(self, slots: int) -> None:
        self.key = np.zeros(slots, np.uint64)
        self.value = np.zeros(slots, np.int64)

    def _room_for(self, more: int) -> None:
        """Double the table until it is at most half full with so many new pieces."""
        slots = len(self.key)
        while 2 * (self.known + more) > slots:
            slots *= 2
        if slots > len(self.key):
            at = np.flatnonzero(self.key)
            h, value = self.key[at], self.value[at]
            self._empty_table(slots)
            self._put(h, value)

    def _put(self, h: np.ndarray, value: np.ndarray) -> None:
        """Enter distinct hashes that the table does not hold."""
        todo = np.arange(len(h))
        while len(todo):
            slot, there = self._find(h[todo])
            self.key[slot[~there]] = h[todo][~there]
            won = self.key[slot] == h[todo]
            self.value[slot[won]] = value[todo][won]
            todo = todo[~won]

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text by the tokenizer, few texts at a time."""
        return [np.asarray(e.ids, np.uint16)
                for a, b in slices([len(t) for t in texts], _ENCODED)
                for e in self.tokenizer.encode_batch(texts[a:b], add_special_tokens=False)]

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each hash, and whether the slot holds it (else it is free)."""
        last = len(self.key) - 1
        slot = (h & np.uint64(last)).astype(np.int64)
        there = self.key[slot]
        todo = np.flatnonzero((there != h) & (there != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & last
            there = self.key[slot[todo]]
            todo = todo[(there != h[todo]) & (there != 0)]
        return slot, self.key[slot] == h

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, lowered, other = [], [], []
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, np.uint16)
                continue
            if "'" not in text and "<|" not in text or not _OWN_WAY.search(text):
                try:
                    lowered.append(text.lower().encode("latin-1"))
                    plain.append(i)
                    continue
                except UnicodeEncodeError:
                    pass
            other.append(i)
        for i, ids in zip(other, self._encoded([texts[i] for i in other])):
            out[i] = ids
        for a, b in slices([len(t) for t in lowered], 1 << 18):
            for i, ids in zip(plain[a:b], self._plain(lowered[a:b])):
                out[i] = ids
        return out

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = b" ".join([b"", *texts, b" " * 16])
        kind = np.frombuffer(raw.translate(_CLASS), np.uint8)
        cut = kind[1:] != kind[:-1]
        cut |= kind[1:] == 2
        edge = np.flatnonzero(cut) + 1
        begin = edge[kind[edge] != 0]
        stop = np.append(edge[1:], len(kind))[kind[edge] != 0]
        h = hash_ranges(np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)), begin, stop - begin)
        h |= h == 0
        slot, found = self._find(h)
        value = self.value[slot]
        if not found.all():
            if self.known > MAX_CACHED:
                self._forget()
                found[:] = False
            missing = np.flatnonzero(~found)
            _, at = np.unique(h[missing], return_index=True)
            at = missing[at]
            self._learn(h[at], [raw[s:e].decode("latin-1") for s, e in zip(begin[at], stop[at])])
            value[missing] = self.value[self._find(h[missing])[0]]
        size = value & _SIZE
        start = value >> _SIZE_BITS
        total = np.cumsum(size)
        source = np.repeat(start - (total - size), size)
        source += np.arange(len(source))
        flat = self.ids[source]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        first = np.searchsorted(begin, np.concatenate([[1], 1 + np.cumsum(sizes)]))
        at = np.concatenate([[0], total])[first]
        return [flat[at[i]:at[i + 1]] for i in range(len(texts))]

    def _learn(self, h: np.ndarray, pieces: list[str]) -> None:
        """Encode new pieces, many at a time; a piece ends with a word-end token."""
        texts = [" ".join(pieces[i:i + 500]) for i in range(0, len(pieces), 500)]
        flat = np.concatenate(self._encoded(texts))
        stop = np.flatnonzero(self.is_end[flat]) + 1
        if len(stop) != len(pieces):
            raise ValueError("the tokenizer does not end each piece with a word-end token")
        begin = np.concatenate([[0], stop[:-1]])
        value = ((begin + len(self.ids)) << _SIZE_BITS) | (stop - begin)
        self._room_for(len(h))
        self._put(h, value)
        self.known += len(h)
        self.ids = np.concatenate([self.ids, flat])
