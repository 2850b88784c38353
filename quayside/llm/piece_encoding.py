"""Encoding and decoding with a sentencepiece BPE model, by a merge-type prefix table.

In BPE every prefix of a text ends with one definite token: the last one of the prefix's
own encoding.  A token sequence is an encoding exactly when each of its tokens encodes to
itself and each two neighbours encode to just these two.  So the table is filled from left
to right: an automaton gives the pieces that end at a position, and the one that encodes to
itself and is compatible with the last token of the prefix before it is the entry.  The ids
are then read backwards, from the last entry to the beginning.

Texts are first cut wherever no piece of the vocabulary has the two bytes side by side, as
before a blank: no merge can cross such a place.  A chunk of up to ``CACHED_BYTES`` is
encoded once per worker and found again by its 64-bit hash.

The normalisation is that of an identity model with a dummy prefix: blanks and U+2581 are
the same sign, and a text that is not empty gets one before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.common import encoded, hash_ranges, prepare, slices, text_column

BLANK = "▁"
#: Longer chunks are encoded anew each time.
CACHED_BYTES = 64
#: Cached chunks per worker; the cache starts anew beyond that.
MAX_CACHED = 1_000_000
#: Remembered compatibility tests per worker.
MAX_PAIRS = 2_000_000
_SLOTS = 1 << 22


class PieceModel:
    """Pieces, scores and the tests of a BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.end = model.eos_id()
        self.text: list[str] = [""] * size
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.bytes_of: list[bytes] = [b""] * size
        self.is_byte = np.zeros(size, bool)
        self.unknown = model.unk_id()
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_id[value] = i
                self.bytes_of[i] = bytes([value])
                self.is_byte[i] = True
            elif i == self.unknown:
                self.bytes_of[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                piece = model.id_to_piece(i).replace(BLANK, " ")
                self.text[i], self.id[piece], self.score[piece] = piece, i, model.get_score(i)
                self.bytes_of[i] = piece.encode()
        self._itself: dict[int, bool] = {}
        self._pair: dict[int, bool] = {}
        self._automaton = None

    def merged(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best pair first, of equal ones the leftmost."""
        parts, score = list(text), self.score
        while True:
            at, best = -1, float("-inf")
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and s > best:
                    at, best = i, s
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def itself(self, i: int) -> bool:
        """Whether piece ``i`` is the encoding of its own text."""
        known = self._itself.get(i)
        if known is None:
            known = self._itself[i] = self.merged(self.text[i]) == [self.text[i]]
        return known

    def compatible(self, i: int, j: int) -> bool:
        """Whether the texts of ``i`` and ``j``, put together, encode to these two."""
        key = i << 32 | j
        known = self._pair.get(key)
        if known is None:
            if len(self._pair) > MAX_PAIRS:
                self._pair.clear()
            a, b = self.text[i], self.text[j]
            known = self._pair[key] = self.merged(a + b) == [a, b]
        return known

    def joins(self) -> np.ndarray:
        """256 x 256: whether a text may not be cut between two bytes.

        That is before a continuation byte, and between the bytes of two characters that
        stand side by side in some piece.
        """
        out = np.zeros((256, 256), bool)
        out[:, 0x80:0xC0] = True
        for piece in self.id:
            raw = np.frombuffer(piece.encode(), np.uint8)
            out[raw[:-1], raw[1:]] = True
        return out

    def encode_chunks(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks one after the other, and the number of each chunk's ids.

        Blanks stand as they are; neither a dummy prefix nor an end id is added.  The
        chunks are one run of the automaton, each with a sign of no piece after it.
        """
        if self._automaton is None:
            from ahocorasick import Automaton

            self._automaton = Automaton()
            for piece, i in self.id.items():
                self._automaton.add_word(piece, (i, len(piece)))
            self._automaton.make_automaton()
            self._stop = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in self.id)
        text = self._stop.join([*chunks, ""])
        # Per prefix its last token; -1: a character that goes by its bytes, or nothing.
        last, size = [-1] * (len(text) + 1), [1] * (len(text) + 1)
        pair = self._pair
        for at, (i, length) in self._automaton.iter(text):
            if last[at + 1] < 0:
                before = last[at + 1 - length]
                if before < 0:
                    fits = self.itself(i)
                else:  # a compatible token also encodes to itself
                    fits = pair.get(before << 32 | i)
                    if fits is None:
                        fits = self.compatible(before, i)
                if fits:
                    last[at + 1], size[at + 1] = i, length
        ids: list[int] = []
        counts: list[int] = []
        stop = len(text)
        for chunk in reversed(chunks):
            stop -= 1
            begin, had = stop - len(chunk), len(ids)
            while stop > begin:
                if last[stop] >= 0:
                    ids.append(last[stop])
                else:
                    ids.extend(self.byte_id[b] for b in reversed(
                        text[stop - 1].encode("utf-8", "surrogatepass")))
                stop -= size[stop]
            counts.append(len(ids) - had)
        return np.array(ids[::-1], np.int32), np.array(counts[::-1], np.int64)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of a row of ids: one blank of a first piece goes, bytes that are not UTF-8
        become U+FFFD, control ids give nothing."""
        flat = np.asarray(ids, np.int64)
        own = [self.bytes_of[i] for i in flat.tolist()]
        first = next((k for k, b in enumerate(own) if b), None)
        if first is not None and self.text[flat[first]].startswith(" "):
            own[first] = own[first][1:]
        if all(own[:-1]):  # a control id within ends a row of bytes
            try:
                return b"".join(own).decode()
            except UnicodeDecodeError:
                pass
        out = []
        edge = np.flatnonzero(np.diff(self.is_byte[flat], prepend=False, append=False))
        begin = 0
        for a, b in zip(edge[0::2], edge[1::2]):
            out += [b"".join(own[begin:a]).decode(), _lenient(b"".join(own[a:b]))]
            begin = b
        return "".join(out) + b"".join(own[begin:]).decode()


def _lenient(raw: bytes) -> str:
    """UTF-8, each byte that belongs to no character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


class PieceEncoder:
    """Encodes batches of texts, through a table of chunks already encoded."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.joined = self.model.joins().ravel()
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(_SLOTS, np.uint64)
        self.begin = np.zeros(_SLOTS, np.int64)
        self.count = np.zeros(_SLOTS, np.int32)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = self.known = 0

    def _slot(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each hash, and whether it holds that hash (else it is free)."""
        mask = np.uint64(_SLOTS - 1)
        slot = (h & mask).astype(np.int64)
        todo = np.flatnonzero((self.key[slot] != h) & (self.key[slot] != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (_SLOTS - 1)
            there = self.key[slot[todo]]
            todo = todo[(there != h[todo]) & (there != 0)]
        return slot, self.key[slot] == h

    def _learn(self, h: np.ndarray, chunks: list[str]) -> None:
        """Encode new chunks and enter them under their distinct hashes."""
        ids, counts = self.model.encode_chunks(chunks)
        begin = self.used + np.cumsum(counts) - counts
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.known += len(h)
        todo = np.arange(len(h))
        while len(todo):  # of two hashes that want one free slot the last gets it
            slot, _ = self._slot(h[todo])
            self.key[slot] = h[todo]
            won = self.key[slot] == h[todo]
            self.begin[slot[won]], self.count[slot[won]] = begin[todo][won], counts[todo][won]
            todo = todo[~won]

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (n + 1)."""
        raw = [b" " + t.replace(BLANK.encode(), b" ") if t else b"" for t in texts]
        buffer = b"".join([*raw, b"\0" * 16])
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        text_at = np.concatenate([[0], np.cumsum(sizes)])
        total = int(text_at[-1])
        if not total:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        byte = np.frombuffer(buffer, np.uint8)[:total]
        cut = np.ones(total + 1, bool)
        cut[1:-1] = ~self.joined[byte[:-1].astype(np.int32) << 8 | byte[1:]]
        cut[text_at] = True
        edge = np.flatnonzero(cut)
        begin, size = edge[:-1], np.diff(edge)

        short = np.flatnonzero(size <= CACHED_BYTES)
        h = hash_ranges(np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,)),
                        begin[short], size[short])
        h |= h == 0
        slot, found = self._slot(h)
        if not found.all():
            if self.known > MAX_CACHED:
                self._forget()
                found[:] = False
            missing = np.flatnonzero(~found)
            new, at = np.unique(h[missing], return_index=True)
            self._learn(new, [_text(buffer, begin[k], size[k]) for k in short[missing[at]]])
            slot, _ = self._slot(h)

        n = np.zeros(len(begin), np.int64)
        n[short] = self.count[slot]
        long = np.flatnonzero(size > CACHED_BYTES)
        long_ids, n[long] = self.model.encode_chunks(
            [_text(buffer, begin[k], size[k]) for k in long])
        stop = np.cumsum(n)
        source = np.zeros(len(begin), np.int64)
        source[short] = self.begin[slot]
        at = np.repeat(source - (stop - n), n)
        at += np.arange(len(at))
        flat = self.ids[at % len(self.ids)]
        if len(long):
            own = np.zeros(len(begin), bool)
            own[long] = True
            flat[np.repeat(own, n)] = long_ids
        of_text = np.searchsorted(begin, text_at)
        return flat, np.concatenate([[0], stop])[of_text]


def _text(buffer: bytes, begin: int, size: int) -> str:
    return buffer[begin:begin + size].decode("utf-8", "surrogatepass")


def _encode(batches: Iterator[pa.RecordBatch], path: str, names: list[str]):
    encoder = None
    for batch in batches:
        encoder = encoder or PieceEncoder(path)
        texts = encoded(batch.column("_text").to_pylist())
        for a, b in slices([len(t) for t in texts]):
            flat, at = encoder.encode(texts[a:b])
            # An end id after the ids of each text.
            ids = np.insert(flat, at[1:], encoder.model.end)
            at = at + np.arange(len(at))
            part = batch.slice(a, b - a).select(names)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                                         pa.array(ids, pa.int32()))],
                [*names, "ids"])


def encode(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",),
           text: str = "text") -> DataFrame:
    """``keep`` columns and ``ids``: the whole text as ids of the model, then its end id.

    A null or empty text has the end id only.  Repeated rows stay as they are, no rows give
    none, and columns beside those named are not read.  Memory follows the longest text.
    ``model_path`` is a file that every task can read, such as one of an installed package.
    """
    prepare(docs.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}"
                       for c, n in zip(keep, names))
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)],
                       text_column(docs, text).alias("_text"))
    return rows.mapInArrow(lambda it: _encode(it, model_path, names), f"{schema}, ids array<int>") \
        .toDF(*keep, "ids")


def _decode(batches: Iterator[pa.RecordBatch], path: str, names: list[str], digest: bool):
    model = None
    for batch in batches:
        if model is None:
            model = PieceModel(path)
            written = np.array([str(i).encode() for i in range(len(model.text))], object)
        column = batch.column("ids")
        for a, b in slices([8 * (len(x) if x.is_valid else 0) for x in column]):
            part = batch.slice(a, b - a)
            rows = [None if not x.is_valid else x.values.to_numpy()
                    for x in part.column("ids")]
            out = [None if x is None else model.decode(x) for x in rows]
            columns, labels = [*part.select(names).columns], [*names]
            if digest:
                joined = [b"" if x is None else b" ".join(written[x].tolist()) for x in rows]
                columns += [pa.array([0 if x is None else len(x) for x in rows], pa.int64()),
                            pa.array([hashlib.sha256(x).hexdigest() for x in joined]),
                            pa.array([hashlib.sha256(x).hexdigest() for x in encoded(out)])]
                labels += ["n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                columns.append(pa.array(out, pa.string()))
                labels.append("text")
            yield pa.RecordBatch.from_arrays(columns, labels)


def _from_ids(rows: DataFrame, model_path: str, keep: tuple[str, ...], digest: bool,
              added: str) -> DataFrame:
    prepare(rows.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    schema = ", ".join(f"{n} {rows.schema[c].dataType.simpleString()}"
                       for c, n in zip(keep, names))
    out = rows.select(*[rows[c].alias(n) for c, n in zip(keep, names)], rows["ids"].alias("ids")) \
        .mapInArrow(lambda it: _decode(it, model_path, names, digest), f"{schema}, {added}")
    return out.toDF(*keep, *out.columns[len(keep):])


def decode(rows: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text``, decoded from ``ids``; null ids give a null text."""
    return _from_ids(rows, model_path, keep, False, "text string")


def digests(rows: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the number of ids and digests of the ids and of the decoded text."""
    return _from_ids(rows, model_path, keep, True,
                     "n_tokens long, ids_sha256 string, decoded_sha256 string")
