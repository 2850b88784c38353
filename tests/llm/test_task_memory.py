"""What a task's Python worker holds while it works on a batch of texts, and after it."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import language_id, packing, quality, tokens


@pytest.fixture()
def texts(rnd):
    return [" ".join(f"w{rnd.randint(0, 50_000)}" for _ in range(500)) for _ in range(1200)]


def test_the_piece_table_follows_the_pieces(tokenizer, texts):
    words = tokens.WordTokenizer(tokenizer)
    assert words.key.nbytes + words.value.nbytes <= 1 << 20
    words.encode(texts)
    assert 2 * words.known <= len(words.key) <= max(tokens._SLOTS, 4 * words.known)
    before = words.known
    words.encode(texts)
    assert words.known == before  # found again after the table has grown


def test_a_grown_or_emptied_table_gives_the_same_ids(tokenizer, texts, monkeypatch):
    plain = tokens.WordTokenizer(tokenizer).tokenizer
    some = texts[:60]
    expected = [e.ids for e in plain.encode_batch(some, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "_SLOTS", 8)
    monkeypatch.setattr(tokens, "_ENCODED", 1000)
    for most in (1_000_000, 5):  # the second one forgets its pieces again and again
        monkeypatch.setattr(tokens, "MAX_CACHED", most)
        words = tokens.WordTokenizer(tokenizer)
        assert [x.tolist() for text in some for x in words.encode([text])] == expected
        assert [x.tolist() for x in words.encode(some)] == expected


def test_scoring_holds_a_small_part_of_a_batch(texts):
    """4 MB of text in one batch: the features of a slice, not of a megabyte, at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["_text", "c0"])
    model = SimpleNamespace(value=quality.Model(
        np.linspace(-1, 1, quality.BUCKETS).astype(np.float32), np.array([0.0, 1.0])))
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in quality._score(iter([batch]), model, ["c0"]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts)
    assert peak < 40e6


def test_freed_memory_goes_back_after_each_task(monkeypatch, tokenizer):
    given = []
    for module in (quality, packing):
        monkeypatch.setattr(module, "give_back", lambda m=module: given.append(m))
    list(quality._score(iter([]), None, []))
    list(packing._cut(iter([]), None, None))
    assert given == [quality, packing]


def a_model(rnd, k=3):
    entries = sorted(rnd.sample(range(k * language_id.BUCKETS), 3000))
    bucket = np.array([e // k for e in entries])
    return language_id.Model(
        [f"l{i}" for i in range(k)], np.searchsorted(bucket, np.arange(language_id.BUCKETS + 1)),
        np.array([e % k for e in entries], np.int32), np.array([rnd.random() for _ in entries]),
        np.array([-9.0 - i for i in range(k)]))


def test_a_long_page_is_scored_in_parts(rnd):
    text = " ".join(f"w{rnd.randint(0, 50_000)} {chr(rnd.randint(97, 122)) * 3}" for _ in range(400_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "abc def"]), pa.array([1, 2])], ["text", "key"])
    tracemalloc.start()
    try:
        rows = [out.num_rows for out in language_id._text_scores(
            iter([batch]), SimpleNamespace(value=a_model(rnd)))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(rows) == 2
    assert peak < 12 * len(text)


def test_parts_of_a_text_count_like_the_whole(rnd, monkeypatch):
    letters = ["a", "B", "z", "é", "中", "\U0001f600", "\ud800", " ", "\n", "1", "<", "\0"]
    texts = ["".join(rnd.choices(letters, k=n)) for n in (17, 33, 64, 400, 5000)]
    texts += [" " * 50, "ab" * 30, "  ab  " + "." * 40, "中" * 40]
    monkeypatch.setattr(language_id, "SLICE", 16)
    for text in texts:
        bucket, times = np.unique(language_id.trigrams([text])[0], return_counts=True)
        of, at, n, size = language_id.counted([text])
        assert (of == 0).all() and at.tolist() == bucket.tolist() and n.tolist() == times.tolist()
        assert size.tolist() == [times.sum()]


def test_scores_do_not_depend_on_the_slices(rnd, monkeypatch):
    texts = ["".join(rnd.choices("abcdefgh .", k=rnd.choice([0, 1, 5, 300, 900]))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(60))], ["text", "key"])
    model, found = SimpleNamespace(value=a_model(rnd)), []
    for size in (1 << 20, 500):
        monkeypatch.setattr(language_id, "SLICE", size)
        found.append(pa.Table.from_batches(language_id._text_scores(iter([batch]), model)).to_pydict())
    assert found[0] == found[1]


def test_language_tasks_give_freed_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(language_id, "give_back", lambda: given.append(1))
    list(language_id._trigram_counts(iter([])))
    list(language_id._text_scores(iter([]), SimpleNamespace(value=language_id.Model([], *[None] * 4))))
    assert len(given) == 2
