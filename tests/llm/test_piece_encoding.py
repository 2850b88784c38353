"""Encoding and decoding against the sentencepiece library, and plain BPE."""

import hashlib

import pytest

from quayside.llm import piece_encoding, queries
from quayside.llm.common import slices
from quayside.llm.piece_encoding import PieceEncoder

SIGNS = "aabbc  deéñ日本▁\n\t\x00'x12<>🙂\u0301\U0010ffff"
PARTS = "the of and tion ing er in an re on at en is it al ar".split()


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def encoder(path):
    return PieceEncoder(path)


def ids_of(encoder, texts):
    raw, out = [t.encode() for t in texts], []
    for a, b in slices([len(r) for r in raw], 4000):
        flat, at = encoder.encode(raw[a:b])
        out += [flat[at[i]:at[i + 1]].tolist() for i in range(b - a)]
    return out


def test_as_the_library(encoder, library, rnd):
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += [" " * k + "x" + " " * j for k in range(36) for j in range(0, 36, 5)]
    texts += ["".join(rnd.choice([*PARTS, " "]) for _ in range(200)) for _ in range(300)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0, 127), rnd.randint(128, 0xD7FF),
                                      rnd.randint(0xE000, 0x10FFFF)])) for _ in range(20))
              for _ in range(500)]
    texts += ["", " ", "x" * 50_000, "aaaaab" * 999, "<s></s><unk><0x0A>", "the " * 3000,
              "日本語" * 2000]
    expected = library.encode(texts)
    assert ids_of(encoder, texts) == expected
    assert ids_of(encoder, texts[::-1]) == expected[::-1]  # from the cache
    for ids in expected:
        assert encoder.model.decode([*ids, 2]) == library.decode([*ids, 2])


def test_the_prefix_table_is_plain_bpe(encoder, rnd):
    model = encoder.model
    for _ in range(300):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 12)))
        ids, counts = model.encode_chunks([text, " " + text])
        assert [model.text[i] for i in ids[:counts[0]]] == model.merged(text)
        assert [model.text[i] for i in ids[counts[0]:]] == model.merged(" " + text)


def test_decode_any_ids(encoder, library, rnd):
    for _ in range(3000):
        ids = [rnd.choice([rnd.randint(0, 31999), rnd.randint(0, 260)])
               for _ in range(rnd.randint(0, 12))]
        assert encoder.model.decode(ids) == library.decode(ids)


def test_a_full_cache_starts_anew(path, library, monkeypatch, rnd):
    monkeypatch.setattr(piece_encoding, "MAX_CACHED", 50)
    monkeypatch.setattr(piece_encoding, "MAX_PAIRS", 20)
    encoder = PieceEncoder(path)
    texts = [" ".join(rnd.choice(PARTS) + rnd.choice(PARTS) for _ in range(30)) for _ in range(60)]
    for _ in range(3):
        assert [ids_of(encoder, [t])[0] for t in texts] == library.encode(texts)


def expected(rows, library):
    out = []
    for doc_id, text in rows:
        ids = [*library.encode(text or ""), 2]
        digest = [hashlib.sha256(x.encode()).hexdigest()
                  for x in (" ".join(map(str, ids)), library.decode(ids))]
        out.append((doc_id, len(ids), *digest))
    return sorted(out, key=str)


def test_odd_and_empty_tables(spark, odd, empty, path, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = piece_encoding.digests(piece_encoding.encode(odd, path), path)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, library)
    keep = ("doc_id", "hits")
    whole = piece_encoding.decode(piece_encoding.encode(odd, path, keep), path, keep)
    assert sorted((r["doc_id"], r["text"]) for r in whole.collect() if r["doc_id"]) == sorted(
        (i, t or "") for i, t in rows if i)
    assert piece_encoding.digests(piece_encoding.encode(empty, path), path).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {tuple(r) for r in piece_encoding.decode(nulls, path).collect()} == {(1, None), (2, "")}


def test_query(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op13_pieces(spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected([tuple(r) for r in docs], library)
