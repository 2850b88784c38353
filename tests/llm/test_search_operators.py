"""Decontamination, personal data, repeats, Jaccard join and fingerprints by brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import decontaminate, jaccard_join, pii, repeats, spotsigs
from tests.llm.conftest import WORDS, lowered


def windows_of(text, size):
    w = WORDS.findall(lowered(text))
    m = min(size, len(w))
    return {tuple(w[j:j + m]) for j in range(len(w) - m + 1)} if m else set()


def search(docs, items, size):
    owners = defaultdict(set)
    for k, t in items:
        for w in windows_of(t, size):
            owners[w].add(str(k))
    out = {}
    for d, t in docs:
        w = WORDS.findall(lowered(t))
        hit, found = [0] * len(w), set()
        for m in {len(p) for p in owners}:
            for j in range(len(w) - m + 1):
                p = tuple(w[j:j + m])
                if p in owners:
                    found |= owners[p]
                    hit[j:j + m] = [1] * m
        out[d] = (len(w), sum(hit), sorted(found))
    return out


@pytest.mark.parametrize("block", [2 << 20, 30])
def test_decontamination(make, rnd, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    signs = ["a", "b", "Cc", "é", "9", "x" * 30, "中"]

    def text(n):
        return "".join(rnd.choice(signs) + rnd.choice([" ", ", ", "\n", "\0"]) for _ in range(n))

    items = [(i, text(rnd.choice([0, 1, 3, 5, 6, 12, 14]))) for i in range(5)] + [(3, "dup é")]
    docs = [(i, text(rnd.randint(0, 30)) + rnd.choice(items)[1] + text(rnd.randint(0, 9)))
            for i in range(200)] + [(1000, None), (1001, "")]
    found = decontaminate.find_benchmark(make(docs), make(items, "item_id long, text string"), 5)
    got = {r["doc_id"]: (r["n_words"], sum(h.stop - h.start for h in r["hits"]), list(r["items"]))
           for r in found.collect()}
    assert got == search(docs, items, 5)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def personal(text):
    spans, n = [], [0] * 4
    for k, (_, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else False,
                  12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[k]
            if ok:
                spans.append((m.start(), k, m.end()))
                n[k] += 1
    joined = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*n, hashlib.sha256(joined.encode()).hexdigest())


def test_personal_data(make, rnd):
    signs = ["a", "Z9", "0", "1", "25", "255", "4", "-", " ", ".", "@", "+", "(", ")", "é", "😀",
             "x.", "4111111111111111", "+1 (319) 555-5132", "\n"]
    docs = [(i, "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60)))) for i in range(800)]
    docs += [(9000, None), (9001, ""), (9002, "1" * 50_000), (9003, "a" * 50_000 + "@"),
             (9004, "1.2.3.4 " * 1500), (9005, "1 " * 20_000)]
    found = pii.find_pii(make(docs))
    got = {r["doc_id"]: tuple(r)[1:6] for r in
           found.select("doc_id", *pii.digests(found)).collect()}
    assert got == {d: personal(t) for d, t in docs}


def test_added_kinds_and_redaction(make):
    rows = [(1, "iban DE89370400440532013000 or DE89370400440532013001"),
            (2, "my ssn 123-45-6789, not 123-45-6780"), (3, "call +1 (319) 555-5132 or a@b.c ok"),
            (4, None)]
    out = {r["doc_id"]: r["text"] for r in pii.redact(make(rows)).collect()}
    assert out[1].startswith("iban [IBAN] or DE89")
    assert out[2].startswith("my ssn [SSN],")
    assert out[3] == "call [PHONE] or [EMAIL] ok"
    assert out[4] is None


def kept_bytes(texts, length):
    data, count = [(t or "").encode() for t in texts], defaultdict(int)
    for b in data:
        for p in range(len(b) - length + 1):
            count[b[p:p + length]] += 1
    out = []
    for b in data:
        mark = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                mark[p:p + length] = b"\1" * length
        out.append(bytes(x for x, m in zip(b, mark) if not m))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeats(make, rnd, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    signs = "abcdé "
    passages = ["".join(rnd.choice(signs) for _ in range(90)) for _ in range(6)]

    def text():
        return "".join(
            rnd.choice(passages)[rnd.randint(0, 30):rnd.randint(50, 90)] if rnd.random() < 0.6
            else "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 70)))
            for _ in range(rnd.randint(0, 6)))

    texts = [text() for _ in range(200)]
    texts += ["a" * 100, "a" * 39, "a" * 300, "ab" * 200, None, "", texts[0], texts[1]]
    out = repeats.remove_repeats(make(list(enumerate(texts))), 40).collect()
    got = {r["doc_id"]: bytes(r["kept"]) for r in out}
    assert [got[i] for i in range(len(texts))] == kept_bytes(texts, 40)
    for r in out:
        removed = sum(s.stop - s.start for s in r["removed"])
        assert removed + len(r["kept"]) == r["n_bytes"]


def by_links(docs, k, least, over):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and over * shared >= least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(docs)}


@pytest.mark.parametrize("least", [90, 75])
def test_jaccard_join(make, rnd, least):
    words = [f"w{i}" for i in range(40)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 60))] for _ in range(20)]
    docs = []
    for i in range(250):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        docs.append((i, " ".join(w + (rnd.choice(base) if rnd.random() < 0.2 else []))))
    docs += [(700, ""), (701, None), (702, " "), (703, "A"), (704, "a")]
    rule = jaccard_join.Rule(3, least, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard_join.jaccard_components(make(docs), rule).collect()}
    assert got == by_links(docs, 3, least, 100)


def test_fingerprints(make, rnd, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 7)
    signs = ["the ", "a ", "cat ", "dog ", "é😀 ", "x"]
    docs = {rnd.randrange(10 ** 6): "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60)))
            for _ in range(200)} | {10 ** 9: None, 10 ** 9 + 5: ""}
    order = sorted(docs, reverse=True)
    expected = {}
    for d, n in zip(order, order[1:] + order[:1]):
        t, k = docs[d] or "", len(docs[d] or "") // 3
        expected[d] = (len(t), t[:len(t) - k] + (docs[n] or "")[:k])
    rows = spotsigs.edited_and_next(make(list(docs.items()))).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited"]) for r in rows} == expected
    sets = {docs[r["doc_id"]] or "": r["spots"] for r in rows}
    for r in rows:
        a, b = set(r["spots"]), set(r["edited_spots"])
        assert sets[docs[r["doc_id"]] or ""] == r["spots"]
        assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9


def test_similar_pairs(make, rnd):
    base = [[rnd.randrange(10 ** 6) for _ in range(rnd.randint(1, 40))] for _ in range(10)]
    rows = []
    for i in range(80):
        s = set(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 5])):
            s.add(rnd.randrange(10 ** 6))
        rows.append((i, sorted(s)))
    got = {(r["a"], r["b"]) for r in
           spotsigs.similar_pairs(make(rows, "doc_id long, spots array<long>")).collect()}
    first = {}
    for i, s in rows:
        first.setdefault(tuple(s), i)
    expected = set()
    for s, i in first.items():
        for t, j in first.items():
            if (len(s), i) < (len(t), j) and len({*s} & {*t}) >= 0.8 * len({*s} | {*t}):
                expected.add((i, j))
    assert got == expected


def followers(rows):
    """(key, text) -> text of the row that follows, by descending key and any order of equals."""
    keys = sorted({k for k, _ in rows if k is not None}, reverse=True) + (
        [None] if any(k is None for k, _ in rows) else [])
    by_key = {k: sorted(t for x, t in rows if x == k) for k in keys}
    return keys, by_key


@pytest.mark.parametrize("kind", ["even", "hashes", "clusters", "wide", "hot", "nulls", "one"])
def test_next_rows_of_any_keys(spark, rnd, monkeypatch, kind):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 20)
    n = 700
    ids = {
        "even": list(range(n)),
        "hashes": [rnd.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(n)],
        "clusters": [*range(n - 1), 10 ** 15],
        "wide": [-2 ** 62 - 5, 5, 2 ** 63 - 1, -2 ** 63, *range(2 ** 62, 2 ** 62 + n)],
        "hot": [7] * n + list(range(200)),
        "nulls": [None] * n + list(range(200)),
        "one": [3],
    }[kind]
    rows = [(k, f"text {i % 50 if kind in ('hot', 'nulls') else i}") for i, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = [tuple(r) for r in spotsigs.with_next(df, ["text"]).collect()]
    assert sorted(out, key=str) and sorted(((k, t) for k, t, _ in out), key=str) == sorted(rows, key=str)
    keys, by_key = followers(rows)
    for at, k in enumerate(keys):
        # The rows of a key form a chain into the first row of the next key.
        own = [(t, x) for q, t, x in out if q == k]
        after = by_key[keys[(at + 1) % len(keys)]]
        outside = sorted(x for _, x in own)
        inside = sorted(t for t, _ in own)
        for t in inside:
            if t in outside:
                outside.remove(t)
        assert len(outside) <= 1 and all(x in after for x in outside)
    # Every text is the next one of just as many rows as have it.
    assert sorted(x for _, _, x in out) == sorted(t for _, t in rows)
    ranges = df.withColumn("_h", F.xxhash64("text"))
    number, _ = spotsigs._ranges(ranges, "doc_id", F.col("_h"))
    largest = ranges.groupBy(number).count().agg(F.max("count")).first()[0]
    assert largest <= (140 if kind in ("hot", "nulls") else 60)
