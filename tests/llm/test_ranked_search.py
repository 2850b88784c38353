"""Ranked search against a plain score of every document."""

import math
import re
from collections import Counter

import duckdb
import pytest

from quayside.llm import queries, ranked_search as R
from tests.llm.conftest import lowered

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall(lowered(text))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in own if c)
    n_terms = sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 10
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def small(monkeypatch):
    """Several groups, bundles and shards."""
    for name, value in (("BUNDLE_ITEMS", 3), ("BUNDLE_TERMS", 12), ("GROUP_TERMS", 60),
                        ("SHARD_DOCS", 9), ("SHARD_POSTINGS", 40)):
        monkeypatch.setattr(R, name, value)


def corpus(rnd, n):
    """Words of very unlike frequency, copies, one word in every document."""
    words = [f"w{i}" for i in range(300)] + ["É", "naïve", "a1", "ZZ"]
    weights = [1 / (1 + i) for i in range(len(words))]
    docs = [(i, "The " + ", ".join(rnd.choices(words, weights, k=rnd.randint(0, 60))))
            for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(n // 3)]
    rnd.shuffle(docs)
    return docs, words


@pytest.mark.parametrize("k", [1, 10])
def test_brute_force(spark, make, rnd, small, k):
    docs, words = corpus(rnd, 150)
    items = [(i, " ".join(rnd.sample(words, rnd.randint(1, 8)))) for i in range(14)]
    items += [(90, "the THE the"), (91, docs[3][1]), (92, "none of these"), (93, "w0 w1 w2"), (94, "")]
    df = R.rank_documents(make(docs), make(items, "item_id long, text string"), k)
    assert found(df) == brute(docs, items, k)


def test_documents_out_of_reach_are_dropped(spark, make, rnd, monkeypatch):
    """What a stage carries on holds no document that cannot be among the best any more."""
    docs, _ = corpus(rnd, 400)
    carried = []
    raise_floors = R._raise_floors
    monkeypatch.setattr(R, "_raise_floors", lambda df, plan: (
        raise_floors(df, plan), carried.append(df.selectExpr("sum(size(docs))").first()[0]))[0])
    items = [(1, "w250 w200 w0 w1 the"), (2, "w90 w1 w2 w3")]
    assert found(R.rank_documents(make(docs), make(items, "item_id long, text string"), 3)) \
        == brute(docs, items, 3)
    assert len(carried) == len(R.OWNERS) - 1 and (carried[-1] or 0) < 200


def test_odd_rows(spark, odd, empty, make, small):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [("x", "the cat"), ("x", "the cat"), (None, "mat text"), ("y", None), ("z", " .,"),
             ("é", "x" * 100_000), ("w", "4111111111111111 LEFT")]
    asked = make([(*i, "clash", "clash") for i in items],
                 "item_id string, text string, doc_id string, rank string")
    assert found(R.rank_documents(odd, asked)) == brute(docs, items)
    assert R.rank_documents(empty, asked).count() == 0
    assert R.rank_documents(odd, asked.limit(0)).count() == 0
    assert R.rank_documents(make([(1, None), (2, "...")]), asked).count() == 0


def test_query_and_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    result = con.execute(queries.ORACLES["op11_ranked_search"])
    names = [d[0] for d in result.description]
    df = queries.op11_ranked_search(spark, sf)
    assert df.columns == names
    assert found(df) == sorted(map(tuple, result.fetchall()), key=str)
