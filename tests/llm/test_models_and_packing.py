"""Packing as an exact round trip; classifiers by held-out accuracy; odd and empty tables."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import (
    decontaminate, jaccard_join, language_id, licenses, packing, pii, quality, queries, repeats,
    spotsigs, toxicity,
)
from quayside.llm.common import table
from quayside.llm.labelled import held_out


def test_word_tokenizer_equals_the_tokenizer(tokenizer, rnd):
    from quayside.llm.tokens import WordTokenizer

    words = WordTokenizer(tokenizer)
    signs = "aAbB'sStTlLrReEvV dD  \n\t12²½,.!?é É ß µªÿ\x85\xa0\x1c\x1f\x00_-中ΣςİŞ"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "a" * 50_000, "don't 'S ''s"]
    plain = words.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in words.encode(texts)] == [e.ids for e in plain]


@pytest.mark.parametrize("proportions", [None, {"src0": 1.0, "src1": 8.0}])
def test_packing_round_trip(spark, sf, tokenizer, proportions):
    from tokenizers import Tokenizer

    docs = table(spark, sf, "documents")
    pieces = packing.pack(docs, tokenizer, proportions=proportions).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    plain = Tokenizer.from_file(tokenizer)
    for r in docs.collect():
        own = sorted(by_doc.pop(r["doc_id"]), key=lambda p: p["start"])
        ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in own])
        assert ids.tolist() == plain.encode(r["text"], add_special_tokens=False).ids + [2]
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert all(p["doc_tokens"] == len(ids) and p["length"] > 0 for p in own)
    assert not by_doc
    for k, own in by_sequence.items():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        size = sum(p["length"] for p in own)
        assert size == 4096 or k == max(by_sequence)
    if proportions is None:  # every window holds the corpus's proportions
        total = defaultdict(int)
        for p in pieces:
            total[p["source"]] += p["length"]
        for k in list(by_sequence)[:-1]:
            for s, n in total.items():
                have = sum(p["length"] for p in by_sequence[k] if p["source"] == s)
                full = sum(p["length"] for p in by_sequence[k])
                assert abs(have - n * full / sum(total.values())) <= 3


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rated = quality.rate(docs, quality.train(docs, labels)).join(labels, "doc_id")
    rows = rated.filter(held_out(F.col("doc_id"))).toPandas()
    assert ((rows.tail_1 >= 0.5) == (rows.quality == 1)).mean() >= 0.95
    assert (rows.tail_1 >= rows.tail_2).all()
    assert (rows.expected_grade - rows.tail_1 - rows.tail_2).abs().max() < 1e-9
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
    rows = scored.filter(held_out(F.col("doc_id"))).toPandas()
    toxic = rows.toxic == 1
    n, ranks = toxic.sum(), rows.score.rank()
    auc = (ranks[toxic].sum() - n * (n + 1) / 2) / (n * (~toxic).sum())
    assert rows.score.between(0, 1).all() and auc >= 0.9


def test_thresholds_are_ordered_and_fit_grades(rnd):
    texts, grades = [], []
    for _ in range(300):
        g = rnd.randrange(3)
        texts.append(" ".join(rnd.choice([("bad", "x"), ("fair", "x"), ("good", "x")][g])
                              for _ in range(30)).encode())
        grades.append(g)
    model = quality.fit(texts, np.array(grades))
    assert model.thresholds[0] < model.thresholds[1]


def test_languages_agree_with_the_address(spark, sf):
    model = language_id.train(table(spark, sf, "documents"))
    pages = table(spark, sf, "pages")
    rows = language_id.identify(pages, model).join(pages, "page_id").toPandas()
    path = rows.url.str.extract(r"example\.[a-z]+/(en|de|fr|es)/")[0]
    assert len(rows) == pages.count()
    assert (rows.lang == path)[path.notna()].mean() >= 0.97
    assert rows.probability.between(0, 1.000001).all()


def test_licences(spark, make):
    docs = make([(1, "LICENSED under the\tapache licence, version 2.0"),
                 (2, "Copyright 2020 me\nReleased under the MIT License."),
                 (3, "Text.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT licence!\nMore"),
                 (4, None), (5, "nothing")])
    rows = {r["doc_id"]: r for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}
    assert rows[1]["text_license"] == "Apache-2.0"
    assert rows[2]["text_license"] == "MIT"
    assert rows[3]["text_license"] is None and rows[3]["line_licenses"] == "CC-BY-NC-4.0,MIT"
    assert rows[3]["n_lines"] == 2 and rows[4]["n_lines"] == rows[5]["n_lines"] == 0


def _labels(spark, n=0):
    return spark.createDataFrame([(None, 1, None), (1, None, 1), (2, 0, 0)][:n],
                                 "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_odd_and_empty_tables(spark, request, tokenizer, which):
    docs = request.getfixturevalue(which)
    n = docs.count()
    items = spark.createDataFrame([(None, "the cat"), (7, "sat on"), (8, None)][:n],
                                  "item_id long, text string")
    labels = _labels(spark, 3 if n else 0)
    assert decontaminate.find_benchmark(docs, items).count() == n
    assert pii.find_pii(docs).count() == n and pii.redact(docs).columns == docs.columns
    assert repeats.remove_repeats(docs).count() == n
    assert licenses.scan(docs, licenses.known_digests(spark)).count() == n
    assert spotsigs.edited_and_next(docs).count() == n
    assert quality.rate(docs, quality.train(docs, labels)).count() == n
    scores = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(scores) == n and all(0 <= r["score"] <= 1 for r in scores)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                        F.col("text").alias("html"))
    assert language_id.identify(pages, language_id.train(docs)).count() == n
    assert packing.pack(docs, tokenizer).agg(F.sum("length")).first()[0] == (
        packing.pack(docs, tokenizer).select("doc_id", "doc_tokens", "start")
        .filter("start = 0").agg(F.sum("doc_tokens")).first()[0])
    joined = jaccard_join.jaccard_components(docs).collect()
    assert len(joined) == n
    if n:  # the row with a null key is linked with the rows of key 1
        assert {r["component_id"] for r in joined if r["n_shingles"] == 4} == {1}


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in queries.QUERIES] == \
        [f"op{i}" for i in range(1, 11)] + ["pipeline"]
