"""Cases that the operators once left out."""

from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from quayside.llm import jaccard_join, labelled, language_id, licenses, packing, pii

MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_whole_licence_texts_and_wrapped_notices(spark, make):
    changed = MIT.upper().replace("MIT LICENSE", "The MIT Licence").replace("SOME ONE", "Émile & Co.")
    wrapped = MIT.replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT").replace("(c) 2020 Some", "© 1999")
    docs = make([
        (1, MIT), (2, changed), (3, wrapped), (4, MIT.replace("sublicense, ", "")),
        (5, "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not"),
        (6, "text\n * This work is licensed under the\n * GNU General Public License, version 3.\n"),
        (7, "// SPDX-License-Identifier: LGPL-2.1-or-later\n// SPDX-License-Identifier: ISC"),
        (8, "we are not licensed under the\nMIT License. Really"), (9, "Copyright 2020 me\nhello")])
    rows = {r["doc_id"]: r for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}
    assert [rows[i]["text_license"] for i in (1, 2, 3, 4)] == ["MIT", "MIT", "MIT", None]
    assert rows[5]["line_licenses"] == "Apache-2.0"
    assert (rows[6]["line_licenses"], rows[6]["n_lines"]) == ("GPL-3.0", 1)
    assert (rows[7]["line_licenses"], rows[7]["n_lines"]) == ("ISC,LGPL-2.1-or-later", 2)
    assert rows[8]["line_licenses"] == "" and rows[9]["text_license"] is None


@pytest.mark.parametrize("proportions", [None, {"s00": 3.0, "s29": 1.0}])
def test_every_source_has_its_queue(make, rnd, tokenizer, monkeypatch, proportions):
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    monkeypatch.setattr(packing, "GROUP", 5)
    if proportions:  # blocks of a few windows
        monkeypatch.setattr(packing.Schedule.__init__, "__defaults__", (64, 4, 32))
    # s00 is the least source, s29 the largest.
    docs = [(i * 100 + j, "cat sat on " * rnd.randint(20, 60), f"s{i:02}")
            for i in range(30) for j in range(i + 1)]
    pieces = packing.pack(make(docs, "doc_id long, text string, source string"), tokenizer,
                          window=512, proportions=proportions).collect()
    by_doc, windows, total = defaultdict(list), defaultdict(list), defaultdict(int)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
        total[p["source"]] += p["length"]
    for own in by_doc.values():
        own.sort(key=lambda p: p["start"])
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert sum(p["length"] for p in own) == own[0]["doc_tokens"]
        assert all(len(p["ids"]) == 4 * p["length"] for p in own)
    assert len(by_doc) == len(docs) and len(total) == 30
    for k, own in windows.items():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert sum(p["length"] for p in own) == 512 or k == max(windows)
    share = {s: [sum(p["length"] for p in windows[k] if p["source"] == s)
                 for k in range(max(windows))] for s in total}
    if proportions:  # the least source ends first, the largest one last
        assert sum(share["s00"][:8]) == total["s00"]
        assert sum(share["s29"][-8:]) > 8 * 512 // 2
    else:
        for s, n in total.items():
            assert max(abs(x - 512 * n / sum(total.values())) for x in share[s]) <= 12, s


def test_context_words_around_lists_of_numbers(make):
    rows = [(1, "SSN: 123-45-6789, 234-56-7890, 345-67-8901 end"), (2, "123-45-6789 (SSN)"),
            (3, "ssn" + " " * 45 + "123-45-6789"), (4, "ssn" + " " * 46 + "123-45-6789"),
            (5, "123-45-6789" + " " * 45 + "ssn"), (6, "123-45-6789" + " " * 46 + "ssn"),
            (7, "ssn " + "000-11-2222 " * 3 + "123-45-6789 " + "x" * 60 + " 234-56-7890")]
    rows.append((8, "tax " + "123-45-6789\n" * 1200))
    out = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["pii"] if s["kind"] == "ssn"]
           for r in pii.find_pii(make(rows)).collect()}
    assert out[1] == [(5, 16), (18, 29), (31, 42)] and out[2] == [(0, 11)]
    assert [len(out[i]) for i in (3, 4, 5, 6)] == [1, 0, 1, 0]
    assert out[7] == [(40, 51)]
    assert out[8] == [(4 + 12 * i, 15 + 12 * i) for i in range(4)]


def test_samples_are_bounded_in_ids_and_texts(spark, make):
    docs = make([(i, f"text {i}") for i in range(1, 60)] + [(7, f"other {i}") for i in range(50)]
                + [(7, "text 7")] * 50)
    labels = spark.createDataFrame([(i, 1) for i in range(1, 60)] + [(7, 1)] * 1000, "doc_id long, y int")
    first = [r["doc_id"] for r in labels.distinct().filter(~labelled.held_out(F.col("doc_id")))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(30).collect()]
    rows = labelled.training_sample(docs, labels, F.col("y"), {1: 30})
    assert sorted(set(rows["doc_id"])) == sorted(first)
    hot = first[0]  # repeated label rows do not take the places of others
    rows = labelled.training_sample(
        docs, labels.unionByName(spark.createDataFrame([(hot, 1)] * 100, labels.schema)), F.col("y"), {1: 30})
    assert sorted(set(rows["doc_id"])) == sorted(first)
    every = labelled.training_sample(docs, labels, F.col("y"), {1: 100})
    assert (every["doc_id"] == 7).sum() <= labelled.TEXTS_PER_ID
    known = make([(1, "abc", "en")] * 20 + [(2, "xyz", "en"), (3, "uvw", "en")],
                 "doc_id long, text string, lang string")
    one = known.distinct()
    assert (language_id.train(known, 3).loglik == language_id.train(one, 3).loglik).all()


def test_nul_is_a_word_character_of_the_join(make):
    rows = [(1, "a\0b c"), (2, "a b c"), (3, "a\0B c"), (4, "\0"), (5, "")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard_join.jaccard_components(make(rows), jaccard_join.Rule(1, 90, 100)).collect()}
    assert got == {1: (2, 1), 2: (3, 2), 3: (2, 1), 4: (1, 4), 5: (0, 5)}
