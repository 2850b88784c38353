"""Fusion of the evidence against plain arithmetic, for a few and for many languages."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from quayside.llm import language_id as L


def words_of(rnd, i):
    """A language of its own: few letters, so that trigrams tell it from others."""
    letters = [chr(97 + (i * 7 + j * 3) % 26) for j in range(5)]
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 7))) for _ in range(40)]


def corpus(rnd, k):
    languages = {f"l{i:02}": words_of(rnd, i) for i in range(k)}
    docs = [(j, " ".join(rnd.choices(words, k=30)), name)
            for name, words in languages.items() for j in range(6)]
    pages = []
    for p in range(150):
        name = rnd.choice(sorted(languages)[:12])
        host = f"http://h{rnd.randint(0, 9)}.site{rnd.randint(0, 3)}.{rnd.choice(['aa', 'bb'])}/x"
        said = rnd.choice([f'<html lang="{name}">', "<html>", '<html lang="zz">'])
        text = " ".join(rnd.choices(languages[name], k=rnd.choice([0, 1, 2, 40])))
        pages.append((p, rnd.choice([host, host, None]), rnd.choice([said + text, said + text, None])))
    return docs, pages


def fused(pages, model):
    """``identify`` in plain arithmetic."""
    k = len(model.languages)
    rows = []
    for page_id, url, html in pages:
        host = (re.findall(r"^[a-z]+://([^/]+)", url or "") or [""])[0]
        domain = (re.findall(r"([^.]+\.[^.]+)$", host) or [""])[0]
        suffix = (re.findall(r"\.([^.]+)$", host) or [""])[0]
        said = (re.findall(r'lang="([A-Za-z]+)', html or "") or [""])[0].lower()
        bucket, first = L.trigrams([re.sub("<[^>]*>", " ", html or "")])
        dense = np.zeros(k)
        for b in bucket.tolist():
            own = slice(model.begin[b], model.begin[b + 1])
            dense[model.language[own]] += model.loglik[own]
        n = len(bucket)
        loglik = (dense + n * model.unseen) * min(max(n, 1), L.MOST) / max(n, 1) / L.TEMPER
        vote = int(loglik.argmax()) if n else -1
        rows.append((page_id, host, domain, suffix, said, loglik, vote))

    def votes(at):
        out = {}
        for r in rows:
            out.setdefault(at(r), Counter())[r[6]] += 1
        return {key: [c[i] for i in range(k)] for key, c in out.items()}

    every, by_suffix = votes(lambda r: 0)[0], votes(lambda r: r[3])
    by_domain, by_host = votes(lambda r: r[2:4]), votes(lambda r: r[1:4])
    by_said = votes(lambda r: r[4])

    def smoothed(own, above):
        return [(x + L.SMOOTH * p) / (sum(own) + L.SMOOTH) for x, p in zip(own, above)]

    found = {}
    for page_id, host, domain, suffix, said, loglik, vote in rows:
        above = smoothed(by_domain[domain, suffix], smoothed(
            by_suffix[suffix], smoothed(every, [1 / k] * k)))
        score = []
        for i in range(k):
            own = int(vote == i)
            here = by_host[host, domain, suffix]
            prior = (here[i] - own + L.SMOOTH * above[i]) / (
                sum(here) - int(vote >= 0) + L.SMOOTH)
            total = every[i] + 64 * L.ADDED
            score.append(loglik[i] + math.log(prior)
                         + (math.log((by_said[said][i] - own + L.ADDED) / total) if said else 0)
                         + math.log((by_suffix[suffix][i] - own + L.ADDED) / total))
        best = int(np.argmax(score))
        found[page_id] = (model.languages[best], 1 / sum(math.exp(s - score[best]) for s in score),
                          model.languages[vote] if vote >= 0 else None)
    return found


@pytest.mark.parametrize("k", [3, 70])
def test_fusion(spark, rnd, k):
    docs, pages = corpus(rnd, k)
    model = L.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == sorted({lang for *_, lang in docs})
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = L.identify(table, model).collect()
    expected = fused(pages, model)
    assert len(rows) == len(pages)
    for r in rows:
        lang, probability, text_lang = expected[r["page_id"]]
        assert (r["lang"], r["text_lang"]) == (lang, text_lang)
        assert r["probability"] == pytest.approx(probability, rel=1e-9)


def test_trigram_counts_are_those_of_the_sample(spark, rnd):
    docs, _ = corpus(rnd, 5)
    docs += [(0, docs[0][1], "l00"), (None, "abc", "l00"), (9, "abc", None), (7, "", "l99")]
    model = L.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == [*[f"l{i:02}" for i in range(5)], "l99"]
    for i in range(5):
        texts = [t for j, t, lang in docs[:30] if lang == f"l{i:02}"]
        seen = Counter(L.trigrams(texts)[0].tolist())
        total = sum(seen.values()) + L.BUCKETS * L.ADDED / 64
        for b, n in seen.items():
            own = slice(model.begin[b], model.begin[b + 1])
            at = model.language[own].tolist().index(i)
            assert model.loglik[own][at] + model.unseen[i] == pytest.approx(
                math.log((n + L.ADDED / 64) / total))
    assert model.unseen[5] == pytest.approx(math.log(1 / L.BUCKETS))


def test_a_limit_of_ids(spark, rnd):
    docs, _ = corpus(rnd, 2)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    kept = {r[0] for r in df.select("doc_id").distinct()
            .selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").limit(2).collect()}
    few = L.train(df, max_rows=2)
    same = L.train(df.filter(df["doc_id"].isin(list(kept))))
    assert (few.loglik == same.loglik).all() and (few.begin == same.begin).all()
