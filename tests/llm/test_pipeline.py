"""Each stage of the pipeline on its own input."""

import corpus_pipeline as P
from quayside.llm.common import table
from tests.llm.test_search_operators import by_links, personal, search


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    for i, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == set(before)
            break
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == list(P.COLUMNS)
        if name == "quality":
            rated = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
            good = [d for d in before if rated.get(d) == 1]
            assert sum(d in after for d in good) >= 0.95 * len(good)
        if name == "near_duplicates":
            links = by_links(list(before.items()), 5, 80, 100)
            assert set(after) == {c for _, c in links.values()}
        if name == "benchmarks":
            items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
            found = search(list(before.items()), items, 10)
            assert set(after) == {d for d in before if not found[d][1]}
        if name == "pii":
            assert set(after) == set(before)
            assert all(personal(t)[:4] == (0, 0, 0, 0) for t in after.values())
            assert all(after[d] == before[d] for d in before if sum(personal(before[d])[:4]) == 0)
        docs = out
