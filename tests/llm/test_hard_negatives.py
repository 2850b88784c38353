"""Hard negatives against brute force with Python integers."""

import math

import duckdb
import numpy as np
import pytest

from quayside.llm import hard_negatives as H
from quayside.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, a string, share string"


def brute(rows, element=np.float32, every=100):
    own = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(
                x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if vec_id % 7 == 0 else label
        q = []
        for x in vector:
            x = float(element(x))
            q.append(int(x) * 256 if abs(x) >= 2 ** 53 else math.floor(256 * x))
        own.append((vec_id, q, int(label)))
    out = []
    for a, qa, la in own:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(qa, q)), i, lab) for i, q, lab in own if i != a)
        for p, i, _ in [s for s in scored if s[2] == la][:5]:
            fits = [s for s in scored if s[2] != la and -30 * p <= -100 * s[0] <= -90 * p][:10]
            out += [(a, i, r, j, near(-p), near(-s)) for r, (s, j, _) in enumerate(fits, 1)]
    return sorted(out)


def near(x):
    return min(max(x, -(1 << 63)), (1 << 63) - 1)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(*r, "x", "y", "z") for r in rows], SCHEMA.replace("float", kind)).repartition(3)


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(H, "ANCHORS", 3)
    monkeypatch.setattr(H, "CANDIDATES", 16)
    monkeypatch.setattr(H, "SCORES", 64)


def random_rows(rnd, n, labels, spread=0.5, width=6):
    centre = [[rnd.gauss(0, spread) for _ in range(width)] for _ in range(labels)]
    return [(i, [c + rnd.gauss(0, 0.4) for c in centre[i % labels]], i % labels)
            for i in range(0, n)]


def test_brute_force(spark, rnd, small_blocks):
    rows = random_rows(rnd, 700, 3)
    # One vector makes up a third of the rows: ties everywhere.
    rows = [(i, rows[0][1] if i % 3 == 0 else v, rnd.choice([0, 1, 1, 1, 2, -15])) for i, v, _ in rows]
    expected = brute(rows)
    assert len(expected) > 100
    assert found(H.hard_negatives(table(spark, rows))) == expected


def test_odd_rows(spark, rnd, small_blocks):
    rows = random_rows(rnd, 400, 4)
    rows += [(500, None, 1), (None, rows[1][1], 1), (600, [0.1, None], 1), (700, [math.nan], 0),
             (800, [math.inf, 0.0], 0), (900, [0.3], None), (1000, [], 1), (1100, [0.5], 1),
             (1200, [0.1] * 9, 2), (-100, rows[3][1], 3), *rows[100:130], *rows[200:203]]
    # A repeated row stands twice, also as an anchor: only the rank tells its rows apart.
    expected = brute(rows)
    assert found(H.hard_negatives(table(spark, rows))) == expected


@pytest.mark.parametrize("kind,size", [("float", 3e38), ("double", 1e300), ("double", 1e6),
                                       ("float", 3e7)])
def test_any_magnitude(spark, rnd, small_blocks, kind, size):
    rows = random_rows(rnd, 260, 2)
    rows = [(i, [x * size if i % 5 == 0 else x for x in v], lab) for i, v, lab in rows]
    if size > 1e20:
        rows = [(i, [max(-3.3e38, min(3.3e38, x)) if kind == "float" else x for x in v], lab)
                for i, v, lab in rows]
    element = np.float32 if kind == "float" else np.float64
    expected = brute(rows, element)
    assert expected
    assert found(H.hard_negatives(table(spark, rows, kind))) == expected


def test_packed_scores_are_exact(rnd):
    rng = np.random.default_rng(5)
    for reach in (0, 1, 7, 160, 5_000, 1 << 20, 1 << 31, 1 << 50):
        for n, width in ((1, 1), (5, 3), (64, 64), (33, 7), (4, 0)):
            a = rng.integers(-reach, reach + 1, (9, width))
            c = rng.integers(-reach - 3, reach + 2, (n, width))
            block = H.PackedBlock(c, a.min(axis=0), a.max(axis=0))
            exact = a.astype(object) @ c.T.astype(object)
            assert (block.scores(a).astype(object) == exact).all()
            if reach == 160 and width == 64 and n == 64:
                assert block.kind == np.uint64 and block.fields >= 2


def test_empty_tables(spark):
    assert H.hard_negatives(table(spark, [])).count() == 0
    assert H.hard_negatives(table(spark, [(1, [0.1], 1)])).count() == 0
    assert H.hard_negatives(table(spark, [(100, [0.1], 1), (200, [0.2], 1)])).count() == 0


def test_query_and_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    result = con.execute(queries.ORACLES["op12_hard_negatives"])
    names = [d[0] for d in result.description]
    df = queries.op12_hard_negatives(spark, sf)
    assert df.columns == names
    assert found(df) == sorted(result.fetchall())
