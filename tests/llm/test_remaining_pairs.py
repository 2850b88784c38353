"""Last step of the Jaccard join: each pair that whole bitmaps let through, once."""

from quayside.llm import jaccard_join as join

RULE = join.Rule(words=5, least=80, over=100)
LISTS = "s long, gid binary, n long, pos int, size long, fold array<long>"


def _lists(spark, rows):
    return spark.createDataFrame([(s, g, 100, pos, 1, [0] * join.FOLD) for s, g, pos in rows], LISTS)


def test_lists_of_equal_groups_are_one(spark):
    lists = _lists(spark, [(9, b"a", 1), (9, b"b", 4), (3, b"a", 2), (3, b"b", 6),
                           (5, b"a", 3), (5, b"b", 7), (5, b"c", 0)])
    kept = {r["s"] for r in join._one_of_equal(lists).collect()}
    assert kept == {9, 5}  # 9 comes first in all texts, 5 holds another group


def test_unlike_texts_of_a_list_make_no_pair(spark):
    longs = join.BITS // 64
    # "c" differs from "a" and "b" in 256 bits that cancel out when the bitmap is folded.
    unlike = [-1] * 2 * join.FOLD + [0] * (longs - 2 * join.FOLD)
    lists = _lists(spark, [(s, g, p) for s, p in ((1, 0), (2, 1)) for g in (b"a", b"b", b"c")]
                   + [(7, b"a", 3), (7, b"b", 3)])
    state = spark.createDataFrame([(g, 100, g, [0] * join.FOLD, g) for g in (b"a", b"b", b"c")],
                                  "v binary, n long, gid binary, fold array<long>, root binary")
    members = spark.createDataFrame(
        [(b"a", [0] * longs), (b"b", [0] * longs), (b"c", unlike)], "v binary, bits array<long>")
    pairs = join._remaining_pairs(lists, state, members, RULE).collect()
    assert [(bytes(r["a"]), bytes(r["b"])) for r in pairs] == [(b"a", b"b")]
