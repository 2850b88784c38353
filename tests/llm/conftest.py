import os
import random
import re

import pytest

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture()
def rnd():
    return random.Random(11)


@pytest.fixture()
def make(spark):
    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)
    return build


@pytest.fixture(scope="session")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k1 string, "
              "v string, n string, kept string, hits string, score string, _text string")


@pytest.fixture()
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, clashing extra columns."""
    extra = ("x",) * 7
    long_text = "The cat sat on the mat 4111111111111111 and left. " * 3000
    rows = [
        (1, "the cat sat on the mat", "en", "a", 22, *extra),
        (1, "the cat sat on the mat", "en", "a", 22, *extra),
        (1, "another text of the same id", "en", None, 27, *extra),
        (2, None, None, None, None, *(None,) * 7),
        (3, "", "en", "b", 0, *extra),
        (None, "the cat sat on the mat", None, "b", None, *extra),
        (None, None, None, None, None, *(None,) * 7),
        (4, long_text, "en", "a", len(long_text), *extra),
        (5, "\n \t", "de", "a", 3, *extra),
        (6, "x" * 100_000, "de", "a", 100_000, *extra),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return SF
