import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with results."""
    def make(rows):
        extra = ("n_tokens", "score", "component_id", "shard", "spans", "k", "t", "h")
        data = [(i, t, "en", "s", len(t or ""), *[f"x{n}" for n in range(len(extra))]) for i, t in rows]
        return spark.createDataFrame(data, DOCS + "".join(f", `{c}` string" for c in extra))
    return make


@pytest.fixture(scope="session")
def odd_texts(words):
    """Null, empty, blank, long, repeated and unusual texts."""
    long = " ".join(words * 20)
    return [None, "", " \n\t ", "a", "a" * 5000, long, "café ñandú 日本語 𝒳 ²", "<|x <\\| <\\\\| </s>", "one two three", "one two three",
            "\x1c\x85​ mixed spaces", "0" * 300]
