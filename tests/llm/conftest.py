"""Tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, part string, id string"


@pytest.fixture(scope="session")
def awkward(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [say(rng.randint(0, 60)) for _ in range(40)]
    texts = [*base, base[3], base[3], base[5], None, None, "", " \n\t", "It's a TEST!'s <|endoftext|> 12 ½ x\x1cy İ 日本", say(9000), base[7] + " tail", "a" * 300]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", None]), 1, i, "p", "x") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "null id", "en", "s1", 1, 1, "p", "x"), (None, base[3], "en", "s1", 1, 1, "p", "x"), (2, "same id " + say(8), "en", "s1", 1, 1, "p", "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
