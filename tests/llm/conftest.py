import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("score", T.DoubleType()), ("rid", T.StringType()))])


def prose(rng, n, tag="w"):
    return " ".join(f"{tag}{rng.randrange(400)}" for _ in range(n))


def corpus(odd_ids: bool):
    """Copies, near copies, shared passages, repeats inside a text, nulls,
    empty and long texts; with ``odd_ids`` also null and repeated ids."""
    rng = random.Random(4)
    base, passage = prose(rng, 120), prose(rng, 70)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), "  " + base + "\n\nTail é ü", None, "", " \t\n", "one two", "one two", "One, TWO!",
             prose(rng, 60) + " " + passage + "\n" + prose(rng, 30), passage + " " + prose(rng, 20), passage,
             "ab" * 200, "ab" * 200 + "c", prose(rng, 9000), "日本語 " * 80, "x", passage + "  " + passage,
             "Released under the MIT License. mit  license; APACHE\nLicense and General Public License!",
             "éà" * 90 + "tail", prose(rng, 300), prose(rng, 300).upper(), "..., !!! 12 34"]
    for _ in range(30):
        words = base.split()
        words[rng.randrange(120)] = "z%d" % rng.randrange(99)
        texts.append(" ".join(words))
    rows = [(i * 7 % 101, t, ("en", "fr", None)[i % 3], ("a", None, "b", "ü")[i % 4], len(t or ""), 0.5, "r")
            for i, t in enumerate(texts)]
    if odd_ids:
        rows += [(None, base, None, None, None, None, None), (None, None, "en", "a", 1, 1.0, "r"), rows[0], rows[0],
                 (rows[0][0], passage, "en", "a", 1, 0.0, "q")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(False), SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(corpus(True), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order(rows):
    """Rows as documents in the order (id, nulls last, text): the rank is the key."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
