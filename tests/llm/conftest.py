import random

import pytest

from strata.llm.queries import workers_import

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves, as extra columns of their input
CLASHING = ("row_key", "node", "key", "hash", "words", "length", "rank", "score", "shard", "part", "component", "size", "bucket", "spans", "doc", "width")


@pytest.fixture(autouse=True)
def importable(spark):
    workers_import(spark)


def word(rng):
    return "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


@pytest.fixture()
def rng():
    return random.Random(7)


def documents(spark, texts, first_id=0, extra=False):
    """A documents table of the texts (or (id, text) pairs), with clashing extra columns if asked."""
    rows = [(t if isinstance(t, tuple) else (first_id + i, t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows], SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(c) for c in CLASHING})
    return df


def odd_texts(rng):
    """Nulls, empties, white space only, one word, a very long text, ties and repeats."""
    base = sentence(rng, 40)
    return [None, "", " \t\n", "one", "two words", base, base, base + " more", "é" * 5, "\n".join([base, "", base, "  "]),
            " ".join([sentence(rng, 30)] * 400), "x" * 30_000, "a\x00b " * 20]
