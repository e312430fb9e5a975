import random

import pytest


@pytest.fixture(scope="session")
def rng():
    return random.Random(17)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null and empty texts, one very long text, repeated rows, null ids and sources, and columns with clashing names."""
    words = "the of and a to in is it you that he was for on are with as his they be at one have this from or had by hot but some what there we can out other were all your".split()
    pick = random.Random(3)
    prose = lambda n: " ".join(pick.choice(words) for _ in range(n))
    base = prose(120)
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b\f\r ", "en", "a"), (4, base, "en", "a"), (5, base, "en", "b"), (5, base, "en", "b"), (6, base + " end", "en", None),
        (7, prose(60_000), "de", "a"), (8, "x" * 200_000, "de", "b"), (None, prose(50), "en", "b"), (9, "One", None, "a"), (10, "Ünï çödé 中文 🙂 " * 30, "fr", "é"), (11, "<|endoftext|> end  of\n\ntext", "en", "b"),
    ] + [(100 + i, prose(20 + i % 50), "en", "abc"[i % 3]) for i in range(60)]
    return spark.createDataFrame([(*r, 1, "fp", 2.0, 3) for r in rows], "doc_id long, text string, lang string, source string, n int, key string, score double, block int")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
