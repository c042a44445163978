import random

import pytest

LETTERS = "bcdfghjklmnp"


@pytest.fixture(scope="session")
def words():
    """A seeded maker of invented words."""
    rng = random.Random(5)
    stock = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(4, 9))) for _ in range(4000)]
    return lambda n, seed: [random.Random(f"{seed}-{i}").choice(stock) for i in range(n)]


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def plain_docs(documents):
    """(doc_id, text) pairs as a documents table."""
    return lambda pairs: documents([(i, t, "en", "src1", None if t is None else len(t)) for i, t in pairs])


#: Texts that every operator has to take: null, empty, blank, other white space, one long word, controls, astral characters.
ODD_TEXTS = [None, "", "   ", " \n\t ", "x", "x" * 30_000, "a b " * 5000, "é ß 中 𝔸", "\x00\x1c\x85", "<|endoftext|> a  <|endoftext|>", "Don't. STOP,, 'll\r\n\r\n"]


@pytest.fixture(scope="session")
def odd_texts():
    return list(ODD_TEXTS)
