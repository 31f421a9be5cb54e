import random

import pytest

BLANKS = [" ", "\n", "\t", "\r\n", "  ", "\x0b", "\x0c"]


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, very long, repeated and mixed-script texts."""
    rng = random.Random(5)
    words = ["The", "of", "and", "naïve", "straße", "Ünï", "日本", "x'll", "a-b", "###", "|", "0042", "don't", "ét"]
    made = ["".join(rng.choice(words) + rng.choice(BLANKS) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    passage = " ".join(rng.choice(words) + str(i) for i in range(60))
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(60_000))
    return [
        None, "", " ", "\n\n", "one", "two words", "a b c", "A B C", "same same same same same same", "a" * 100_000,
        *made, made[0], made[0], made[1].upper(), passage, "head " + passage + " tail", passage + " end", long, "x " * 500,
        " nbsp kept ", "\x1c\x1dcontrol\x85",
    ]


@pytest.fixture
def documents(spark):
    """Texts as a table with the columns of `documents` and one of a clashing name."""

    def make(texts, ids=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, kept string"
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, "s", None if t is None else len(t), "clash", "clash") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, schema).repartition(5)

    return make
