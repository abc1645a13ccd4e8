import random

import pytest


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Texts with copies, near copies, shared passages, repeats within a text, and empty and null ones."""
    rng = random.Random(3)
    texts = [words(rng, rng.choice((3, 40, 150, 400))) for _ in range(60)]
    passage = words(rng, 90)
    for i in range(0, 20, 4):
        texts[i] = texts[i] + " " + passage + " " + texts[i + 1][:200]
    for i in range(30, 40):
        parts = texts[30].split(" ") or [""]
        parts[rng.randrange(len(parts))] = "EDIT" + str(i)
        texts.append(" ".join(parts))
    texts += [texts[5], texts[5], "", None, "   ", "one two", "ONE  two", "x" * 3000, "äöü" * 300, "ab " * 400, "é" + passage]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "  <|endoftext|><|endoftext|>  x<|endoftext|"]
    return list(enumerate(texts)) + [(5, texts[5])]


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "extra") for i, t in rows], "doc_id long, text string, _score string")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
