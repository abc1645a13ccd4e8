import random

import pytest

from loomsync.llm import repeats

FIELDS = "doc_id long, text string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def _truth(texts, length):
    """Bytes removed, runs and bytes kept, from every window of every text."""
    seen = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    found = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        found.append((sum(mark), len([s for s in bytes(mark).split(b"\0") if s]), bytes(x for x, m in zip(b, mark, strict=True) if not m)))
    return found


def _compare(spark, texts, length=400, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), FIELDS)
    got = {r["doc_id"]: (r["_removed"], r["_spans"], bytes(r["_kept"])) for r in repeats.remove_repeats(df, **settings).collect()}
    want = _truth(texts, length)
    assert [got[i] for i in range(len(texts))] == want
    return want


def test_many_texts_around_one_passage(spark):
    """More pieces per anchor than one shard takes, at the production settings."""
    rng = random.Random(21)
    passage = words(rng, 150)
    texts = [words(rng, rng.randint(30, 120)) + rng.choice(" -+") + passage + rng.choice("., ") + words(rng, rng.randint(30, 120)) for _ in range(700)]
    texts += [passage[:420] + words(rng, 80), passage[100:], words(rng, 50) + passage[-399:], passage + passage]
    want = _compare(spark, texts)
    assert all(n >= len(passage) for n, _, _ in want[:700])


def test_near_copies_of_one_text(spark):
    rng = random.Random(22)
    base = words(rng, 260).split(" ")
    texts = []
    for i in range(300):
        parts = list(base)
        for _ in range(rng.choice((1, 1, 2, 5))):
            parts[rng.randrange(len(parts))] = f"EDIT{i}"
        texts.append(" ".join(parts))
    _compare(spark, texts, hot=20)


@pytest.mark.parametrize("hot", [500, 3])
def test_periodic_and_tiny_and_copied_texts(spark, hot):
    rng = random.Random(23)
    texts = ["ab " * n for n in range(130, 170, 3)] + [words(rng, 10) + " xyz" * 150 + words(rng, 9) for _ in range(12)]
    texts += ["", None, "x" * 399, "x" * 400, "y" * 401, "y" * 900, "é" * 500] + [texts[3]] * 3
    _compare(spark, texts, hot=hot)


def test_texts_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 11)
    rng = random.Random(24)
    passage = words(rng, 200)
    texts = [words(rng, 900) + passage + words(rng, 40), passage, words(rng, 3000), words(rng, 10)]
    cut = repeats.cut_pieces([t.encode() for t in texts], 400, 64)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 20)
    whole = repeats.cut_pieces([t.encode() for t in texts], 400, 64)
    for a, b, text in zip(cut, whole, texts, strict=True):
        covered = sorted(x for s, n in zip(a[2].tolist(), a[3].tolist(), strict=True) for x in range(s, s + n))
        assert covered == list(range(max(0, len(text) - 399)))
        assert {k for k in b[0].tolist()} <= {k for k in a[0].tolist()}
