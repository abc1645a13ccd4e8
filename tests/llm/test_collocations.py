import random
import re
from collections import Counter

import numpy as np
import pytest

from loomsync.llm import collocations

FIELDS = "text string, lang string, phrase string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    common = ["the", "of", "New", "york", "city", "hall", "a", "é", "x-y", "don't"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([["new", "York"], ["in", "the", "city", "of"], [rng.choice(common)], ["one two three four five six"], [f"w{rng.randint(0, 900)}"]])
            if rng.random() < 0.1:
                words[-1] += rng.choice([".", ",", " ; ", "\n", "\x0b"])
        rows.append((rng.choice(["  ", "\t", " "]).join(words), rng.choice(["en", "en", "en", "de", None]), "clash"))
    return rows + [("", "en", None), (None, "en", None), (" \t ", "fr", None), ("a a a a a a a", "de", None), rows[3], rows[3]]


def _truth(rows, least, top, share=100):
    f, n = Counter(), Counter()
    for text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    dropped = set()
    for longer, c in frequent.items():
        for i in range(1, len(longer)):
            for j in range(i + 2, len(longer) + 1):
                inner = (longer[0], *longer[i:j])
                if len(inner) < len(longer) and 100 * c >= share * f[inner]:
                    dropped.add(inner)
    found = {}
    for p, a in frequent.items():
        if p in dropped:
            continue
        lang, words = p[0], p[1:]
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    return sorted((lang, i + 1, r[2].decode(), *r[3:]) for lang, rows in found.items() for i, r in enumerate(sorted(rows)[:top]))


@pytest.mark.parametrize("least,top,share,bits,block", [(20, 2000, 100, 1 << 16, 1 << 23), (5, 7, 100, 1 << 16, 500), (8, 50, 60, 64, 3000)])
def test_against_counting_everything(spark, texts, least, top, share, bits, block):
    df = spark.createDataFrame(texts, FIELDS)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=least, top=top, share=share, bits=bits, block=block).collect())
    assert got == _truth(texts, least, top, share)


def test_no_words(spark):
    assert collocations.collocations(spark.createDataFrame([], FIELDS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None, None), ("?!", "en", "")], FIELDS)).count() == 0


def test_long_texts_are_cut_where_a_piece_ends():
    text = b"aa bb. cc dd " + b"e" * 50 + b" ff\ngg"
    assert list(collocations._segments(text, 20)) == [b"aa bb.", b" cc dd " + b"e" * 50 + b" ff\n", b"gg"]
    assert list(collocations._segments(b"", 20)) == [b""]


def test_a_full_filter_holds_everything():
    full = collocations.Filter(np.full(4, 2**64 - 1, np.uint64))
    assert full.holds(np.arange(1000, dtype=np.uint64)).all()
