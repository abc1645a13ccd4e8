import base64
import struct
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from loomsync.llm import jaccard, packing, pii, registry, repeats, sharding, suffixes, tokens, toxicity

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks.
SAME = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ADDED = tokens.added_tokens(JSON)


def test_suffix_array_and_prefixes_against_sorting():
    rng = np.random.default_rng(1)
    for k in range(150):
        text = rng.integers(1, rng.integers(2, 6), rng.integers(1, 60))
        text = np.append(np.repeat(text, 6) if k % 5 == 0 else text, 0)
        order = suffixes.suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        prefix = suffixes.permuted_lcp(text, order)
        for a, b in zip(order[1:], order[:-1], strict=True):
            n = next(i for i in range(len(text)) if text[a + i] != text[b + i])
            assert prefix[a] == n


def _without_repeats(rows, length):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for d, b in enumerate(data):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i : i + length], []).append((d, i))
    marks = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                marks[d][i : i + length] = b"\1" * length
    return [(b, bytes(x for x, m in zip(b, mark, strict=True) if not m), sum(mark), bytes(mark).replace(b"\1" * 0, b"")) for b, mark in zip(data, marks, strict=True)]


@pytest.mark.parametrize("hot", [500, 2])
def test_repeats_against_all_windows(docs, rows, hot):
    got = repeats.remove_repeats(docs, length=100, anchor=32, hot=hot).select("doc_id", "_bytes", "_removed", "_spans", "_kept", "_score").collect()
    expected = _without_repeats(rows, 100)
    found = sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got)
    spans = [len([s for s in bytes(m).split(b"\0") if s]) for *_, m in expected]
    assert found == sorted((i, len(b), n, s, kept) for (i, _), (b, kept, n, _), s in zip(rows, expected, spans, strict=True))
    assert {r[5] for r in got} == {"extra"}


def test_repeats_of_nothing(empty):
    assert repeats.remove_repeats(empty).count() == 0


def _classes(rows):
    sets = []
    for _, text in rows:
        w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split() if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: min(rows[k][0] for k in range(len(rows)) if label[k] == x) for x in set(label)}
    return sorted((i, len(s), least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize("cluster", [6000, 3])
def test_jaccard_against_all_pairs(docs, rows, cluster):
    got = jaccard.near_duplicates(docs, cluster=cluster, block=4)
    assert sorted(map(tuple, got.collect())) == _classes(rows)


def test_jaccard_of_nothing(empty):
    assert jaccard.near_duplicates(empty).count() == 0


def test_region_recursion_against_all_pairs():
    rng = np.random.default_rng(5)
    bases = [rng.choice(10_000, 60, replace=False) for _ in range(12)]
    sets = [np.unique(np.where(rng.random(60) < 0.1, rng.integers(0, 10_000, 60), bases[k % 12])).astype(np.uint64) for k in range(150)]
    region = jaccard.Region(sets, Fraction(3, 4))
    region.join(np.arange(len(sets)))
    label = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 4 * shared >= 3 * (len(sets[i]) + len(sets[j]) - shared):
                label[label == label[i]] = label[j]
    pairs = lambda x: {(i, j) for i in range(len(x)) for j in range(i) if x[i] == x[j]}
    assert pairs(region.label) == pairs(label)


def test_bpe_against_tiktoken_and_back(docs, rows, empty):
    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = tokens.decode(tokens.encode(docs, MULTI, public_tokenizers.PATTERN), MULTI).collect()
    by_text = {r["text"]: r for r in got}
    assert len(got) == len(rows)
    for _, text in rows:
        assert by_text[text]["ids"] == whole.encode_ordinary(text or "")
        assert bytes(by_text[text]["decoded"]) == (text or "").encode()
    assert tokens.encode(empty, MULTI, public_tokenizers.PATTERN).count() == 0


def test_chunks_of_odd_white_space():
    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["a  b", "a   b", " a", "a ", "a  ", "a\n b", "a \nb", "a\n \nb", " \n ", "don't  'tis", "aaaaaaaaaaaa bbbb", "\t x  y", "abab" * 50, "  "]
    for text, chunks in zip(texts, tokens._replayed(MULTI, public_tokenizers.PATTERN).values(texts), strict=True):
        assert np.frombuffer(b"".join(chunks), "<i4").tolist() == whole.encode_ordinary(text), repr(text)


def test_length_histogram(docs, rows, empty):
    tokenizer = Tokenizer.from_file(JSON)
    lengths = np.array([len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows])
    got = tokens.length_histogram(tokens.count_tokens(docs, *SAME, added=ADDED)).collect()
    assert sorted(r[0] for r in got) == sorted(set(lengths.tolist()))
    for context, n, total, more, more_tokens, cut, share in got:
        assert (n, total) == ((lengths == context).sum(), lengths[lengths == context].sum())
        assert (more, more_tokens) == ((lengths > context).sum(), lengths[lengths > context].sum())
        assert cut == np.minimum(lengths, context).sum() and abs(share - (lengths <= context).mean()) < 1e-12
    assert tokens.length_histogram(tokens.count_tokens(empty, *SAME)).count() == 0


def test_packing(docs, rows, empty):
    tokenizer = Tokenizer.from_file(JSON)
    pieces = packing.token_pieces(docs, *SAME, limit=256, added=ADDED)
    got = packing.pack(pieces, limit=256).collect()
    ids = {t: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows}
    expected = []
    for i, text in rows:
        x = ids[text]
        edges = [0, *range(len(x) % 256 or 256, len(x) + 1, 256)] if len(x) > 256 else [0, len(x)]
        expected += [(i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *x[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted(tuple(r[:5]) for r in got) == sorted(expected)
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(filled) <= 1.15 * sum(len(ids[t]) for _, t in rows) / 256 + 1
    assert packing.pack(packing.token_pieces(empty, *SAME)).count() == 0


def test_sum_of_squares_takes_the_smallest_sum():
    rng = np.random.default_rng(2)
    packer, gaps = packing.SumOfSquares(20), {}
    for length in rng.integers(1, 21, 300).tolist():
        def total(g):
            after = dict(gaps)
            if g < 20:
                after[g] -= 1
            after[g - length] = after.get(g - length, 0) + 1
            return sum(n * n for gap, n in after.items() if gap)
        options = {g: total(g) for g in [*(g for g, n in gaps.items() if n and g >= length), 20]}
        _, offset = packer.place(length)
        gap = 20 - offset
        assert options[gap] == min(options.values())
        if gap < 20:
            gaps[gap] -= 1
        if gap > length:
            gaps[gap - length] = gaps.get(gap - length, 0) + 1


def test_sharding(docs, rows, empty):
    got = sharding.shard_by_bytes(docs, 7).collect()
    shards, texts = {}, {}
    by_crc = {zlib.crc32((t or "").encode()): len((t or "").encode()) + 16 for _, t in rows}
    for r in got:
        assert r["size"] == by_crc[r["text_crc32"]]
        shards.setdefault(r["shard"], []).append(r["slot"])
        texts.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert len(got) == len(rows) and all(len(s) == 1 for s in texts.values())
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert sharding.shard_by_bytes(empty, 7).count() == 0


def test_minimax_cuts_against_all_cuts():
    rng = np.random.default_rng(4)
    for _ in range(40):
        sizes = rng.integers(1, 30, rng.integers(1, 9))
        best = [[10**9] * 4 for _ in range(len(sizes) + 1)]
        best[0] = [0] * 4
        for k in range(1, 4):
            for e in range(len(sizes) + 1):
                best[e][k] = min(max(best[a][k - 1], int(sizes[a:e].sum())) for a in range(e + 1))
        ends = sharding.minimax_cuts(sizes, 3)
        assert ends[-1] == len(sizes)
        assert max(int(sizes[a:b].sum()) for a, b in zip([0, *ends], ends)) == best[len(sizes)][3]
    assert sharding.minimax_cuts(np.array([], int), 3) == [0, 0, 0]


PRIVATE = [
    (1, "Card 4111111111111111, again 4111 1111 1111 1111 and bad 4111111111111112."),
    (2, "+1 (988) 555-2485 ip 42.144.35.254 and 300.1.1.1"),
    (3, "born 2020-02-29 or 29.02.2020 or 2020/02/29, not 2021-02-29; ssn 123-45-6789 not 000-12-3456"),
    (4, "bosbt.42@mail8.example.com<bosbt.42@mail8.example.com>"),
    (5, None), (6, ""), (7, "no data, v1.2.3, x4111111111111111y"),
]


def test_pseudonyms_keep_formats_and_links(spark, empty):
    df = spark.createDataFrame(PRIVATE, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in pii.pseudonymize(df, pii.TEST_KEY).collect()}
    assert [got[i][1] for i in range(1, 8)] == [2, 2, 4, 2, 0, 0, 0]
    assert got[5][0] is None and got[6][0] == "" and got[7][0] == PRIVATE[6][1]
    assert "4111111111111111" not in got[1][0] and "4111111111111112" in got[1][0] and "300.1.1.1" in got[2][0]
    assert "2021-02-29" in got[3][0] and "000-12-3456" in got[3][0] and "123-45-6789" not in got[3][0]
    first, second = got[4][0].rstrip(">").split("<")
    assert first == second and first.endswith("@mail8.example.com") and first != "bosbt.42@mail8.example.com"
    assert pii.pseudonymize(empty, pii.TEST_KEY).count() == 0


def test_every_ten_digit_phone_and_date_before_a_time(spark):
    values = ["+1 (017) 555-7713", "+1 (132) 555-1352", "+1 988 155 2485", "+10170557713", "2020-02-29", "1999/12/31"]
    rows = [(i, f"at {v}{'T10:30:00Z' if i > 3 else ''}, end") for i, v in enumerate(values)] + [(6, "2021-02-29T10:00 and 2020-02-29x")]
    got = {r[0]: (r[1], r[2]) for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), pii.TEST_KEY).collect()}
    for i, v in enumerate(values):
        text, found = got[i]
        assert found == 1 and v not in text and len(text) == len(rows[i][1])
        assert [c if not c.isdigit() else "0" for c in text] == [c if not c.isdigit() else "0" for c in rows[i][1]]
        assert text.endswith("T10:30:00Z, end" if i > 3 else ", end") and (i > 3 or text.startswith("at +1"))
    assert got[6] == (rows[6][1], 0)


def test_phones_that_begin_low_are_a_permutation(spark):
    texts = spark.createDataFrame([(i, f"+1 (0{i % 100:02d}) {i // 100:03d}-0000") for i in range(2000)], "doc_id long, text string")
    got = pii.pseudonymize(texts, pii.TEST_KEY)
    assert got.select("text").distinct().count() == 2000 and got.where("n_private <> 1").count() == 0


def test_pseudonyms_are_a_permutation(spark):
    texts = spark.createDataFrame([(i, f"10.0.{i // 256}.{i % 256}") for i in range(2000)], "doc_id long, text string")
    assert pii.pseudonymize(texts, pii.TEST_KEY).select("text").distinct().count() == 2000


def test_pseudonyms_against_sql(spark):
    documents = spark.createDataFrame(PRIVATE, "doc_id long, text string").toPandas()  # noqa: F841
    got = sorted(map(tuple, pii.pseudonymize(spark.createDataFrame(PRIVATE, "doc_id long, text string"), pii.TEST_KEY).collect()))
    con = duckdb.connect()
    con.register("documents", documents)
    assert got == sorted(con.sql(pii.oracle(pii.TEST_KEY)).fetchall())


def test_toxicity_finds_the_word_that_decides(spark, empty):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(600):
        w = [f"w{x}" for x in rng.integers(0, 200, 40)]
        label = int(i % 4 == 0)
        if label:
            w[int(rng.integers(40))] = "AWFUL"
        rows.append((i, " ".join(w), label))
    rows += [(600, None, 0), (601, "", 0), (602, "w1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    weights = toxicity.fit(df.where("doc_id % 3 > 0"))
    got = toxicity.score(df, weights).where("doc_id % 3 = 0 and doc_id < 600").collect()
    assert np.mean([(r["score"] >= 0.7) == (r["label"] == 1) for r in got]) > 0.95
    assert toxicity.score(df, weights).where("score between 0 and 1").count() == len(rows)
    assert toxicity.score(empty, weights).count() == 0 and toxicity.fit(df.where("label > 5")) == []


def test_registered_queries_are_whole():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_toxicity_fit_holds_features_of_few_texts(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": [f"bad word{i % 9}" if i % 2 else f"good word{i % 9}" for i in range(1000)], "label": [float(i % 2) for i in range(1000)]})
    texts, features = [], toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda t: texts.append(len(t)) or features(t))
    (whole,), (cut,) = toxicity._fit(iter([batch]), toxicity.Rates()), toxicity._fit(iter([batch.slice(0, 300), batch.slice(300)]), toxicity.Rates())
    assert max(texts) <= 200 and sum(texts) == 2000 and whole.equals(cut) and whole.num_rows > 2


def test_words_of_many_texts_take_little_memory(monkeypatch):
    import tracemalloc

    from loomsync.llm import words

    texts = [" ".join(f"w{i * k % 997}" for k in range(600)).encode() for i in range(1000)] + [b"", b" "]
    tracemalloc.start()
    hashes, owner = words.word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashes) == 600_000 and peak < 40e6
    monkeypatch.setattr(words, "AT_ONCE", 1 << 30)
    for a, b in zip(words.word_hashes(texts), (hashes, owner), strict=True):
        assert np.array_equal(a, b)
    assert [len(x) for x in words.word_hashes([])] == [0, 0]


def test_levels_and_regions_in_parts(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 32, 40, dtype=np.uint32) // (1 << 26) * (1 << 26) + 1) for _ in range(60)]
    row = {"bucket": 3, "tokens": np.concatenate(sets).tobytes(), "cids": np.arange(60).tobytes(), "sizes": np.full(60, 40, np.uint32).tobytes(), "rares": np.full(60, 40, np.uint32).tobytes()}
    row["counts"] = np.array([len(s) for s in sets], np.uint32).tobytes()
    sent = pa.RecordBatch.from_pylist([row])
    packed = sent.select(["bucket", "tokens", "cids", "sizes", "counts"])
    found = []
    for parts in (1, 8):
        monkeypatch.setattr(jaccard, "PARTS", parts, raising=False)
        regions = [r for b in jaccard._regions(iter([packed]), jaccard.THRESHOLD) for r in b.to_pylist()]
        found.append(([b.to_pylist() for b in jaccard._levels(iter([sent]))], regions))
    assert found[0] == found[1] and found[0][1]
