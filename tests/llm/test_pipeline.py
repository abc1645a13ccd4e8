import re
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loomsync.llm import pii, registry

SMALL = "/root/testdata/sf0.001"


def test_pipeline_keeps_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SMALL)
        kept = spark.createDataFrame(kept.toPandas(), docs.schema)
        assert kept.columns == docs.columns, name
        assert kept.count() <= before.count()
        if name in ("suffix_array_dedup", "pii"):
            assert kept.count() == before.count()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in kept.collect()}
    got = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == lengths


def test_one_of_each_group_stays(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(3, text), (1, text + " more"), (1, text + " more"), (7, "other words stand here alone"), (8, ""), (9, None), (10, text.upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, SMALL).collect()) == [1, 7, 8, 9]


@pytest.fixture
def corpus(spark, rows):
    """The common texts with repeated and null ids, and some personal data."""
    more = [(None, rows[3][1]), (None, "call +1 (988) 555-2485 now"), (None, None), (4, "another text of an id that is there, 123-45-6789"), (4, "")]
    whole = [(i, t, "en", "s", len(t or "")) for i, t in [*rows, *more]]
    return whole, spark.createDataFrame(whole, "doc_id long, text string, lang string, source string, n_chars long")


def _shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def _key(row):
    return (row[0] is None, row[0] or 0, row[1] is None, row[1] or "")


def test_near_duplicate_stage_against_all_pairs(spark, corpus):
    whole, docs = corpus
    sets = [_shingles(r[1]) for r in whole]
    label = list(range(len(whole)))
    for i in range(len(whole)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    got = sorted((tuple(r) for r in corpus_pipeline.keep_one_of_each(spark, docs, SMALL).collect()), key=_key)
    ids = {}
    for x, row in zip(label, whole, strict=True):
        ids.setdefault(x, []).append((row[0] is None, row[0] or 0))
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted(min(members) for members in ids.values())
    assert set(got) <= set(whole)


def test_repeat_stage_against_all_windows(spark, corpus):
    whole, docs = corpus
    data = [(r[1] or "").encode() for r in whole]
    seen = Counter(b[i : i + 400] for b in data for i in range(len(b) - 399))
    want = []
    for row, b in zip(whole, data, strict=True):
        mark = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                mark[i : i + 400] = b"\1" * 400
        left = bytes(x for x, m in zip(b, mark, strict=True) if not m).decode("utf-8", "ignore")
        text = left if any(mark) else row[1]
        want.append((row[0], text, row[2], row[3], None if text is None else len(text)))
    got = [tuple(r) for r in corpus_pipeline.remove_repeats(spark, docs, SMALL).collect()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_private_stage_against_sql(spark, corpus):
    whole, docs = corpus
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in whole], pa.int64()), "text": pa.array([r[1] for r in whole], pa.string())}))
    want = sorted(((i, t) for i, t, _ in con.execute(pii.oracle(pii.TEST_KEY)).fetchall()), key=_key)
    got = corpus_pipeline.pseudonymize(spark, docs, SMALL).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=_key) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)


def test_toxic_stage_drops_what_the_query_predicts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    toxic = {r["doc_id"] for r in registry.QUERIES["op9_toxicity"](spark, SMALL).collect() if r["predicted"]}
    kept = {r["doc_id"] for r in corpus_pipeline.reject_toxic(spark, docs, SMALL).collect()}
    assert kept == {r["doc_id"] for r in docs.select("doc_id").collect()} - toxic


def test_repeats_are_cut_and_decoded_in_one_pass(spark):
    """Two Python passes in one stage are two workers per core, which hold their memory to the end."""
    passage = " ".join(f"same{i}" for i in range(80))
    rows = [(1, "é" + passage + " one"), (2, "è" + passage + " two"), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    kept = corpus_pipeline.remove_repeats(spark, docs, SMALL)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"MapInArrow[^\n]*\n([ :+|-]*Project[^\n]*\n)*[ :+|-]*MapInArrow", plan)
    # "é" and "è" end in different bytes, so both stay whole; the space after the passage is part of it.
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()) == [(1, "éone", 4), (2, "ètwo", 4), (3, None, None)]
