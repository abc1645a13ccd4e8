"""Queries of the operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsync.llm import ann, collocations, jaccard, mtree, packing, pii, repeats, sharding, tokens, toxicity, warc, whitening
from loomsync.llm.common import read
from loomsync.session import shared_dir

QUERIES = {}
ORACLE = {}

#: One vocabulary, as ranks with the split pattern and as the file that names its added tokens.
SMALL = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SMALL_JSON = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    done = repeats.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    kept = F.make_valid_utf8(F.col("_kept").cast("string")).alias("kept_text")
    return done.select("doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"), kept)


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query(
    "op2_ngram_jaccard_join",
    f"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
    s AS (SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS sh FROM w),
    e AS (SELECT rid, unnest(sh) AS x FROM s),
    p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS o FROM e a JOIN e b USING (x) WHERE a.rid <> b.rid GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN s sa ON sa.rid = a JOIN s sb ON sb.rid = b WHERE 100 * o >= 75 * (len(sa.sh) + len(sb.sh) - o)),
    r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
    SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
    FROM s JOIN r ON r.a = s.rid JOIN s o ON o.rid = r.b GROUP BY s.rid, s.doc_id, len(s.sh)""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, folder, "documents"))


@query("op3_pii_pseudonyms", pii.oracle(pii.TEST_KEY))
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymize(read(spark, folder, "documents").select("doc_id", "text"), pii.TEST_KEY)


@query("op4_token_counts")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.count_tokens(read(spark, folder, "documents").select("text"), *SMALL, added=tokens.added_tokens(SMALL_JSON))
    return tokens.length_histogram(counts)


@query("op5_byte_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = tokens.encode(read(spark, folder, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    decoded = tokens.decode(encoded.drop("text"), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_best_fit_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(read(spark, folder, "documents"), *SMALL, added=tokens.added_tokens(SMALL_JSON))
    return packing.pack(pieces)


@query(
    "op7_exact_top_k",
    """WITH v AS (SELECT row_number() OVER () AS rid, vec_id, [floor(x::DOUBLE * 1024)::BIGINT FOR x IN embedding] AS q FROM embeddings
        WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
    e AS (SELECT rid, vec_id, generate_subscripts(q, 1) AS i, unnest(q) AS x FROM v),
    s AS (SELECT a.rid AS asks, a.vec_id AS query_id, b.rid, b.vec_id, sum(a.x * b.x)::BIGINT AS score FROM e a JOIN e b USING (i) WHERE a.vec_id % 100 = 0 AND a.rid <> b.rid GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY asks ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").where(mtree.usable("embedding")).select("vec_id", mtree.quantized("embedding").alias("vector"))
    return mtree.top_k(rows, F.col("vec_id") % 100 == 0, 10)


@query("op8_approximate_neighbours")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.toxic_weights(docs, read(spark, folder, "labels")))
    return scored.select("doc_id", (~toxicity.train_split()).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op10_sharding")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(read(spark, folder, "documents"), 40)


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    return whitening.report(whitening.whiten(vectors, model), model)


_BASE32 = "upper(" + " || ".join(f"lpad(to_base(('0x' || h[{1 + 5 * i}:{5 + 5 * i}])::BIGINT, 32), 4, '0')" for i in range(8)) + ")"


@query(
    "op12_warc",
    f"""WITH p AS (SELECT row_number() OVER () AS record, page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    r AS (SELECT *, first_value(record) OVER w AS kept, first_value(page_id) OVER w AS kept_id FROM p
        WINDOW w AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, record DESC))
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
        translate({_BASE32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
        CASE WHEN record = kept THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN record <> kept THEN kept_id END AS refers_to
    FROM r""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    warc.write_archives(read(spark, folder, "pages"), path)
    return warc.records(warc.read_archives(spark, path, payload=False))


@query(
    "op13_collocations",
    r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM d),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS words FROM p),
    g AS (SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
        FROM w, range(1, 6) AS s(size)),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= 100),
    b AS (SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, array_to_string(words[1:size - 1], ' ') AS phrase FROM c UNION ALL SELECT lang, a, array_to_string(words[2:], ' ') FROM c) GROUP BY ALL),
    u AS (SELECT c.* FROM c LEFT JOIN b USING (lang, phrase) WHERE b.most IS NULL OR 100 * b.most < 100 * c.a),
    k AS (SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest FROM u, range(1, 5) AS t(k) WHERE k < size),
    s AS (SELECT k.*, l.f AS l, r.f AS r, n.n, ((1000::HUGEINT * k.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM k JOIN f AS l ON l.lang = k.lang AND l.phrase = k.first JOIN f AS r ON r.lang = k.lang AND r.phrase = k.rest JOIN n ON n.lang = k.lang),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM s),
    t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o WHERE nth = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM t WHERE rank <= 2000""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))
