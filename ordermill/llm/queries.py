"""One query per corpus operator over whole tables, with SQL counterparts where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    byte_pairs,
    decontamination,
    importance,
    language,
    licenses,
    mixing,
    neighbours,
    quality,
    ranked_search,
    secret_scan,
    simhash,
    suffix_dedup,
    tokens,
)
from ordermill.llm.common import fold, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, F.coalesce(fold("doc_id", 4) != 2, F.lit(False)))
    return found.withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return found.withColumn("held_out", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_pairs.encode_and_decode(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_language_id, op3_secret_scan, op4_source_mix, op5_token_counts,
        op6_license_scan, op7_suffix_dedup, op8_nearest_vectors, op9_simhash, op10_quality,
        op11_byte_pairs, op12_ranked_search, op13_importance,
    )
}

WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

CONTAMINATION_SQL = f"""
WITH words(side, id, w) AS (
    SELECT 'd', doc_id, regexp_extract_all(lower(text), {WORDS}) FROM documents
    UNION ALL SELECT 'b', item_id, regexp_extract_all(lower(text), {WORDS}) FROM benchmark
), shingles AS (
    SELECT DISTINCT side, id, 5 AS size, array_to_string(w[k:k + 4], ' ') AS s
    FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS k FROM words)
    UNION SELECT side, id, len(w), array_to_string(w, ' ') FROM words WHERE side = 'b' AND len(w) BETWEEN 1 AND 4
    UNION SELECT side, id, size, array_to_string(w[k:k + size - 1], ' ')
    FROM (SELECT side, id, w, size, unnest(range(1, len(w) - size + 2)) AS k
          FROM words, (SELECT DISTINCT len(w) AS size FROM words WHERE side = 'b' AND len(w) BETWEEN 1 AND 4) sizes
          WHERE side = 'd')
), totals AS (SELECT id, count(*) AS total FROM shingles WHERE side = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*)::INTEGER AS matched, any_value(t.total)::INTEGER AS total,
    count(*) / any_value(t.total)::DOUBLE AS containment
FROM shingles d JOIN shingles b ON d.s = b.s AND d.size = b.size AND d.side = 'd' AND b.side = 'b' JOIN totals t ON t.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= {decontamination.CONTAINMENT} * any_value(t.total)
"""

MIX_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
    FROM documents
), sources AS (
    SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), weighted AS (SELECT *, 1 + place % 3 AS weight, 3 * source_size AS ceiling FROM sources
), rounds(turn, stopped, sharing, pool) AS (
    -- Each round stops the sources that their share of what is left would carry over their ceiling.
    SELECT 0, []::BIGINT[], (SELECT sum(weight) FROM weighted), (SELECT sum(source_size) FROM weighted)
    UNION ALL
    SELECT turn + 1, list_concat(stopped, more.places), sharing - more.weight, pool - more.ceiling
    FROM rounds, LATERAL (
        SELECT list(place) AS places, sum(weight) AS weight, sum(ceiling) AS ceiling FROM weighted
        WHERE NOT list_contains(stopped, place) AND weight * pool > ceiling * sharing
    ) more
    WHERE more.places IS NOT NULL
), last AS (SELECT * FROM rounds ORDER BY turn DESC LIMIT 1
), plan AS (
    SELECT source, source_size, CASE WHEN list_contains(stopped, place) THEN ceiling::DOUBLE
        ELSE (weight * pool)::DOUBLE / sharing::DOUBLE END AS target
    FROM weighted, last
), placed AS (
    SELECT doc_id, z.source, size, source_size, target, least(round(target)::BIGINT, 3 * source_size) AS budget,
        sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized z JOIN plan p ON z.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken
FROM placed
"""

NEAREST_SQL = """
WITH held AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
    FROM held q JOIN held c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SQL = f"""
WITH terms AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({LOWER}, {WORDS}) AS w FROM documents
), documents_held AS (SELECT doc_id, row, w, len(w) AS n FROM terms WHERE len(w) > 0
), totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM documents_held
), asked AS (
    SELECT item_id, term, count(*)::BIGINT AS times
    FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, {WORDS})) AS term FROM benchmark) GROUP BY ALL
), occurring AS (
    SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM documents_held)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM occurring, totals GROUP BY term, n_docs
), impacts AS (
    SELECT row, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS impact
    FROM occurring JOIN documents_held USING (row), totals
), scored AS (
    SELECT item_id, row, sum(times * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, row
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored JOIN documents_held USING (row) WHERE score > 0 QUALIFY rank <= {ranked_search.BEST}
"""

IMPORTANCE_SQL = f"""
WITH registers AS (
    SELECT list(v ORDER BY b) AS crc_table FROM (
        SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) t(b)
    )
), words AS (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all({LOWER}, {WORDS}), []) AS w FROM documents
    UNION ALL SELECT 'b', NULL, NULL, coalesce(regexp_extract_all({LOWER}, {WORDS}), []) FROM benchmark
), runs AS (
    SELECT side, row, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS feature FROM words
), counted AS (SELECT side, row, feature, count(*) AS times FROM runs GROUP BY ALL
), hashed AS (
    SELECT feature, xor(4294967295, list_reduce(
        [4294967295] || list_transform(range(1, len(hex(feature)), 2), lambda k: ('0x' || substr(hex(feature), k, 2))::BIGINT),
        lambda c, x: xor(c >> 8, crc_table[xor(c & 255, x) + 1]))) % {importance.BUCKETS} AS bucket
    FROM (SELECT DISTINCT feature FROM counted), registers
), placed AS (SELECT side, row, bucket, sum(times) AS times FROM counted JOIN hashed USING (feature) GROUP BY ALL
), totals AS (
    SELECT bucket, coalesce(sum(times) FILTER (side = 'd'), 0) AS s, coalesce(sum(times) FILTER (side = 'b'), 0) AS t
    FROM placed GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {importance.BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + {importance.BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM totals
), weighed AS (
    SELECT row, sum(times) AS n_features, floor(sum(gain * times)::DOUBLE / sum(times)::DOUBLE)::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
    SELECT doc_id, len(w) >= {importance.LEAST_WORDS} AS eligible, coalesce(n_features, 0)::BIGINT AS n_features,
        coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((
        ('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN weighed USING (row) WHERE side = 'd'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS place,
        {importance.PERCENT} * count(*) OVER (PARTITION BY eligible) // 100 AS wanted
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= wanted THEN place END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": CONTAMINATION_SQL,
    "op4_source_mix": MIX_SQL,
    "op8_nearest_vectors": NEAREST_SQL,
    "op12_ranked_search": RANKED_SQL,
    "op13_importance": IMPORTANCE_SQL,
}
