"""One thin query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, fixity, language, mixing, nearest, negatives, packing, pages, personal, repeats, simhash, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_language")
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", F.expr("coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false)"))
    model = language.learn(docs.where("doc_id is not null and not held_out"))
    found = language.identify(docs, model, extra=("held_out",))
    return found.select("doc_id", "held_out", "lang_pred", "score", "spans")


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op5_personal")
def op5_personal(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.extract(table(spark, folder, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in personal.KINDS], "base_sha256", "spans")


@query("op1_nearest", """
WITH usable AS (
    SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)])::BIGINT AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_pages")
def op3_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    remainder = F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4")
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))
    model = toxicity.learn(docs, table(spark, folder, "labels").where(remainder != 2))
    return toxicity.score(docs, model, extra=("held_out",))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_WARC = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || coalesce(page_id::VARCHAR, '') || '>'
  || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(body)::VARCHAR
  || chr(13) || chr(10) || chr(13) || chr(10) || body || chr(13) || chr(10) || chr(13) || chr(10)"""


@query("op2_fixity", f"""
WITH good AS (SELECT page_id, sha256({_WARC}) AS digest FROM (SELECT page_id, url, coalesce(html, '') AS body FROM pages)),
damaged AS (SELECT page_id, sha256({_WARC}) AS digest FROM (SELECT page_id, url, '~' || substr(coalesce(html, ''), 2) AS body FROM pages WHERE page_id % 97 = 5))
SELECT g.page_id, CASE WHEN g.page_id % 101 = 7 THEN 'missing' ELSE 'altered' END AS kind, g.digest AS expected_sha256,
  CASE WHEN g.page_id % 101 <> 7 THEN d.digest END AS found_sha256
FROM good g LEFT JOIN damaged d USING (page_id)
WHERE g.page_id % 101 = 7 OR g.page_id % 97 = 5 AND g.digest <> d.digest
""")
def op2_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as archives, against a replica in which the first byte of some records changed and others are lost."""
    rotten = F.concat(F.lit("~"), F.substring(F.coalesce("html", F.lit("")), 2, 1 << 30))
    held = fixity.inventory(table(spark, folder, "pages"), replica=F.when(F.col("page_id") % 97 == 5, rotten).otherwise(F.col("html")))
    replica = held.where("NOT coalesce(record_id % 101 = 7, false)").drop("digest").withColumnRenamed("replica", "digest")
    return fixity.audit(held, replica).select(F.col("record_id").alias("page_id"), "kind", "expected_sha256", "found_sha256")


@query("op11_negatives", """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           coalesce(list_sum([p[1] * p[2] for p in list_zip(a.v, c.v)]), 0)::BIGINT AS score
    FROM usable a JOIN usable c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), fitting AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 3
""")
def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", shifted)
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)


@query("op12_divergence", r"""
WITH rows AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (SELECT id, lang, source, unnest(terms) AS term FROM rows),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
groups AS (SELECT DISTINCT lang, source FROM rows),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS size FROM counts GROUP BY lang, source),
langs AS (SELECT lang, count(*) AS kinds, sum(total)::HUGEINT AS size FROM kept GROUP BY lang),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.size, 0) + l.kinds))::BIGINT AS p,
           (1 + 1000000000::HUGEINT * (k.total + 1) // (l.size + l.kinds))::BIGINT AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c USING (lang, source, term) LEFT JOIN sizes s USING (lang, source)
), priced AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query("op13_mixing")
def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
