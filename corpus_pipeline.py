"""From raw documents to packed training sequences: five stages over operators of ``millgauge.llm``.

Each stage takes all that its predecessor kept. Every stage but the last returns the columns of its
input, rows with nulls, empty texts and repeated rows included, under these decisions:

- language: texts without a letter are rejected; a missing ``lang`` is filled with the language found.
- near duplicates: of each group linked by shingles of five words (met by SimHash signatures and by bands, Jaccard similarity 0.8 or
  more compared exactly) the row with the smallest id stays.
- decontamination: documents that hold a benchmark item are rejected.
- personal data: every span found is replaced by its kind; ``n_chars`` follows the text.
- packing: one row per piece, see ``millgauge.llm.packing``.

Stages tell rows apart by a column of their own, so null and repeated ids do no harm. An empty table
stays empty. Extra columns are passed through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millgauge.llm import decontamination, language, packing, personal, shingles
from millgauge.llm.common import table, written


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += " "
    return name


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a stored number for each row, and the name of that column."""
    number = _free(docs, "row number")
    return written(docs.withColumn(number, F.monotonically_increasing_id()), name), number


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs)
    neutral = docs.toDF(*[f"in {k}" for k in range(len(docs.columns))])  # no name can clash with those of the operator
    place = {c: f"in {k}" for k, c in enumerate(docs.columns)}
    found = language.identify(neutral, model, id_col=place["doc_id"], text_col=place["text"],
                              extra=tuple(c for c in neutral.columns if c != place["doc_id"]))
    kept = found.where(F.col("lang_pred") != language.UNKNOWN)
    value = lambda c: F.coalesce(F.col(f"`{place[c]}`"), F.col("lang_pred")) if c == "lang" else F.col(f"`{place[c]}`")
    return kept.select(*[value(c).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, number = _numbered(docs, "near-duplicates")
    plain = rows.select(F.col(f"`{number}`").alias("row number"), "text")  # no name can clash with those of the operator
    groups = shingles.near_copies(plain, "row number").select(F.col("`row number`").alias("member"), F.col("component").alias("component_id"))
    ids = rows.select(F.col("doc_id").alias("id"), F.col(f"`{number}`").alias("number"))
    first = (groups.join(ids, F.col("member") == F.col("number"))
             .groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("first"))
             .select(F.col("first.number").alias("kept")))
    return rows.join(first.withColumnRenamed("kept", number + "kept"), F.col(f"`{number}`") == F.col(f"`{number}kept`"), "left_semi").select(*_columns(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _free(docs, "text key")
    keyed = docs.withColumn(key, F.md5(F.col("text").cast("binary")))
    plain = keyed.select(F.col(f"`{key}`").alias("text key"), "text")
    found = decontamination.leaks(plain, table(spark, sf_dir, "benchmark"), id_col="text key").select(F.col("`text key`").alias(key + "leak")).distinct()
    return keyed.join(found, F.col(f"`{key}`") == F.col(f"`{key}leak`"), "left_anti").select(*_columns(docs))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, number = _numbered(docs, "personal")
    neutral = rows.toDF(*[f"in {k}" for k in range(len(rows.columns))])
    place = {c: f"in {k}" for k, c in enumerate(rows.columns)}
    masked = personal.mask(neutral, place[number], place["text"]).toDF(*rows.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return masked.select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", detect_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal),
    ("packing", pack),
]

ORACLE_SQL: str | None = None  # fingerprints, latent retrieval and packing have no SQL form; tests hold every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
