"""The corpus pipeline: a chain of the training-data operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm import decontam, langid, packing, secrets, simhash
from volspark.session import ensure_conf, keep

MIN_LANGUAGE_SCORE = 0.3        # of four languages, where 0.25 is an even guess


def clear_enough(score: Column, languages: int) -> Column:
    """Whether a winner stands out from ``languages`` as it does with MIN_LANGUAGE_SCORE from four.

    ``score`` is the winner's share of weight, its own weight being 1; the mean
    weight of the others does not depend on how many they are. A single language
    has no others.
    """
    most = (1 / MIN_LANGUAGE_SCORE - 1) / 3
    return (1 - score) <= most * (languages - 1) * score


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: no letter, or about as likely in any language."""
    model = langid.Model(langid.training_samples(docs))
    found = langid.language_of(F.col("text"), model, spark)
    told = docs.select(F.struct("*").alias("doc"), found.alias("found")).where(
        (F.col("found.lang_pred") != langid.UNDETERMINED)
        & clear_enough(F.col("found.score"), len(model.languages)))
    return told.select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash group: the one with the smallest id, the first of equal ids.

    Rows are told apart by a number of their own, stored so that it stays: ids
    may repeat with other texts, and rows without an id (last in their group)
    are compared like any other.
    """
    rows = keep(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "pipeline-rows")
    found = simhash.near_duplicates(rows, "row", "doc.text", shingle=3, max_bits=3)
    ids = rows.select(F.col("row").alias("id"), F.col("doc.doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id"))
    kept = found.join(ids, "id").groupBy("component_id").agg(first.alias("first")).select(F.col("first.id").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of 10 words of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.found_in(F.col("text"), decontam.phrase_blocks(benchmark), spark)
    judged = docs.select(F.struct("*").alias("doc"), found.alias("found"))
    return judged.where(F.size("found.spans") == 0).select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts by a marker; ``n_chars`` follows."""
    found = secrets.find(docs.withColumn("doc", F.struct("*")), carry=("doc",))
    text = F.col("doc.text")
    clean = secrets.redact(text, F.array_sort(F.concat("base", "added")))
    return found.select("doc", clean.alias("clean")).select(
        [F.col("clean").alias("text") if c == "text"
         else F.when(text.eqNullSafe(F.col("clean")), F.col("doc.n_chars"))
         .otherwise(F.length("clean")).cast(t).alias(c) if c == "n_chars"
         else F.col(f"doc.{c}") for c, t in docs.dtypes])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as sequences of 2048 tokens, one row per piece."""
    return packing.pack(docs, packing.vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what its predecessor wrote."""
    ensure_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
