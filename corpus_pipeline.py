"""From documents to a clean, tokenized corpus: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark.llm import decontaminate, langid, lines, ngram_join, spiece
from pulsemark.llm.catalog import remainder
from pulsemark.llm.sizes import few
from pulsemark.session import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least posterior probability of the predicted language.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or a text, and those whose language is less sure than LEAST_SCORE."""
    model = langid.fit(docs.where(remainder("doc_id", 3) != 1))
    predicted = langid.predict(docs, model, COLUMNS)
    return predicted.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines of templates that recur across documents, and documents of which nothing is left."""
    kept = lines.drop_recurring(docs.select(*COLUMNS))
    left = kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component; rows with one id stay or go together.

    Rows with a null id cannot be named and stay.
    """
    found = ngram_join.near_components(docs, n=5, percent=80)
    gone = cut(found.where("doc_id <> component_id").select("doc_id").distinct())
    return docs.select(*COLUMNS).join(few(gone), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak an item of the benchmark. Rows with a null id stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = cut(decontaminate.find_leaks(docs.withColumnRenamed("doc_id", "id"), benchmark).select(
        F.col("id").alias("doc_id")).distinct())
    return docs.select(*COLUMNS).join(few(leaks), "doc_id", "left_anti").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the SentencePiece ids of every text."""
    return spiece.encode(docs, COLUMNS).drop("decoded")


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", pieces),
]
#: Language identification is a fitted model and the encoding an automaton: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return cut(STAGES[-1][1](spark, docs, sf_dir))


QUERIES = {"pipeline": run}
ORACLE = {}
