"""A corpus pipeline over documents: language, exact copies, near copies, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratapoint.llm import exact_dedup, language_id, mixing, ngram_join, packing, queries
from stratapoint.llm.shared import quoted, stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those unlike every language (no positive cosine); prototypes come from all labelled ones."""
    judged = language_id.judge(docs, language_id.fit(docs), keep=tuple(docs.columns))
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") > 0)
    return judged.where(known).select("kept.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the largest id of equal texts."""
    return exact_dedup.drop_copies(docs).select(*[quoted(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each component of similar ones."""
    return ngram_join.drop_near_duplicates(docs).select(*[quoted(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources come near their targets; copies are rows of their own."""
    return mixing.mixed(docs).select(*[quoted(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places for the pieces of every document; a document that the mix repeats is packed as often."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None  # packing and language prototypes are beyond SQL; the tests compare run() with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
