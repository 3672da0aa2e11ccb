"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, html_extract, language_id, mixing, nearest, ngram_join, packing, substring_dedup, toxicity, url_filter
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]


def _crc(modulus: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents")).drop("bucket", "chain")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (_crc(3) == 1).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(_crc(3) != 1).where("toxic is not null").select("doc_id", "toxic")
    bounded = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(toxicity.SAMPLE)  # so few rows can be broadcast
    model = toxicity.fit(docs.join(F.broadcast(bounded), "doc_id"))
    return toxicity.score(docs, model, keep=("held_out",)).select("doc_id", "held_out", "score", "predicted", "hits")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (_crc(4) == 2).alias("held_out"))
    prototypes = language_id.fit(docs.where("not held_out"))
    return language_id.identify(docs, prototypes, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_html_extraction": op2_html_extraction,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_url_filters": op6_url_filters,
        "op7_toxicity": op7_toxicity,
        "op8_nearest_neighbours": op8_nearest_neighbours,
        "op9_language_id": op9_language_id,
        "op10_mixing": op10_mixing,
    }


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return oracles.ORACLES
