"""The registered queries of the subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.decontaminate import find_leaks
from tidewatch.llm.fingerprints import edit_report
from tidewatch.llm.jaccard import ngram_components
from tidewatch.llm.language import fit_language_model, identify
from tidewatch.llm.packing import pack
from tidewatch.llm.piecewise import piece_report
from tidewatch.llm.pii import PII_SQL, find_pii, pii_report
from tidewatch.llm.quality import fit_quality_model, score_quality
from tidewatch.llm.secrets import scan_secrets, secret_report
from tidewatch.llm.spelling import spelling_variants
from tidewatch.llm.tokens import count_tokens
from tidewatch.llm.urls import judge_urls
from tidewatch.llm.whitening import whitening_report

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(scan_secrets(table(spark, sf_dir, "documents")))


@register
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def fold(id: str, folds: int) -> F.Column:
    """Checksum of the id as text, modulo `folds`; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % folds, F.lit(0))


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_language_model(documents.where(fold("doc_id", 4) != 2))
    found = identify(documents, model, keep=["doc_id"])
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@register
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(find_pii(table(spark, sf_dir, "documents")))


LLM_ORACLES["op4_personal_data"] = PII_SQL


@register
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = fit_quality_model(documents, labels, label="quality")
    scored = score_quality(documents, model, keep=["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", predicted)


@register
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents"))


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@register
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))


@register
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
