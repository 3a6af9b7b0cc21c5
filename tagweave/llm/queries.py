"""Registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dartminhash, decontaminate, html_text, language, merkle, mixing, multiindex, personal, substring, toxicity, url_templates, wavelet, whitening
from .common import held_out, scratch_path, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score_documents(docs, model)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs, ~held_out(F.col("doc_id"))))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token shards of ``docs`` to the shared folder and read them back."""
    folder = scratch_path(spark, "token-shards")
    return wavelet.read_shards(wavelet.write_shards(docs, folder, tokenizer_path()), folder)


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.remove_repeats(table(spark, sf_dir, "documents")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digests(personal.personal_data(table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it builds on this module
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_toxicity,
    op2_language_id,
    op3_token_shards,
    op4_decontaminate,
    op5_near_dedup,
    op6_embedding_dedup,
    op7_html_text,
    op8_mix_sources,
    op9_url_filter,
    op10_substring_dedup,
    op11_merkle_manifest,
    op12_personal_data,
    op13_whitening,
    pipeline,
)}
ORACLE = {
    "op8_mix_sources": mixing.MIX_SQL.format(docs="documents", temperature=0.7, seed="mix-1"),
    "op10_substring_dedup": substring.SUBSTRING_SQL,
    "op11_merkle_manifest": merkle.MERKLE_SQL,
}
