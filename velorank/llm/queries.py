"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from velorank.session import read_table


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.url_filter import judge_urls
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url")) \
        .select("page_id", "host", "path", "rule", "verdict", "pattern_rule")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.mixing import mix_sources, source_domain
    docs = read_table(spark, sf_dir, "documents")
    return mix_sources(docs, {"domain": source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")})


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.host_quality import judge_documents
    return judge_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm import language_id as L
    docs = read_table(spark, sf_dir, "documents")
    model = L.fit(L.training_rows(docs.select("doc_id", "text", "lang")))
    return L.classify(docs.select("doc_id", "text"), model, score_out="score").select(
        "doc_id", L.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm import lm_score as M
    from velorank.llm.common import remainder
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = M.score_documents(docs, learns=M.learned())
    return scored.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False)))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.html_extract import extract
    return extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "host", "wrapper_pages")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.embedding_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.minhash_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), size=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.line_dedup import dedup_lines
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", "n_lines", "n_deleted", "deleted_lines")


def op9_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.packing import pack
    return pack(read_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.mixing import source_domain
    from velorank.llm.secret_scan import scan
    return scan(read_table(spark, sf_dir, "documents"), source_domain(F.col("source")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.importance import resample
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from velorank.llm.filter_audit import audit
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op11_secret_scan": op11_secret_scan,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
    "op2_line_dedup": op2_line_dedup,
    "op9_length_packing": op9_length_packing,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op1_language_id": op1_language_id,
    "op7_lm_score": op7_lm_score,
    "op10_html_extract": op10_html_extract,
    "op3_url_filter": op3_url_filter,
    "op5_source_mixing": op5_source_mixing,
    "op8_host_quality": op8_host_quality,
}
