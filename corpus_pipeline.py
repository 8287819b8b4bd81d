"""Corpus pipeline: documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next one's docs.  All but the last return the columns of documents.

A row is known by its id and its text.  Rows with a null id are told apart by their texts and come after all
others; of rows with the same id and text, the third stage keeps one, and the fourth takes all or none.  Extra
columns pass through whatever their names.

1. language_id: drops documents without a letter and those whose n-grams no language knows.
2. line_dedup: deletes later copies of repeated line runs; documents left without a word go.
3. minhash_dedup: one row of each near-duplicate group stays, the smallest doc_id.
4. source_mixing: documents of over-represented sources go until the token budget is met.
5. packing: sequences in length buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from velorank.llm import language_id, line_dedup, minhash_dedup, mixing, packing
from velorank.llm.common import private
from velorank.session import materialize, read_table

MIN_LANGUAGE_SCORE = 0.2           # corrected share of a text's n-grams that its language explains
MIX_BUDGET = (9, 10)               # of the tokens; one epoch, so that no document is repeated


def row_key() -> Column:
    """What tells rows apart: the id (null last) and 128 bits of the text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(language_id.training_rows(docs.select("doc_id", "text", "lang")))
    lang, score = private(docs, "_lang", "_score")
    told = language_id.classify(docs, model, lang_out=lang, score_out=score)
    return told.where((F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = ["n_lines", "deleted_lines", "n_deleted"]
    taken = [c for c in docs.columns if c.lower() in new]          # columns of the input: under other names meanwhile
    held = dict(zip(taken, private(docs, *taken), strict=True))
    done = line_dedup.dedup_lines(docs.withColumnsRenamed(held))
    left = (F.col("n_deleted") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    kept = done.where(left).drop(*new).withColumnsRenamed({v: k for k, v in held.items()})
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, kept_row = private(docs, "_row", "_kept")
    rows = docs.withColumn(row, row_key())
    kept = minhash_dedup.near_duplicates(rows, doc_id=row).where("kept").groupBy(F.col("doc_id").alias(kept_row)).agg(F.count(F.lit(1)).alias("n"))
    kept = materialize(kept, "kept-rows")
    if kept.where("n > 1").limit(1).count():
        rows = rows.dropDuplicates([row])                          # combined in each task before the shuffle
    return rows.join(kept.select(kept_row).hint("shuffle_hash"), F.col(row).eqNullSafe(F.col(kept_row)), "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    levels = {"domain": mixing.source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    row, picked_row = private(docs, "_row", "_picked")
    rows = docs.withColumn(row, row_key())
    picked = mixing.mix_sources(rows, levels, epochs=1, budget=MIX_BUDGET, doc_id=row).select(F.col("doc_id").alias(picked_row)).distinct()
    return rows.join(materialize(picked, "picked-rows").hint("shuffle_hash"), F.col(row).eqNullSafe(F.col(picked_row)), "left_semi").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_documents),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Chosen-path clustering and the packing's dynamic programme are not SQL; a brute-force version tests the run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
