"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import decontamination, filter_audit, language_id, ngram_join, periodic_runs, personal, quality_fm, quality_rules, secrets, sentencepieces, simhash, suffix_dedup, token_counts
from tidewright.llm._common import table


def remainder(modulus: int, of: int) -> Column:
    """Whether crc32 of the id's text leaves ``of``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == of, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = language_id.learn(docs.where(~remainder(4, 2)))
    found = language_id.identify(docs.select("doc_id", "text"), sample)
    return found.select("doc_id", remainder(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict, _ = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdict.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoding_digests(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs, secrets.train(docs))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), remainder(5, 0)
    machine = quality_fm.learn(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    return quality_fm.classify(docs, machine).withColumn("held_out", held).select("doc_id", "held_out", "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"))


def words_with_runs(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text; in one of ten ids, by its checksum, those from some place on repeat with some period."""
    words = periodic_runs.words_of(doc_id, text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"), words=words_with_runs)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_quality_rules, op4_token_counts, op5_sentencepiece, op6_suffix_dedup, op7_secrets, op8_personal_data, op9_simhash, op10_quality_fm, op11_filter_audit, op12_ngram_join, op13_periodic_runs, pipeline)}

#: The other operators have no DuckDB form for their full result; tests/llm holds them against plain code.
ORACLE_SQL: dict[str, str] = {"op11_filter_audit": filter_audit.ORACLE_SQL, "op12_ngram_join": ngram_join.ORACLE_SQL}
