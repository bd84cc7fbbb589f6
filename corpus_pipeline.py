"""A corpus run of five stages; each reads what the stage before it wrote.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import decontamination, language_id, near_copies, personal, sentencepieces
from tidewright.llm._common import materialize, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not told apart, and fills in a missing ``lang``.

    Dictionaries are made of a bounded sample of the labelled rows of ``docs``.
    """
    return language_id.keep_identified(docs, language_id.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group linked by a Jaccard similarity of 0.8 or more over five-word shingles.

    SimHash segments with one deleted bit find the candidates, which are then checked exactly.
    """
    return near_copies.keep_one_per_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that cover at least half of a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return personal.redact_texts(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text and the text that they decode to."""
    return sentencepieces.encode_texts(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", tokens),
]

#: No SQL: compression, tiling, transducers and piece merging have no DuckDB form. tests/llm compares with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)  # whole texts: a batch of the default 10,000 fills workers
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
