"""The corpus pipeline over ``documents``.

Language ID drops texts without a letter; SimHash near-dedup keeps one
document of each group; suffix-array dedup removes repeated byte
strings; decontamination drops documents with benchmark passages; packing
turns what is left into sequences.  Each stage reads its predecessor's
Parquet output and, but for the last, returns the columns of the table
that it was given, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, quoted
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.language_id import NO_LETTER, PREDICTED, identify, learn
from tidemark.llm.packing import pack_documents
from tidemark.llm.simhash import keep_one_of_each
from tidemark.llm.suffix_dedup import dedup_suffixes


def as_documents(docs: DataFrame, found: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` in their order, the carried ones from ``found.row``; n_chars follows the text."""
    column = {c: F.col(f"row.{quoted(c)}") for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in column:
        column["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[column[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] = (), least_score: float = 0.0) -> DataFrame:
    """Documents with a language: those with a letter, also when no label was there to learn from.  The label may be
    missing or wrong; it stays as it is.  ``languages``: only documents predicted to be in one of them (empty: any);
    ``least_score``: of predicted documents only those of at least that score.  Neither rejects unless it is given."""
    found = identify(docs, learn(docs)).filter(F.col("outcome") != NO_LETTER)
    if languages:
        found = found.filter(F.col("lang_pred").isin(*languages))
    if least_score:
        found = found.filter((F.col("outcome") != PREDICTED) | (F.col("score") >= least_score))
    return found.select(*[(F.col("text") if c == "text" else F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return keep_one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the byte strings that also start earlier.  A character that a cut has
    split goes too; a document of which nothing is left stays, empty."""
    return as_documents(docs, dedup_suffixes(docs, as_text=True), F.col("kept"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter(~F.col("contaminated"))
    return found.select(*[(F.col("text") if c == "text" else F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, carry=["doc_id"]).select(
        "row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]
#: SQL cannot express language ID, SimHash or packing; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
