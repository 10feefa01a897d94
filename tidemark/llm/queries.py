"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe_automaton import decode_documents, encode_documents
from tidemark.llm.collocations import collocations
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.embedding_dedup import embedding_components
from tidemark.llm.language_id import held_out, identify, learn
from tidemark.llm.lm_scoring import score_documents
from tidemark.llm.packing import pack_documents
from tidemark.llm.prefix_trie import conversation_trie
from tidemark.llm.simhash import simhash_components
from tidemark.llm.suffix_dedup import dedup_suffixes
from tidemark.llm.substring_dedup import dedup_substrings
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.warc import as_responses, derivatives, read_warc, write_warc
from tidemark.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = as_responses(table(spark, sf_dir, "pages"))
    files = write_warc(derivatives(responses), work_dir(spark, "warc"))
    head = lambda name: F.element_at("headers", name)
    read = read_warc(spark, files).select(
        head("WARC-Refers-To").alias("refers_to"), head("WARC-Type").alias("record_type"), head("WARC-Record-ID").alias("record_id"),
        head("WARC-Concurrent-To").alias("concurrent_to"), head("WARC-Target-URI").alias("target_uri"),
        head("WARC-Source-Payload-Digest").alias("source_payload_digest"), head("WARC-Block-Digest").alias("block_digest"),
        F.length("block").cast("long").alias("n_bytes"), F.sha2("block", 256).alias("block_sha256"))
    keys = responses.select("row.page_id", F.col("record_id").alias("refers_to")).distinct()
    return read.join(keys.hint("merge"), "refers_to")  # the planner cannot know how much the files hold


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_suffixes(docs).select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_dir(spark, "token-files")
    write_token_files(docs, path)
    return read_token_files(spark, path)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_components(table(spark, sf_dir, "embeddings"))
    return found.select("row.vec_id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return score_documents(docs, good).select("row.doc_id", "n_tokens", "loss_target", "loss_background", "score")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, with_ids=False).select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs).select("row.doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode_documents(encode_documents(docs)).select(
        "row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc_derivatives, op2_suffix_dedup, op3_language_id, op4_token_files, op5_embedding_near_dedup, op6_decontaminate, op7_substring_dedup, op8_lm_scoring, op9_pack, op10_simhash_near_dedup,
    op11_bpe_automaton, op12_conversation_trie, op13_collocations)}
