"""The registered queries of the document operators; each applies its operator to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm import conversations, exactdedup, langid, linededup, minhash, packing, pii, resampling, segment, sharding, simhash, tokenfiles, warc
from gridledger.llm.common import documents, new_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 24


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.edited(documents(spark, folder))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), VOCABULARY)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: counts of the shards differ by one at most."""
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    docs = documents(spark, folder).select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    placed = sharding.shuffle_into_shards(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return segment.summaries(segment.encode(documents(spark, folder), PIECES), PIECES)


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_groups(documents(spark, folder), simhash.LINKS_OF_FOUR)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from two thirds of the ids; the language column is read for those only, and never by the prediction."""
    docs = documents(spark, folder)
    filters = langid.learn(docs.where(~langid.held_out()))
    found = langid.predicted(docs.select("doc_id", "text"), filters, carry=["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return pii.found(docs, pii.learn(docs))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_duplicates(documents(spark, folder))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenfiles.write_tokens(documents(spark, folder), path, VOCABULARY)
    return tokenfiles.checksums(tokenfiles.read_tokens(spark, path))


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.towards_benchmark(spark, folder)


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repairs_of_damaged(spark, folder)


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_archive(spark, folder)


QUERIES = {
    "op1_minhash": op1_minhash, "op2_packing": op2_packing, "op3_sharding": op3_sharding, "op4_line_dedup": op4_line_dedup,
    "op5_sentencepiece": op5_sentencepiece, "op6_simhash": op6_simhash, "op7_language_id": op7_language_id, "op8_pii": op8_pii,
    "op9_exact_dedup": op9_exact_dedup, "op10_token_files": op10_token_files,
    "op11_resampling": op11_resampling, "op12_conversations": op12_conversations, "op13_warc": op13_warc,
}

ORACLES = {
    "op4_line_dedup": linededup.SQL,
    "op13_warc": warc.SQL,
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
 doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256 FROM documents""",
}
