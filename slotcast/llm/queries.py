"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm import merkle, negatives, quality, sharding
from slotcast.llm.bpe_codec import encode_decode
from slotcast.llm.common import read
from slotcast.llm.decontam import leaks
from slotcast.llm.exact_dedup import exact_duplicates
from slotcast.llm.html_crf import extract
from slotcast.llm.minhash import Scheme, near_duplicates
from slotcast.llm.oracles import OP8_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from slotcast.llm.pii import replace_pii
from slotcast.llm.rans import read_tokens, write_tokens
from slotcast.llm.suffix_dedup import remove_repeats
from slotcast.llm.token_counts import token_counts
from slotcast.session import scratch_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
TOKEN_LIMIT = 2048
END_ID = 1
PII_KEY = "corpus-1"
SHARDS = 40


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    coded = encode_decode(docs, public_tokenizers.path(BYTE_BPE))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace_pii(read(spark, sf_dir, "documents"), PII_KEY)
    return replaced.select("doc_id", "text", "n_entities")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), Scheme(words=2)).drop("row")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    counts = token_counts(docs, public_tokenizers.path(WORD_BPE), TOKEN_LIMIT)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "removed", F.lit(0).cast("bigint"), lambda total, span: total + span["b"] - span["a"]
    )
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), END_ID)
    return read_tokens(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(read(spark, sf_dir, "pages"))
    return pages.select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = exact_duplicates(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    longer = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = F.when(picked, longer).otherwise(F.col("n_chars").cast("string"))
    rows = merkle.manifest(read(spark, sf_dir, "documents"), claim={"n_chars": tampered})
    return rows.withColumn("folded_root", merkle.folded("claimed", "path")).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings("path"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_bpe": op2_bpe,
    "op3_pii": op3_pii,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_counts": op5_token_counts,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_html": op10_html,
    "op11_negatives": op11_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle": op13_merkle,
}
ORACLES = {
    "op8_quality": OP8_SQL,
    "op11_negatives": OP11_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
