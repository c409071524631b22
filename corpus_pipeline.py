"""Cleaning of a training corpus: quality, near duplicates, test items, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns rows with the columns of ``documents``, only the
last returns the encoded texts. ``run`` writes every stage's result to the shared folder and goes
on from there, so a lost executor costs no finished stage.

Defined cases: a null text counts as empty, has no words and is rejected by the quality stage; in
the later stages it is linked with nothing, holds no test item and no personal data, stays null and
encodes to no tokens. A null id or language is kept as it is; a null host is judged by the base
rules alone. Rows that are equal in id and text are one document to near duplicates, of which one
row stays. Of a group without ids one row of each distinct text stays. Whole texts of any length are
read. Columns that ``documents`` does not have, whatever their names, pass through all stages but
the last. An empty table gives empty results with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.bpe_codec import encode_decode
from slotcast.llm.common import read
from slotcast.llm.decontam import keep_unleaked
from slotcast.llm.minhash import Scheme, keep_first
from slotcast.llm.pii import replace_pii
from slotcast.llm.quality import keep_good
from slotcast.session import materialize

TOKENIZER = "byte_bpe_50k.json"
PII_KEY = "corpus-1"
#: What a worker remembers of chunks: the heap is full from the stages before the encoding.
ENCODER_MEMORY = 32 << 20
#: SQL cannot state near duplicates, keyed surrogates or byte-pair encoding.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their hosts reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return keep_first(docs, Scheme(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return keep_unleaked(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates take the place of personal data; n_chars follows the text."""
    replaced = replace_pii(docs, PII_KEY).drop("n_entities")
    return replaced.withColumn("n_chars", F.char_length("text").cast("bigint"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, n_decoded (characters read back from the ids)."""
    coded = encode_decode(docs, public_tokenizers.path(TOKENIZER), memory=ENCODER_MEMORY)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.char_length("decoded").cast("bigint").alias("n_decoded"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
