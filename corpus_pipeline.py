"""A corpus pipeline out of the operators in lectern.llm.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a
DataFrame; run() writes what a stage returns as Parquet into the shared folder and reads
it again as the docs of the next, so a lost executor repeats no earlier stage. What a stage
wrote on its way, and its result once the next stage is written, are removed.

1 quality    documents that the quality rules reject go
2 exact      of texts that are equal but for white space, the row with the smallest id stays
3 near       of each group of near copies, the row with the smallest id stays
4 mix        all documents, put in the order that mixes the sources to their target shares:
             the files, and the rows in each, follow the schedule
5 tokens     one row per document with its SentencePiece ids, mix_slot and mix_position, in the
             order of the schedule

All stages but the last return the columns of documents. Empty tables pass through all stages.
Spark does not read files in the order of their names, so tokens works the schedule out again:
it depends on the ids and sources alone, and these are the same before and after mix. The rows
of run() are sorted by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import exact_dedup, mixing, quality, sentencepiece_codec, simhash
from lectern.shared import remove, scratch, shared_dir

#: The rows of run() depend on XXH64 hashes, merges and a schedule, which SQL can't express.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_sample(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep(docs, trusted)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.ordered(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ordered = mixing.in_order(mixing.mix(docs))
    return sentencepiece_codec.encode_documents(ordered, public_tokenizers.path("piece_bpe_32k.model"), memory=150_000, forget=True, keep=("mix_slot", "mix_position"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact", drop_exact),
    ("near", drop_near),
    ("mix", mix_sources),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, in the order of the schedule."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = None
    for name, stage in STAGES:
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            schema = out.schema
            out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(schema).parquet(f"{folder}/{name}")
        if done:
            remove(spark, f"{folder}/{done}")
        done = name
    return mixing.in_order(docs)
