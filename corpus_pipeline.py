"""Corpus pipeline: toxicity, near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and reread as
the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reportlake.llm import nearset, packing, pii, queries, toxicity
from reportlake.llm.common import ready, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from ``labels`` does not reject."""
    ready(spark)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (the smallest id) and every document without a group; of rows that repeat
    id and text, one stays. Rows with a null id are in no group."""
    found = stored(nearset.near_duplicates(docs, width=5, percent=80), "groups")
    rest = docs.join(found.filter("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = stored(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rest
    again = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets and ``n_chars`` set anew."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), queries.BYTE_PATTERN,
                        ascii_pattern=queries.BYTE_PATTERN_ASCII).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

#: No stage but the plain columns can be said in SQL: the lexicon is learned, links are confirmed on sets of
#: shingles, patterns are bootstrapped, ids come from a tokenizer. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
