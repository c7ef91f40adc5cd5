"""The document pipeline: toxicity, near-dedup, mixing to target weights, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvox.llm import bpe, mixing, simhash, toxicity
from corvox.llm.common import written
from corvox.llm.queries import _tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, learned from these documents' labels, doesn't reject.

    A null or empty text is no evidence and stays; repeated rows share their fate; a null doc_id has no label, but its
    text is scored. Without labels of both kinds all documents stay. Other columns may have any names, those that the
    operator adds included. An empty table gives no rows.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    kept = toxicity.scored(plain, model, f"c{docs.columns.index('text')}").where("predicted = 0")
    return kept.select(*plain.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, Jaccard 0.8): the one with the smallest doc_id.

    Candidates share a signature of their SimHash prints, a segment with a block left out; their whole sets decide. Null
    and empty texts are copies of one another; of rows with one doc_id and text one stays; rows with a null doc_id all
    stay. Other columns may have any names. An empty table gives no rows.
    """
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each time they come, in training order.

    A null text has size 0, and its document is taken as one of no words; a null source is a source. Equal positions
    follow doc_id; of rows that are equal either may be taken. Other columns may have any names. An empty table gives no
    rows.
    """
    return mixing.in_training_order(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and digests of the ids and the decoded text of each row.

    A null text counts as empty: no tokens, and the digest of nothing. Repeated rows are each tokenized; other columns
    aren't read. An empty table gives no rows.
    """
    out = bpe.round_trip(docs.select("doc_id", "source", "text"), _tokenizer())
    return out.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", drop_near_copies), ("mixing", mix_sources), ("bpe", tokenize)]

#: The stages hold trained and tokenizer steps, which SQL can't express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each but the last written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
