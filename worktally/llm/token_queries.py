"""Encoding and packing of the documents (problems 6 and 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from worktally.llm.bpe import count_tokens, encode_texts
from worktally.llm.packing import balance_report, fill_report, pack


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k, without special tokens."""
    return encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def p7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document or piece, for every container kind."""
    lengths = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pack(lengths, spark.read.parquet(f"{sf_dir}/container_sizes.parquet"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and unused share of each container kind."""
    return fill_report(p7_pack(spark, sf_dir), spark.read.parquet(f"{sf_dir}/container_sizes.parquet"))


def p7_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How even the attention costs of each kind's containers are."""
    return balance_report(p7_pack(spark, sf_dir))


QUERIES = {"p6_ids": p6_ids, "p7_pack": p7_pack, "p7_fill": p7_fill, "p7_balance": p7_balance}
ORACLES: dict[str, str] = {}
