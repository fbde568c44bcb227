"""Languages of the documents and of their stretches (problem 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.llm.language import segment_languages


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with words: each stretch's language, confidence and place in the text."""
    return segment_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, segment_no, lang) of documents that mix languages or whose label is missing or wrong."""
    found = p8_segments(spark, sf_dir).filter((F.col("n_segments") > 1) | F.col("label").isNull() | (F.col("label") != F.col("lang")))
    return found.select("doc_id", "segment_no", "lang")


QUERIES = {"p8_found": p8_found, "p8_segments": p8_segments}
ORACLES: dict[str, str] = {}
