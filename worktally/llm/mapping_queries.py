"""Typed activities and categories mapped to canonical values (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.llm.canonical import map_values

#: The typed fields and the kind of canonical value each must come out with.
FIELDS = {"activity_name": "activity", "normalized_activity": "activity", "work_category": "category"}


def _cases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    works = spark.read.parquet(f"{sf_dir}/work_analysis.parquet")
    reference = spark.read.parquet(f"{sf_dir}/canonical_values.parquet").select(F.col("value_kind").alias("kind"), "ref_id", F.col("canonical_name").alias("name"))
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.lit(k).alias("kind"), F.col(f).alias("value")) for f, k in FIELDS.items()])
    typed = works.select("work_id", F.explode(fields).alias("c")).select("work_id", "c.*")
    typed = typed.filter(F.regexp_replace("value", r"[\s\p{Z}]+", "") != "")
    exact = reference.select("kind", F.col("name").alias("value")).distinct()
    return typed.join(exact, ["kind", "value"], "left_anti"), reference


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(work_id, field_name, ref_id) of each typed value that is no canonical name; 0: it means none."""
    cases, reference = _cases(spark, sf_dir)
    mapped = map_values(cases, reference)
    # A work that was calculated again has the same values: one row each.
    rows = cases.join(mapped, ["kind", "value"]).groupBy("work_id", "field_name").agg(F.max("ref_id").alias("ref_id"))
    return rows.select("work_id", "field_name", F.col("ref_id").cast("int").alias("ref_id"))


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, value, n_works): the values that mean no canonical entry and the works that have each; a work calculated again counts once, one without an id not at all."""
    cases, reference = _cases(spark, sf_dir)
    none = map_values(cases, reference).filter("ref_id = 0").select("kind", "value")
    once = cases.join(none, ["kind", "value"]).select("field_name", "value", "work_id").distinct()
    return once.groupBy("field_name", "value").agg(F.count("work_id").alias("n_works"))


QUERIES = {"p1_found": p1_found, "p1_unmatched": p1_unmatched}
ORACLES: dict[str, str] = {}
