"""Records of one person in three tables (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.llm.names import link_names, spelling_pairs


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    places = t("constituencies").join(t("states"), "state_id", "left").select("constituency_id", "constituency_name", "state_name")

    def members(table: str, short: str) -> DataFrame:
        rows = t(table).join(places, "constituency_id", "left")
        return rows.select(
            F.concat(F.lit(f"{table}:"), F.col(f"{short}_id").cast("string")).alias("key"), F.col(f"{short}_name").alias("name"), F.col("state_name").alias("state"), F.col("constituency_name").alias("place")
        )

    limits = t("allocated_limit").select(
        F.concat(F.lit("allocated_limit:"), F.col("sno").cast("string")).alias("key"), F.col("mp_name").alias("name"), F.col("state_name").alias("state"), F.col("constituency").alias("place")
    )
    return limits.unionByName(members("mps", "mp")).unionByName(members("mlas", "mla"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(left_key, right_key): records of one person under names written differently."""
    return spelling_pairs(link_names(_records(spark, sf_dir)))


def p5_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, person, n_records, n_spellings): each record's person, and how many records and spellings the person has."""
    linked = link_names(_records(spark, sf_dir))
    sizes = linked.groupBy("person").agg(F.countDistinct("key").alias("n_records"), F.countDistinct("name").alias("n_spellings"))
    return linked.select("key", "person").distinct().join(sizes, "person").select("key", "person", "n_records", "n_spellings")


QUERIES = {"p5_found": p5_found, "p5_persons": p5_persons}
ORACLES: dict[str, str] = {}
