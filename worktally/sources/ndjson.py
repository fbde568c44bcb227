"""Snapshots: folders of newline-delimited JSON parts with manifests and a completion mark.

Layout: ``<root>/<timestamp>/<dataset>/part*`` with ``manifest.json`` beside the parts and
``_COMPLETE.json`` in the snapshot's folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.functions.jsonline import listed_object
from worktally.sources import files

ROWS_A_PART = 2000
SUMMARY_FIELD = "Total_Amt"
_KINDS = ("allocated_limit", "works_recommended", "works_sanctioned", "works_completed", "expenditure", "calamity")
#: The twelve datasets of a snapshot.
DATASETS = (*_KINDS, *(f"mla_{k}" for k in _KINDS))


class BrokenSnapshot(ValueError):
    """A snapshot that must not be used."""


def _lines(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    return spark.read.text(f"{folder}/{dataset}/part[-_]*").select(F.col("value").alias("line")).filter(F.trim("line") != "")


def scan_ndjson(spark: SparkSession, folder: str, dataset: str, fields: list[str], strict: bool = False) -> DataFrame:
    """The records of a dataset, every field as text; summary rows are dropped.

    Lines that aren't one JSON object are skipped, or with ``strict`` make the scan fail. Blank
    lines count as nothing; a dataset that isn't there has no records.
    """
    empty = spark.createDataFrame([], ",".join(f"`{f}` string" for f in fields))
    if not [n for n in files.names(spark, f"{folder}/{dataset}") if n.startswith("part")]:
        return empty
    parsed = _lines(spark, folder, dataset).select(F.explode(F.array(listed_object(F.col("line"), [*fields, SUMMARY_FIELD]))).alias("listed"))
    good = F.coalesce((F.size("listed") == 1) & F.col("listed")[0].isNotNull(), F.lit(False))
    if strict and parsed.filter(~good).limit(1).count():
        raise BrokenSnapshot(f"{dataset} has lines that are no JSON objects")
    return parsed.filter(good).select(F.col("listed")[0].alias("o")).filter(F.col(f"o.{SUMMARY_FIELD}").isNull()).select(*[F.col(f"o.{f}").alias(f) for f in fields])


def write_ndjson(df: DataFrame, folder: str, dataset: str, rows_a_part: int = ROWS_A_PART) -> dict:
    """Write a dataset in parts of at most ``rows_a_part`` rows, and its manifest; gives the manifest."""
    spark = df.sparkSession
    path = f"{folder}/{dataset}"
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_part).option("ignoreNullFields", "false").json(path)
    n_parts = len([n for n in files.names(spark, path) if n.startswith("part")])
    manifest = {"dataset": dataset, "records": _lines(spark, folder, dataset).count() if n_parts else 0, "chunks": n_parts, "chunk_size": rows_a_part}
    files.write_small(spark, f"{path}/manifest.json", json.dumps(manifest))
    return manifest


def complete_snapshot(spark: SparkSession, folder: str, manifests: list[dict]) -> None:
    """Mark a snapshot as complete, with the counts of its datasets."""
    counts = {m["dataset"]: {"records": m["records"], "chunks": m["chunks"]} for m in manifests}
    files.write_small(spark, f"{folder}/_COMPLETE.json", json.dumps({"status": "complete", "datasets": counts}))


def validate_snapshot(spark: SparkSession, folder: str, datasets: tuple[str, ...] = DATASETS) -> dict[str, str]:
    """What is wrong with a snapshot, by dataset; empty if nothing is."""
    if not files.exists(spark, f"{folder}/_COMPLETE.json"):
        return {"*": "no completion mark"}
    marked = json.loads(files.read_small(spark, f"{folder}/_COMPLETE.json"))["datasets"]
    wrong = {}
    for d in datasets:
        if d not in marked:
            wrong[d] = "not in the completion mark"
            continue
        parts = [n for n in files.names(spark, f"{folder}/{d}") if n.startswith("part")]
        found = _lines(spark, folder, d).count() if parts else 0
        if (found, len(parts)) != (marked[d]["records"], marked[d]["chunks"]):
            wrong[d] = f"{found} records in {len(parts)} parts, marked {marked[d]['records']} in {marked[d]['chunks']}"
    return wrong


def previous_snapshot(spark: SparkSession, root: str, current: str) -> str | None:
    """The newest complete snapshot before ``current``, by name."""
    done = [n for n in files.names(spark, root) if n < current and files.exists(spark, f"{root}/{n}/_COMPLETE.json")]
    return done[-1] if done else None


def load_all(spark: SparkSession, folder: str, fields: dict[str, list[str]], strict: bool = False) -> dict[str, DataFrame]:
    """The records of every dataset that ``fields`` lists, by name; one that isn't there has no records."""
    return {name: scan_ndjson(spark, folder, name, columns, strict) for name, columns in fields.items()}


def scan_delta(spark: SparkSession, folder: str, fields: list[str]) -> DataFrame:
    """(table_name, op, fields): the records of a delta, which lie in ``<folder>/<dataset>/append_part*`` and ``update_part*``."""
    empty = spark.createDataFrame([], ",".join(f"`{f}` string" for f in ["table_name", "op", *fields]))
    parts = [f"{folder}/{d}/{n}" for d in files.names(spark, folder) for n in files.names(spark, f"{folder}/{d}") if n.startswith(("append_part", "update_part"))]
    if not parts:
        return empty
    place = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([a-z]+)_part[^/]*$", 1)
    op = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([a-z]+)_part[^/]*$", 2)
    lines = spark.read.text(parts).select(place.alias("table_name"), op.alias("op"), F.col("value").alias("line")).filter(F.trim("line") != "")
    parsed = lines.select("table_name", "op", F.explode(F.array(listed_object(F.col("line"), fields))).alias("listed")).filter(F.coalesce((F.size("listed") == 1) & F.col("listed")[0].isNotNull(), F.lit(False)))
    return parsed.select("table_name", "op", *[F.col("listed")[0][f].alias(f) for f in fields])


def promote(spark: SparkSession, root: str, snapshot: str) -> tuple[str | None, str]:
    """Make a complete snapshot the current one and the one that was current the previous; gives both names.

    The names are in ``_POINTERS.json`` beside the snapshots, which is replaced as a whole, so a run
    that fails before leaves them as they were.
    """
    if not files.exists(spark, f"{root}/{snapshot}/_COMPLETE.json"):
        raise BrokenSnapshot(f"{snapshot} isn't complete")
    before = pointers(spark, root)
    previous = before["previous"] if before["current"] == snapshot else before["current"]
    files.write_small(spark, f"{root}/_POINTERS.json", json.dumps({"previous": previous, "current": snapshot}))
    return previous, snapshot


def pointers(spark: SparkSession, root: str) -> dict[str, str | None]:
    """The names of the previous and the current snapshot."""
    path = f"{root}/_POINTERS.json"
    return json.loads(files.read_small(spark, path)) if files.exists(spark, path) else {"previous": None, "current": None}


def remove_failed_snapshot(spark: SparkSession, root: str, name: str) -> bool:
    """Remove a snapshot that wasn't completed; a complete one and those the pointers name stay. Tells whether it was removed."""
    held = set(pointers(spark, root).values())
    if name in held or not files.exists(spark, f"{root}/{name}") or files.exists(spark, f"{root}/{name}/_COMPLETE.json"):
        return False
    files.remove(spark, f"{root}/{name}")
    return True


def remove_old_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all complete snapshots but the newest ``keep``; gives the names removed."""
    done = [n for n in files.names(spark, root) if files.exists(spark, f"{root}/{n}/_COMPLETE.json")]
    held = set(pointers(spark, root).values())
    gone = [n for n in done[: max(0, len(done) - keep)] if n not in held]
    for n in gone:
        files.remove(spark, f"{root}/{n}")
    return gone


def changed_datasets(spark: SparkSession, old: str, new: str) -> list[str]:
    """The datasets of which a part differs between two snapshots in size or SHA-256; those the new one lacks are passed over."""

    def parts(folder: str) -> DataFrame:
        read = spark.read.format("binaryFile").load(f"{folder}/*/part[-_]*")
        place = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
        return read.select(place.alias("dataset"), "length", F.sha2("content", 256).alias("hash")).groupBy("dataset").agg(F.sort_array(F.collect_list(F.struct("hash", "length"))).alias("parts"))

    a = parts(old).withColumnRenamed("parts", "before")
    b = parts(new)
    return sorted(r[0] for r in b.join(a, "dataset", "left").filter(~F.col("parts").eqNullSafe(F.col("before"))).select("dataset").collect())
