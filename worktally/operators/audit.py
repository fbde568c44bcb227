"""Integrity audits as aggregates: duplicates, orphans, ranges, populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(table_name, n_rows, n_keys, n_repeated_keys): how many keys of each table have several rows."""
    out = None
    for name, (df, keys) in tables.items():
        by_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
        one = by_key.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_repeated_keys"))
        out = one if out is None else out.unionByName(one)
    return out


def orphans(child: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(check_name, n_keys): keys of the child that the parent lacks."""
    return child.select(*keys).dropna().distinct().join(parent.select(*keys).distinct(), keys, "left_anti").agg(F.lit(name).alias("check_name"), F.count("*").alias("n_keys"))


def range_checks(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """(check_name, n_rows): rows for which each condition holds, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.expr(condition)).alias(name) for name, condition in checks.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n_rows")) for name in checks])
    return counted.select(F.explode(pairs).alias("c")).select("c.*")


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The values of a key that both tables hold."""
    return left.select(key).intersect(right.select(key))


def verdict(results: DataFrame) -> str:
    """``READY``, or ``NOT READY`` if a check of (check_name, severity, passed) failed with severity CRITICAL or HIGH."""
    failed = results.filter("NOT passed AND severity IN ('CRITICAL', 'HIGH')").limit(1).count()
    return "NOT READY" if failed else "READY"


def stage_status(checks: DataFrame) -> str:
    """``PASS`` if all checks of ``verify_stage`` passed, ``FAIL`` if a CRITICAL one didn't, else ``SUCCESS_WITH_WARNINGS``."""
    failed = {r[0] for r in checks.filter("NOT passed").select("severity").distinct().collect()}
    return "FAIL" if "CRITICAL" in failed else "SUCCESS_WITH_WARNINGS" if failed else "PASS"


def verify_stage(written: DataFrame, expected: DataFrame, keys: list[str], unique: str | None = None, found: DataFrame | None = None, found_from: int = 5) -> DataFrame:
    """(check_name, severity, passed): a written table isn't empty, has as many rows as expected, no repeated keys and no repeated ``unique`` values.

    ``found`` are the anomalies among the entities; of more than ``found_from`` expected entities some must be unusual.
    """
    marks = [F.count("*").alias("n"), F.countDistinct(F.struct(*keys)).alias("k")] + ([F.countDistinct(unique).alias("u")] if unique else [])
    one = written.agg(*marks).join(expected.agg(F.count("*").alias("want")), how="left")
    checks = [("not empty", "CRITICAL", F.col("n") > 0), ("as many rows as expected", "HIGH", F.col("n") == F.col("want")), ("no repeated keys", "CRITICAL", F.col("n") == F.col("k"))]
    if unique:
        checks.append((f"{unique} is unique", "HIGH", F.col("n") == F.col("u")))
    if found is not None:
        one = one.join(found.agg(F.count("*").alias("odd")), how="left")
        checks.append(("anomalies exist", "MEDIUM", (F.col("odd") > 0) | (F.col("want") <= found_from)))
    cells = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), passed.alias("passed")) for name, severity, passed in checks])
    return one.select(F.explode(cells).alias("c")).select("c.*")


def terminal_state(message: str, expected: int, completed: int = 0, failed: int = 0, pending: int | None = None, processing: int | None = None) -> tuple[bool, str]:
    """Whether a run of jobs has ended, and why.

    With counts it has ended if none is pending or processing, whatever failed; without them only if
    as many are completed as were expected. A message that doesn't say so ends nothing.
    """
    if message != "All ingestion jobs completed.":
        return False, "not a completion message"
    if pending is None or processing is None:
        return (True, f"all {expected} jobs completed") if completed >= expected else (False, "legacy response, counts unclear")
    if pending or processing:
        return False, f"not terminal: pending={pending} processing={processing}"
    return True, f"terminal: completed={completed} failed={failed} pending={pending} processing={processing}"


def job_summary(jobs: DataFrame) -> DataFrame:
    """One row of a table of jobs (status): completed, failed, pending, processing, is_terminal, is_success."""
    n = lambda status: F.count_if(F.col("status") == status).alias(status)
    counted = jobs.agg(F.count("*").alias("n_jobs"), *[n(s) for s in ("completed", "failed", "pending", "processing")])
    ended = (F.col("pending") == 0) & (F.col("processing") == 0)
    return counted.withColumns({"is_terminal": ended, "is_success": ended & (F.col("completed") == F.col("n_jobs"))})


def synthetic_ids(tables: dict[str, tuple[DataFrame, str]], least: int = 0, most: int = 100_000) -> DataFrame:
    """(table_name, n_rows): rows whose id is below ``least`` or not below ``most``, which no source gives."""
    out = None
    for name, (df, key) in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count_if((F.col(key) < least) | (F.col(key) >= most)).alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def population(entities: DataFrame, kind: str, name: Column, id_col: str) -> DataFrame:
    """(kind, n_rows, n_ids, n_repeated_names, n_blank_names) of each kind of entities."""
    by_name = entities.withColumn("_name", F.coalesce(name, F.lit(""))).groupBy(kind, "_name").agg(F.count("*").alias("n"), F.countDistinct(id_col).alias("ids"))
    blank = F.col("_name") == ""
    return by_name.groupBy(kind).agg(F.sum("n").alias("n_rows"), F.sum("ids").alias("n_ids"), F.count_if(~blank & (F.col("n") > 1)).alias("n_repeated_names"), F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("n_blank_names"))


def score_summary(ranked: DataFrame, kind: str = "member_type") -> DataFrame:
    """(kind, performance_classification, is_ranked, n_rows, n_null, n_negative, n_over_100, lowest, highest) of scores."""
    s = F.col("performance_score_weighted")
    return ranked.groupBy(kind, "performance_classification", F.col("rank").isNotNull().alias("is_ranked")).agg(F.count("*").alias("n_rows"), F.count_if(s.isNull()).alias("n_null"), F.count_if(s < 0).alias("n_negative"), F.count_if(s > 100).alias("n_over_100"), F.min(s).alias("lowest"), F.max(s).alias("highest"))


def rank_consistency(ranked: DataFrame, kind: str = "member_type") -> DataFrame:
    """(kind, n_ranked, highest_rank, n_beyond, n_not_monotone): ranks beyond the population, and ranked rows whose score is above that of a better rank."""
    own = ranked.filter("rank IS NOT NULL")
    n = F.count("*").over(Window.partitionBy(kind))
    before = F.min("performance_score_weighted").over(Window.partitionBy(kind).orderBy("rank").rangeBetween(Window.unboundedPreceding, -1))
    return own.withColumns({"_n": n, "_before": before}).groupBy(kind).agg(F.count("*").alias("n_ranked"), F.max("rank").alias("highest_rank"), F.count_if(F.col("rank") > F.col("_n")).alias("n_beyond"), F.count_if(F.col("performance_score_weighted") > F.col("_before")).alias("n_not_monotone"))


def level_checks(df: DataFrame, level: str, score: str, levels: list[str], least: float, most: float) -> DataFrame:
    """(level, n_rows, n_invalid_level, n_out_of_range, n_null_score) by level."""
    x = F.col(score)
    return df.groupBy(F.col(level).alias("level")).agg(F.count("*").alias("n_rows"), F.count_if(~F.coalesce(F.col(level).isin(*levels), F.lit(False))).alias("n_invalid_level"), F.count_if((x < least) | (x > most)).alias("n_out_of_range"), F.count_if(x.isNull()).alias("n_null_score"))


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, n_rows, first_time, last_time) of tables with a time of calculation or loading."""
    out = None
    for name, (df, at) in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.min(at).alias("first_time"), F.max(at).alias("last_time"))
        out = one if out is None else out.unionByName(one)
    return out


def catalog_check(names: list[str], expected: list[str], deprecated: tuple[str, ...] = ("backup", "temp", "tmp", "old")) -> dict[str, list[str]]:
    """What is wrong with the names of tables or columns: ``missing``, ``unexpected``, and those that a deprecated word is part of."""
    return {
        "missing": sorted(set(expected) - set(names)),
        "unexpected": sorted(set(names) - set(expected)),
        "deprecated": sorted(n for n in set(names) if any(word in n.lower().split("_") for word in deprecated)),
    }


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n_rows): how often each value of each column occurs, in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(cells.alias("x")).groupBy("x.column_name", "x.value").agg(F.count("*").alias("n_rows"))
