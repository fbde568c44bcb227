"""Deltas between two versions of a table, and what they affect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktally.functions.text import whole_number

#: What a calculation needs to be taken again: the changed records, their entities, or all.
CALCULATIONS = {
    "LOCAL": "work_analysis work_risk_flags work_benchmarks".split(),
    "ENTITY": "member_metrics state_metrics member_performance state_performance member_risk state_risk anomaly_score evidence ai_analysis".split(),
    "GLOBAL": "national_totals national_ranking peer_ranking percentile national_statistics overall_metrics trends category_metrics fy_metrics clustering isolation_forest intelligence_assembly".split(),
}
#: Global calculations that are taken again only if works changed; all other global ones always are.
ONLY_WITH_WORKS = "trends category_metrics fy_metrics clustering isolation_forest".split()
#: Added to the ids of MLA works, which are numbered on their own.
MLA_OFFSET = 1_000_000
#: Datasets whose records belong to no work.
WITHOUT_WORKS = "allocated_limit mla_allocated_limit calamity mla_calamity".split()


class Conflict(ValueError):
    """One identity given with different contents."""



def dedupe_by_hash(rows: DataFrame, keys: list[str], content: Column) -> DataFrame:
    """(keys, n_rows, n_contents, state): keys given once (``single``), again with the same content (``repeat``) or with another (``conflict``)."""
    grouped = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n_rows"), F.countDistinct(content).alias("n_contents"))
    return grouped.withColumn("state", F.when(F.col("n_contents") > 1, "conflict").when(F.col("n_rows") > 1, "repeat").otherwise("single"))


def require_no_conflict(deduped: DataFrame, keys: list[str]) -> DataFrame:
    """The result of ``dedupe_by_hash`` if no key has different contents; else an error that names some of the keys."""
    bad = [tuple(r) for r in deduped.filter("state = 'conflict'").select(*keys).orderBy(*keys).limit(5).collect()]
    if bad:
        raise Conflict(f"given with different contents: {bad}")
    return deduped


def without_identity(rows: DataFrame, identity: list[str], content: list[str], blank_allowed: bool = False) -> DataFrame:
    """(reason, n_rows): rows of which a part of the identity is missing; ``blank`` ones, with nothing at all, are told apart and may be allowed."""
    empty = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    missing, blank = F.lit(False), F.lit(True)
    for c in identity:
        missing = missing | empty(c)
    for c in [*identity, *content]:
        blank = blank & empty(c)
    bad = rows.filter(missing).select(F.when(blank, "blank").otherwise("incomplete").alias("reason"))
    return (bad.filter("reason <> 'blank'") if blank_allowed else bad).groupBy("reason").agg(F.count("*").alias("n_rows"))


def payment_conflicts(payments: DataFrame, fingerprint: Column, unstable: list[str]) -> DataFrame:
    """(fingerprint, n_rows, n_contents, state): payments of one fingerprint, ``repeat`` if they differ in the ``unstable`` columns alone, ``conflict`` otherwise."""
    rest = [c for c in sorted(payments.columns) if c not in unstable]
    content = F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)
    return dedupe_by_hash(payments.withColumn("fingerprint", fingerprint), ["fingerprint"], content)


def diff_counts(diff: DataFrame) -> DataFrame:
    """(op, n_records) of a diff."""
    return diff.groupBy("op").agg(F.count("*").alias("n_records"))


def change_types(delta: DataFrame) -> DataFrame:
    """(table_name, change_type, n_records) of a delta (table_name, op): append, update or mixed."""
    has = lambda op: F.coalesce(F.bool_or(F.col("op") == op), F.lit(False))
    kind = F.when(has("append") & has("update"), "mixed").when(has("append"), "append").otherwise("update")
    return delta.groupBy("table_name").agg(kind.alias("change_type"), F.count("*").alias("n_records"))


def works_of_delta(delta: DataFrame, key: str = "WORK_RECOMMENDATION_DTL_ID") -> DataFrame:
    """(work_id): the works a delta (table_name, and the key as typed) belongs to; MLA works have ids of their own, other tables none."""
    number = whole_number(F.col(key)).cast("bigint")
    owned = delta.filter(~F.col("table_name").isin(*WITHOUT_WORKS))
    return owned.select(F.when(F.col("table_name").startswith("mla_"), number + MLA_OFFSET).otherwise(number).alias("work_id")).dropna().distinct()


def must_run(calculation: str, works_changed: bool) -> bool:
    """Whether a global calculation is taken again after a change; unknown names and local ones aren't."""
    return calculation in CALCULATIONS["GLOBAL"] and (works_changed or calculation not in ONLY_WITH_WORKS)


def table_diff(old: DataFrame, new: DataFrame, keys: list[str], content: str) -> DataFrame:
    """(keys, op): append, update, unchanged or removed. Keys must be unique on each side; removal is reported, never applied."""
    a = old.select(*keys, F.col(content).alias("a"), F.lit(True).alias("in_old"))
    b = new.select(*keys, F.col(content).alias("b"), F.lit(True).alias("in_new"))
    op = F.when(F.col("in_old").isNull(), "append").when(F.col("in_new").isNull(), "removed").when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("update")
    return a.join(b, keys, "full_outer").select(*keys, op.alias("op"))


def is_unchanged(diff: DataFrame) -> bool:
    """Whether a delta holds no append and no update, so that a run can end early."""
    return diff.filter(F.col("op").isin("append", "update")).limit(1).count() == 0


def affected_entities(works: DataFrame, changed: DataFrame) -> DataFrame:
    """(entity_type, entity_id): the works, members and states that a set of changed work ids touches."""
    hit = works.join(changed.select("work_id").distinct(), "work_id", "left_semi")
    kinds = F.array(
        F.struct(F.lit("WORK").alias("entity_type"), F.col("work_id").cast("string").alias("entity_id")),
        F.struct(F.col("member_type").alias("entity_type"), F.col("member_id").cast("string").alias("entity_id")),
        F.struct(F.lit("STATE").alias("entity_type"), F.col("state_id").cast("string").alias("entity_id")),
    )
    return hit.select(F.explode(kinds).alias("e")).select("e.*").filter("entity_type IS NOT NULL AND entity_id IS NOT NULL").distinct()


def affected_peers(works: DataFrame, changed: DataFrame) -> DataFrame:
    """(work_id): all works that share an activity with a changed one, in a state or nationally."""
    hit = works.join(changed.select("work_id").distinct(), "work_id", "left_semi").select("normalized_activity").distinct()
    return works.join(hit, "normalized_activity", "left_semi").select("work_id")


def time_sensitive(works: DataFrame) -> DataFrame:
    """(work_id): works whose measures change with the day: not completed, or with payments."""
    return works.filter("status IN ('In Progress', 'Recommended') OR expenditure_amount IS NOT NULL").select("work_id")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The target with the batch's rows put in; of repeated keys in a batch the last by ``order`` wins."""
    rest = [c for c in target.columns if c not in keys]
    last = batch.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
    kept = target.join(last.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(last.select(*target.columns))


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The target without the keys of ``gone``."""
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


def carry_over(new: DataFrame, old: DataFrame, key: str, fingerprint: str, carried: list[str]) -> DataFrame:
    """New rows with the old row's ``carried`` columns where the fingerprint is the same; ``carry_state`` is preserved, stale or new."""
    before = old.select(key, F.col(fingerprint).alias("_f"), *[F.col(c).alias(f"_{c}") for c in carried])
    joined = new.join(before, key, "left")
    state = F.when(F.col("_f").isNull(), "new").when(F.col("_f") == F.col(fingerprint), "preserved").otherwise("stale")
    joined = joined.withColumn("carry_state", state)
    values = {c: F.when(F.col("carry_state") == "preserved", F.col(f"_{c}")) for c in carried}
    return joined.withColumns(values).drop("_f", *[f"_{c}" for c in carried])


def resolve_or_insert(dimension: DataFrame, names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """The dimension with the names it lacks, numbered on from its largest id in the order of the names; null names are left out.

    Names are numbered within ranges, and the ranges by their sizes, so no task holds all of them.
    """
    fresh = names.select(name_col).dropna().distinct().join(dimension.select(name_col), name_col, "left_anti")
    top = dimension.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
    # Names are spread by their first letters; a prefix's numbers begin where the sizes of the smaller prefixes end.
    keyed = fresh.withColumn("_range", F.substring(name_col, 1, 2))
    sizes = keyed.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).select("_range", "_start")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(name_col))
    added = keyed.withColumn("_place", place).join(starts, "_range").join(F.broadcast(top), how="left").select((F.col("top") + F.col("_start") + F.col("_place")).cast("bigint").alias(id_col), name_col)
    return dimension.select(F.col(id_col).cast("bigint").alias(id_col), name_col).unionByName(added)
