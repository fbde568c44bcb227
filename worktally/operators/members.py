"""The canonical members: their master, names resolved to them, members without works, and allocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import allocation_name, member_name, parse_amount, parse_date, round_to
from worktally.functions.text import strip
from worktally.operators.works import latest_rows

#: Fixed value: the house whose limits are those of MLAs.
ASSEMBLY = "state assembly"


class UnresolvedNames(ValueError):
    """Names that no member of the master bears, or that several bear."""


def master(mps: DataFrame, mlas: DataFrame) -> DataFrame:
    """(member_type, member_id, member_name, house_name, tenure, constituency_id): the latest row of each member of both tables."""

    def one(df: DataFrame, kind: str, short: str) -> DataFrame:
        renamed = df.select(F.col(f"{short}_id").alias("member_id"), F.col(f"{short}_name").alias("member_name"), "house_name", "tenure", "constituency_id", "loaded_at")
        return latest_rows(renamed, ["member_id"], ["loaded_at"]).select(F.lit(kind).alias("member_type"), "member_id", "member_name", "house_name", "tenure", "constituency_id")

    return one(mps, "MP", "mp").unionByName(one(mlas, "MLA", "mla"))


def master_population(limits: DataFrame) -> DataFrame:
    """(member_type, member_name, state_name, constituency, house_name, tenure, tenure_start_date, tenure_end_date, allocated_amount, sno) of each limit with a name."""
    kind = F.when(F.lower(strip(F.col("house_name"))) == ASSEMBLY, "MLA").otherwise("MP")
    return limits.filter(strip(F.col("mp_name")) != "").select(
        kind.alias("member_type"),
        F.col("mp_name").alias("member_name"),
        "state_name",
        "constituency",
        "house_name",
        "tenure",
        parse_date(F.col("tenure_start_date")).alias("tenure_start_date"),
        parse_date(F.col("tenure_end_date")).alias("tenure_end_date"),
        parse_amount(F.col("allocated_amt")).alias("allocated_amount"),
        "sno",
    )


def population_counts(population: DataFrame) -> DataFrame:
    """(member_type, n_records, n_names): how many limits and different names each population has."""
    return population.groupBy("member_type").agg(F.count("*").alias("n_records"), F.countDistinct(member_name(F.col("member_name"))).alias("n_names"))


def first_by_name(population: DataFrame) -> DataFrame:
    """(normalized_name, the columns of ``master_population``): the first record of each name, by sno (ties: the smallest row)."""
    rest = ["member_type", "member_name", "state_name", "constituency", "house_name", "tenure", "tenure_start_date", "tenure_end_date", "allocated_amount"]
    keyed = population.withColumn("normalized_name", member_name(F.col("member_name"))).filter("normalized_name <> ''")
    return keyed.groupBy("normalized_name").agg(F.min(F.struct("sno", *rest)).alias("r")).select("normalized_name", *[F.col(f"r.{c}").alias(c) for c in rest])


def resolve_names(rows: DataFrame, members: DataFrame, name: str, kind: Column) -> DataFrame:
    """``rows`` with member_type, member_id and name_state: ``resolved``, ``missing`` or ``ambiguous`` (several members bear the name); null and blank names are missing."""
    by_name = members.groupBy("member_type", member_name(F.col("member_name")).alias("_name")).agg(F.count("*").alias("_n"), F.min("member_id").alias("_id"))
    joined = rows.withColumns({"member_type": kind, "_name": member_name(F.col(name))}).join(by_name.filter("_name <> ''"), ["member_type", "_name"], "left")
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("resolved")
    return joined.withColumns({"name_state": state, "member_id": F.when(F.col("_n") == 1, F.col("_id"))}).drop("_name", "_n", "_id")


def require_resolved(resolved: DataFrame, name: str) -> DataFrame:
    """The rows if all names are resolved; else an error that tells some of the names."""
    bad = [r[0] for r in resolved.filter("name_state <> 'resolved'").select(name).distinct().orderBy(name).limit(5).collect()]
    if bad:
        raise UnresolvedNames(f"names without one member each: {bad}")
    return resolved


def zero_work_members(members: DataFrame, works: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """(member_type, member_id, normalized_name, state_name, house_name, tenure, allocated_amount): members of the master without any work.

    A member whose name a member with works of the same type bears is none; the last four columns
    are those of the first limit of that name.
    """
    active = works.select("member_type", "member_id").distinct()
    named = members.select("member_type", "member_id", member_name(F.col("member_name")).alias("normalized_name"))
    taken = named.join(active, ["member_type", "member_id"], "left_semi").filter("normalized_name <> ''").select("member_type", "normalized_name").distinct()
    idle = named.join(active, ["member_type", "member_id"], "left_anti").join(taken, ["member_type", "normalized_name"], "left_anti")
    context = ["state_name", "house_name", "tenure", "allocated_amount"]
    if population is None:
        return idle.select("member_type", "member_id", "normalized_name")
    return idle.join(first_by_name(population).select("normalized_name", *context), "normalized_name", "left").select("member_type", "member_id", "normalized_name", *context)


def prefilled(members: DataFrame, known: DataFrame, columns: tuple[str, ...] = ("tenure", "house_name")) -> DataFrame:
    """``members`` with missing ``columns`` taken from ``known`` where one row alone has the member's type and name; ambiguous names stay as they are."""
    offers = known.groupBy("member_type", allocation_name(F.col("member_name")).alias("_k")).agg(F.count("*").alias("_n"), *[F.min(c).alias(f"_{c}") for c in columns]).filter("_n = 1 AND _k <> ''")
    joined = members.withColumn("_k", allocation_name(F.col("member_name"))).join(offers, ["member_type", "_k"], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}).select(*members.columns)


def match_allocations(members: DataFrame, limits: DataFrame) -> DataFrame:
    """(member_type, member_id, allocated_amount, allocated_confidence): limits by name, tenure and house.

    One candidate is HIGH, several MEDIUM with the largest amount, none LOW with 0.
    """
    house = lambda c: F.lower(strip(F.coalesce(F.col(c), F.lit(""))))
    offers = limits.select(allocation_name(F.col("mp_name")).alias("k"), F.col("tenure"), house("house_name").alias("h"), parse_amount(F.col("allocated_amt")).alias("amount")).filter("k <> '' AND amount IS NOT NULL").distinct()
    best = offers.groupBy("k", "tenure", "h").agg(F.count("*").alias("n"), F.max("amount").alias("amount"))
    joined = members.withColumns({"k": allocation_name(F.col("member_name")), "h": house("house_name")}).join(best, ["k", "tenure", "h"], "left")
    confidence = F.when(F.col("n") == 1, "HIGH").when(F.col("n") > 1, "MEDIUM").otherwise("LOW")
    return joined.select("member_type", "member_id", F.coalesce("amount", F.lit(0)).cast("double").alias("allocated_amount"), confidence.alias("allocated_confidence"))


def allocations_by_state(matched: DataFrame, works: DataFrame) -> DataFrame:
    """(state_id, n_members, allocated_amount): each member's limit once in every state the member has works in."""
    pairs = works.filter("state_id IS NOT NULL").select("member_type", "member_id", "state_id").distinct()
    joined = pairs.join(matched, ["member_type", "member_id"])
    return joined.groupBy("state_id").agg(F.count("*").alias("n_members"), F.sum(F.col("allocated_amount").cast("decimal(18,2)")).cast("double").alias("allocated_amount"))


def prior_strength(members: DataFrame, rate: str, least: int = 5) -> DataFrame:
    """(member_type, n, mean, variance, k): the weight k that a rate's prior has by the method of moments; null without variance."""
    p = F.col(rate).cast("double") / 100
    grouped = members.filter(F.col("total_works") >= least).groupBy("member_type").agg(F.count(rate).alias("n"), F.avg(p).alias("m"), F.var_pop(p).alias("v"))
    k = F.when(F.col("v") > 0, F.col("m") * (1 - F.col("m")) / F.col("v") - 1)
    return grouped.select("member_type", "n", round_to(F.col("m"), 4).alias("mean"), round_to(F.col("v"), 4).alias("variance"), round_to(k).alias("k"))
