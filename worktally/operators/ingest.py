"""Datasets of a snapshot turned into the tables of the source: one transform for each dataset, the same for MPs and MLAs.

Each transform gives rows to be upserted on its key; of several records of a key the last counts.
Keys of works are (work_id, member_type); names are resolved to members first (``members.resolve_names``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import hash_of, parse_amount, parse_date
from worktally.functions.text import collapsed, whole_number

#: The fields whose values tell one payment from another.
PAYMENT_IDENTITY = "work_recommendation_dtl_id work_id expenditure_date vendor_name work_status fund_disbursed_amt state_name constituency mp_name".split()


class Unmatched(ValueError):
    """Records that refer to no work."""


def source_rows(rows: DataFrame, dataset: str) -> DataFrame:
    """The rows of a work dataset that have a key of their work (completions: the work's id will do); an error if none has."""
    has = F.col("work_recommendation_dtl_id").isNotNull()
    if dataset.endswith("works_completed"):
        has = has | F.col("work_id").isNotNull()
    kept = rows.filter(has)
    if kept.limit(1).count() == 0:
        raise Unmatched(f"{dataset} has no rows with a key")
    return kept


def _work_id() -> Column:
    return whole_number(F.col("work_recommendation_dtl_id")).cast("bigint")


def _last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return best.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def works(rows: DataFrame, member_type: str) -> DataFrame:
    """(work_id, member_type, mp_name, state_name, constituency, activity_name, work_category, work_description) of recommended or sanctioned works."""
    return _last(rows.select(_work_id().alias("work_id"), F.lit(member_type).alias("member_type"), "loaded_at", *[collapsed(F.col(c)).alias(c) for c in ("mp_name", "state_name", "constituency", "activity_name", "work_category", "work_description")]), ["work_id", "member_type"], ["loaded_at"])


def recommendations(rows: DataFrame, member_type: str) -> DataFrame:
    """(work_id, member_type, recommendation_date, recommended_amount, letter_no) of recommended works."""
    typed = rows.select(_work_id().alias("work_id"), F.lit(member_type).alias("member_type"), "loaded_at", parse_date(F.col("recommendation_date")).alias("recommendation_date"), parse_amount(F.col("recommended_amount")).alias("recommended_amount"), collapsed(F.col("letter_no")).alias("letter_no"))
    return _last(typed, ["work_id", "member_type"], ["loaded_at"])


def sanctions(rows: DataFrame, member_type: str) -> DataFrame:
    """(work_id, member_type, sanction_date, sanction_amount, work_stage) of rows in which any of the three is given, from recommended or sanctioned works."""
    given = F.coalesce(collapsed(F.col("sanction_date")), collapsed(F.col("sanction_amount")), collapsed(F.col("work_stage"))).isNotNull()
    typed = rows.filter(given).select(_work_id().alias("work_id"), F.lit(member_type).alias("member_type"), "loaded_at", parse_date(F.col("sanction_date")).alias("sanction_date"), parse_amount(F.col("sanction_amount")).alias("sanction_amount"), collapsed(F.col("work_stage")).alias("work_stage"))
    return _last(typed, ["work_id", "member_type"], ["loaded_at"])


def completions(rows: DataFrame, known: DataFrame, member_type: str) -> DataFrame:
    """(work_id, member_type, completion_date, completion_amount); an error if a completion belongs to no known work."""
    typed = rows.select(_work_id().alias("work_id"), F.lit(member_type).alias("member_type"), "loaded_at", parse_date(F.col("actual_end_date")).alias("completion_date"), parse_amount(F.col("actual_amount")).alias("completion_amount"))
    lost = [r[0] for r in typed.join(known.select("work_id", "member_type"), ["work_id", "member_type"], "left_anti").select("work_id").distinct().orderBy("work_id").limit(5).collect()]
    if lost:
        raise Unmatched(f"completions without a work: {lost}")
    return _last(typed, ["work_id", "member_type"], ["loaded_at"])


def payments(rows: DataFrame, known: DataFrame, member_type: str) -> DataFrame:
    """(fingerprint, member_type, work_id, day, amount, vendor_name, work_status), keyed by the fingerprint; a payment whose work isn't known keeps a null work_id."""
    parts = [parse_amount(F.col(c)).cast("string") if c == "fund_disbursed_amt" else collapsed(F.col(c)) for c in PAYMENT_IDENTITY]
    typed = rows.select(
        hash_of(*parts).alias("fingerprint"), F.lit(member_type).alias("member_type"), "loaded_at", _work_id().alias("_work"), parse_date(F.col("expenditure_date")).alias("day"),
        parse_amount(F.col("fund_disbursed_amt")).alias("amount"), collapsed(F.col("vendor_name")).alias("vendor_name"), collapsed(F.col("work_status")).alias("work_status"),
    )
    once = _last(typed, ["fingerprint", "member_type"], ["loaded_at"])
    ids = known.select(F.col("work_id").alias("_work"), "member_type", F.lit(True).alias("_there")).distinct()
    joined = once.join(ids, ["_work", "member_type"], "left")
    return joined.select("fingerprint", "member_type", F.when(F.col("_there"), F.col("_work")).alias("work_id"), "day", "amount", "vendor_name", "work_status")


def allocations(resolved: DataFrame) -> DataFrame:
    """(member_type, member_id, allocated_amount, tenure, house_name, tenure_start_date, tenure_end_date) of limits whose name is one member's; the others are passed over."""
    typed = resolved.filter("name_state = 'resolved'").select(
        "member_type", "member_id", "loaded_at", parse_amount(F.col("allocated_amt")).alias("allocated_amount"), collapsed(F.col("tenure")).alias("tenure"), collapsed(F.col("house_name")).alias("house_name"),
        parse_date(F.col("tenure_start_date")).alias("tenure_start_date"), parse_date(F.col("tenure_end_date")).alias("tenure_end_date"),
    )
    return _last(typed, ["member_type", "member_id"], ["loaded_at"])


def calamities(rows: DataFrame, members: DataFrame, member_type: str) -> DataFrame:
    """(member_type, member_id, day, calamity_name, kind, consented_amount); rows with nothing in them are passed over, names are compared as they are typed but for case."""
    fields = ["mp_name", "crt_dt", "calamity_name", "type", "consented_amount"]
    filled = rows.filter(F.coalesce(*[collapsed(F.col(c)) for c in fields]).isNotNull())
    mine = members.filter(F.col("member_type") == member_type).groupBy(F.lower("member_name").alias("_name")).agg(F.min("member_id").alias("member_id"), F.count("*").alias("_n")).filter("_n = 1")
    typed = filled.withColumn("_name", F.lower("mp_name")).join(mine, "_name").select(F.lit(member_type).alias("member_type"), "member_id", "loaded_at", parse_date(F.col("crt_dt")).alias("day"), collapsed(F.col("calamity_name")).alias("calamity_name"), collapsed(F.col("type")).alias("kind"), parse_amount(F.col("consented_amount")).alias("consented_amount"))
    return _last(typed, ["member_type", "member_id", "day", "calamity_name"], ["loaded_at"])


#: The tables each dataset fills.
TRANSFORMS = {"works_recommended": (works, recommendations, sanctions), "works_sanctioned": (works, sanctions), "works_completed": (completions,), "expenditure": (payments,), "allocated_limit": (allocations,), "calamity": (calamities,)}


def transforms_of(dataset: str) -> tuple:
    """The transforms of a dataset, whose MLA twin has the same; an unknown one is an error."""
    name = dataset.removeprefix("mla_")
    if name not in TRANSFORMS:
        raise KeyError(dataset)
    return TRANSFORMS[name]
