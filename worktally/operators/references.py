"""References to records that do not exist, were withdrawn or arrived later.

Method: parents are reduced to one row for each key with the validity of the key (earliest load,
whether any row is still there); references and parents are co-partitioned and sorted on the key
and merged linearly (a sort-merge join, which Spark keeps streaming over both sides). A key that
holds a large part of the references is reduced to one row for each referring row before the
exchange, and adaptive execution splits its partition.

Defined cases: null and blank keys are no case; a key that denotes no whole number has no target;
deliveries of one row count once, at their earliest load; rows without a row id count once for
each key they give; a null load time gives a null month and never ``late``; empty tables give no
rows (empty parents make every reference ``missing``). Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.text import collapsed, whole_number


@dataclass(frozen=True)
class Referring:
    """A table whose column ``key`` refers to the parents of the kind that ``kind`` gives (null: none)."""

    name: str
    rows: DataFrame
    row_id: str
    key: str
    loaded_at: str
    kind: Column


@dataclass(frozen=True)
class Parent:
    """A table of targets; ``removed_at`` is null while a row is there."""

    kind: str
    rows: DataFrame
    key: str
    loaded_at: str = "loaded_at"
    removed_at: str = "removed_at"


def _references(one: Referring) -> DataFrame:
    text = collapsed(F.col(one.key))
    return (
        one.rows.select(
            F.lit(one.name).alias("table_name"),
            F.col(one.row_id).cast("bigint").alias("row_id"),
            one.kind.alias("kind"),
            text.alias("key_text"),
            F.col(one.loaded_at).cast("timestamp").alias("loaded_at"),
        )
        .filter("key_text IS NOT NULL")
        .withColumn("key", whole_number(F.col("key_text")))
        .groupBy("table_name", "row_id", "kind", "key")
        .agg(F.min("loaded_at").alias("first_load"))
    )


def _parents(one: Parent) -> DataFrame:
    return one.rows.select(
        F.lit(one.kind).alias("kind"),
        whole_number(F.col(one.key)).alias("key"),
        F.col(one.loaded_at).cast("timestamp").alias("loaded_at"),
        F.col(one.removed_at).isNull().alias("there"),
    )


def reference_status(referring: list[Referring], parents: list[Parent]) -> DataFrame:
    """(table_name, row_id, load_month, reason_code) of every reference; reason_code is null for one with a target in time."""
    refs = _union([_references(r) for r in referring])
    targets = (
        _union([_parents(p) for p in parents])
        .filter("key IS NOT NULL")
        .groupBy("kind", "key")
        .agg(F.min("loaded_at").alias("valid_from"), F.max("there").alias("there"))
    )
    reason = (
        F.when(F.col("there").isNull(), "missing")
        .when(~F.col("there"), "deleted")
        .when(F.col("valid_from") > F.col("first_load"), "late")
    )
    return refs.join(targets.hint("merge"), ["kind", "key"], "left").select(
        "table_name", "row_id", F.date_format("first_load", "yyyy-MM").alias("load_month"), reason.alias("reason_code")
    )


def orphan_references(referring: list[Referring], parents: list[Parent]) -> DataFrame:
    """The references that are ``missing``, ``deleted`` or ``late``."""
    return reference_status(referring, parents).filter("reason_code IS NOT NULL")


def orphan_report(referring: list[Referring], parents: list[Parent]) -> DataFrame:
    """(table_name, load_month, reason_code, n_references): the orphans counted per table and month."""
    return orphan_references(referring, parents).groupBy("table_name", "load_month", "reason_code").agg(F.count("*").alias("n_references"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def member_kind(member_type: Column) -> Column:
    """``mp`` or ``mla`` by a member type typed in any case and with blanks; else null."""
    bare = F.upper(F.regexp_replace(member_type, r"[\s\p{Z}]+", ""))
    return F.when(bare == "MP", "mp").when(bare == "MLA", "mla")
