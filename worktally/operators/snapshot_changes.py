"""Typed changes between consecutive full snapshots.

Method: every line is reduced to (dataset, identity, snapshot, content columns); the rows are
range-partitioned and sorted by key, and one streaming pass over each range merges the
neighbouring snapshots of a key, comparing the columns. The pass is a lag/lead window, for which
Spark keeps the range partitioning and the sort order: no second exchange, and only two
neighbouring rows are held at a time.

Defined cases: null or blank raw_json, broken JSON, values that are no object and lines without a
complete identity are no records. Repeated keys in a snapshot: the line with the highest line_no
counts; of lines with one number, the one with the larger content. Empty input gives no rows.
Columns besides snapshot_no, dataset, line_no and raw_json are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktally.functions.jsonline import listed_object
from worktally.functions.text import collapsed, day, number_text
from worktally.runtime import broadcast_checked, shuffle_width


@dataclass(frozen=True)
class DatasetSpec:
    """Identity and content fields of one dataset; fields in neither list are ignored."""

    identity: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()

    @property
    def content(self) -> tuple[str, ...]:
        return self.numbers + self.dates + self.texts


@dataclass(frozen=True)
class SnapshotSpec:
    """The datasets of a snapshot."""

    datasets: dict[str, DatasetSpec] = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        return sorted({f for s in self.datasets.values() for f in s.identity + s.content})


#: Identity and content fields of the datasets.
PUBLIC_WORKS = SnapshotSpec(
    {
        "works_recommended": DatasetSpec(
            ("WORK_RECOMMENDATION_DTL_ID",),
            ("RECOMMENDED_AMOUNT", "SANCTION_AMOUNT", "FLAG", "ATTACH_ID"),
            ("RECOMMENDATION_DATE", "SANCTION_DATE"),
            ("ACTIVITY_NAME", "WORK_CATEGORY", "WORK_DESCRIPTION", "WORK_STAGE", "LETTER_NO", "FILE_STATUS"),
        ),
        "works_sanctioned": DatasetSpec(
            ("WORK_RECOMMENDATION_DTL_ID",),
            ("SANCTION_AMOUNT", "ATTACH_ID"),
            ("RECOMMENDATION_DATE", "SANCTION_DATE"),
            ("ACTIVITY_NAME", "WORK_CATEGORY", "WORK_DESCRIPTION", "WORK_STAGE", "FILE_STATUS"),
        ),
        "works_completed": DatasetSpec(("WORK_RECOMMENDATION_DTL_ID",), ("ACTUAL_AMOUNT",), ("ACTUAL_END_DATE",)),
        "allocated_limit": DatasetSpec(
            ("MP_NAME", "STATE_NAME", "CONSTITUENCY", "TENURE"),
            ("ALLOCATED_AMT", "HOUSE_OF_PARLIAMENT"),
            ("TENURE_START_DATE", "TENURE_END_DATE"),
        ),
    }
)


def _identity_part(x: Column) -> Column:
    text = collapsed(x)
    decimal = text.rlike(r"^[+-]?\d+\.0*$") | text.rlike(r"^[+-]?\d+(\.\d+)?[eE]\+?\d{1,2}$")
    return F.when(decimal, F.coalesce(number_text(text), text)).otherwise(text)


def _by_value(numbers: Column, dates: Column, texts: Column) -> Column:
    """One array of texts: numbers by value, dates by day, text with white space collapsed."""
    return F.concat(
        F.transform(numbers, lambda x: F.coalesce(number_text(x), collapsed(x))),
        F.transform(dates, lambda x: F.coalesce(day(x).cast("string"), collapsed(x))),
        F.transform(texts, collapsed),
    )


def content_hash(spec: DatasetSpec) -> Column:
    """SHA-256 of all content fields, by value, of a table that has them as columns of the same names in lower case."""
    columns = lambda fields: F.array(*[F.col(f.lower()).cast("string") for f in fields]).cast("array<string>")
    return F.sha2(F.to_json(_by_value(columns(spec.numbers), columns(spec.dates), columns(spec.texts))), 256)


def snapshot_lines(records: DataFrame, spec: SnapshotSpec = PUBLIC_WORKS) -> DataFrame:
    """(dataset, snapshot_no, line_no, identity, content) of each line that is a record.

    content is an array of texts in the order of the dataset's ``DatasetSpec.content``: numbers by
    value, dates by day, text with white space collapsed; absent, null and blank are null.
    """
    # The generator is a barrier: each line is parsed once, whatever reads its fields.
    rows = (
        records.select("dataset", "snapshot_no", "line_no", F.explode(F.array(listed_object(F.col("raw_json"), spec.fields))).alias("listed"))
        .filter(F.size("listed") == 1)
        .withColumn("o", F.col("listed")[0])
        .filter("o IS NOT NULL")
    )

    def raws(fields) -> Column:
        out = None
        for name, one in spec.datasets.items():
            is_it, values = F.col("dataset") == name, F.array(*[F.col("o")[f] for f in fields(one)]).cast("array<string>")
            out = F.when(is_it, values) if out is None else out.when(is_it, values)
        return out

    taken = rows.select(
        "dataset",
        "snapshot_no",
        "line_no",
        raws(lambda one: one.identity).alias("keys"),
        raws(lambda one: one.numbers).alias("numbers"),
        raws(lambda one: one.dates).alias("dates"),
        raws(lambda one: one.texts).alias("texts"),
    )
    content = _by_value(F.col("numbers"), F.col("dates"), F.col("texts"))
    return (
        taken.withColumn("parts", F.explode(F.array(F.transform("keys", _identity_part))))
        .filter(F.size("parts") == F.size(F.array_compact("parts")))
        .select("dataset", "snapshot_no", "line_no", F.to_json("parts").alias("identity"), content.alias("content"))
    )


def snapshot_order(records: DataFrame) -> DataFrame:
    """(dataset, snapshot_no, ordinal, next_snapshot_no): the snapshots that hold each dataset, numbered from 1."""
    held = records.select("dataset", "snapshot_no").filter("dataset IS NOT NULL AND snapshot_no IS NOT NULL").distinct()
    w = Window.partitionBy("dataset").orderBy("snapshot_no")
    return held.withColumns({"ordinal": F.row_number().over(w), "next_snapshot_no": F.lead("snapshot_no").over(w)})


def snapshot_changes(records: DataFrame, spec: SnapshotSpec = PUBLIC_WORKS) -> DataFrame:
    """(dataset, snapshot_no, identity, change_kind, changed_fields) between each snapshot and the previous one that holds the dataset.

    change_kind is ``added``, ``removed`` or ``changed``; changed_fields names the content fields
    that differ (null unless ``changed``). A line repeated within a snapshot is reduced before the
    exchange, so a key that holds a large part of all rows becomes one row for each snapshot.
    """
    spark = records.sparkSession
    order = broadcast_checked(snapshot_order(records))
    latest = (
        snapshot_lines(records, spec)
        .filter("snapshot_no IS NOT NULL")
        .groupBy("dataset", "identity", "snapshot_no")
        .agg(F.max(F.struct(F.coalesce("line_no", F.lit(-1)).alias("line_no"), "content"))["content"].alias("content"))
    )
    placed = latest.join(order, ["dataset", "snapshot_no"]).repartitionByRange(shuffle_width(spark), "dataset", "identity")
    w = Window.partitionBy("dataset", "identity").orderBy("ordinal")
    merged = placed.withColumns(
        {
            "before": F.lag("ordinal").over(w),
            "after": F.lead("ordinal").over(w),
            "old": F.lag("content").over(w),
        }
    )
    gap_before = F.col("before").isNull() | (F.col("before") < F.col("ordinal") - 1)
    gap_after = F.col("after").isNull() | (F.col("after") > F.col("ordinal") + 1)

    def event(at: Column, kind: str) -> Column:
        return F.struct(at.alias("snapshot_no"), F.lit(kind).alias("change_kind"))

    events = F.array_compact(
        F.array(
            F.when((F.col("ordinal") > 1) & gap_before, event(F.col("snapshot_no"), "added")),
            F.when(~gap_before & ~F.col("old").eqNullSafe(F.col("content")), event(F.col("snapshot_no"), "changed")),
            F.when(F.col("next_snapshot_no").isNotNull() & gap_after, event(F.col("next_snapshot_no"), "removed")),
        )
    )
    names = None
    for name, one in spec.datasets.items():
        fields = F.array(*[F.lit(f) for f in one.content])
        names = F.when(F.col("dataset") == name, fields) if names is None else names.when(F.col("dataset") == name, fields)
    differing = F.transform(
        F.filter(F.arrays_zip(names.alias("name"), F.col("old").alias("o"), F.col("content").alias("n")), lambda z: ~z["o"].eqNullSafe(z["n"])),
        lambda z: z["name"],
    )
    return (
        merged.select("dataset", "identity", F.explode(events).alias("e"), "old", "content")
        .select(
            "dataset",
            F.col("e.snapshot_no").alias("snapshot_no"),
            "identity",
            F.col("e.change_kind").alias("change_kind"),
            F.when(F.col("e.change_kind") == "changed", differing).alias("changed_fields"),
        )
    )
