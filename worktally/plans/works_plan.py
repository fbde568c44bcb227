"""The chain from source tables to flagged works, members and states."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.functions.measures import parse_amount, parse_date
from worktally.functions.text import whole_number
from worktally.operators import anomaly, benchmarks, flags, members, metrics, ranking, works
from worktally.runtime import cut

#: Works from which percentiles of groups are taken with ACCURACY (off by a share of 1 / ACCURACY of the ranks) instead of exactly: an exact one holds all values of its group.
EXACT_ROWS, ACCURACY = 20_000_000, 10_000
MEMBER, STATE = ["member_type", "member_id"], ["state_id"]


@dataclass
class WorksPlan:
    """Stages over the tables of one folder; each is built when first asked for.

    A stage named ``…_once`` is lazy, for a plan that reads it once; the same without is written to
    the checkpoint folder when first asked for, for plans that read it more than once.
    """

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def accuracy(self) -> int | None:
        """The accuracy of percentiles, none for exact ones; by the rows of the source, which its footers tell."""
        return ACCURACY if self.table("work_analysis").count() > EXACT_ROWS else None

    @cached_property
    def payments(self) -> DataFrame:
        return works.payments_by_work(self.table("expenditure"))

    @cached_property
    def payment_rows(self) -> DataFrame:
        """(work_id, day, amount): each payment once."""
        once = self.table("expenditure").groupBy("sno").agg(F.max(F.struct("work_recommendation_dtl_id", "fund_disbursed_amt", "expenditure_date")).alias("p"))
        return once.select(whole_number(F.col("p.work_recommendation_dtl_id")).cast("bigint").alias("work_id"), parse_date(F.col("p.expenditure_date")).alias("day"), parse_amount(F.col("p.fund_disbursed_amt")).alias("amount"))

    @cached_property
    def measured_once(self) -> DataFrame:
        return works.with_measures(works.clean_analysis(self.table("work_analysis"), self.payments))

    @cached_property
    def measured(self) -> DataFrame:
        return cut(self.measured_once)

    @cached_property
    def groups_once(self) -> DataFrame:
        return benchmarks.benchmark_groups(self.measured_once, self.accuracy)

    @cached_property
    def benchmarked(self) -> DataFrame:
        # Read by both levels of the join.
        return benchmarks.with_benchmarks(self.measured, cut(benchmarks.benchmark_groups(self.measured, self.accuracy)))

    @property
    def flagged_once(self) -> DataFrame:
        """The kept works if there are any, else a lazy plan."""
        return self.__dict__.get("flagged", self._flagged_plan)

    @cached_property
    def _flagged_plan(self) -> DataFrame:
        return flags.with_flags(self.benchmarked, benchmarks.delay_distribution(self.measured, self.accuracy))

    @cached_property
    def flagged(self) -> DataFrame:
        return cut(self._flagged_plan)

    @cached_property
    def members_once(self) -> DataFrame:
        return metrics.member_metrics(self.flagged_once, self.accuracy)

    @cached_property
    def members(self) -> DataFrame:
        return cut(self.members_once)

    @cached_property
    def states_once(self) -> DataFrame:
        return metrics.state_metrics(self.flagged_once, self.accuracy)

    @cached_property
    def states(self) -> DataFrame:
        return cut(self.states_once)

    @cached_property
    def master(self) -> DataFrame:
        return members.master(self.table("mps"), self.table("mlas"))

    @cached_property
    def population(self) -> DataFrame:
        return members.master_population(self.table("allocated_limit"))

    @cached_property
    def idle(self) -> DataFrame:
        """The members of the master without works, with their limits."""
        return members.zero_work_members(self.master, self.members.select(*MEMBER), self.population)

    @cached_property
    def all_members(self) -> DataFrame:
        """Members with works, and those of the master without any, with zeros."""
        counts = {c: F.lit(0) for c in metrics.STATISTICS if not c.startswith(("avg", "median", "max"))}
        return self.members.unionByName(self.idle.select(*MEMBER).withColumns({**counts, "ranking_qualified": F.lit(False)}), allowMissingColumns=True)

    @cached_property
    def member_anomalies(self) -> DataFrame:
        return anomaly.entity_anomalies(self.members, anomaly.MEMBER_FEATURES, MEMBER, ["member_type"])

    @cached_property
    def state_anomalies(self) -> DataFrame:
        return anomaly.entity_anomalies(self.states, anomaly.STATE_FEATURES, STATE, [], anomaly.STATE_CONFIDENCE)

    @cached_property
    def member_ranks(self) -> DataFrame:
        return ranking.ranked(self.all_members, "member_id", ["member_type"], F.col("ranking_qualified"))

    @cached_property
    def state_ranks(self) -> DataFrame:
        return ranking.ranked(self.states, "state_id", [], F.col("total_works").isNotNull())
