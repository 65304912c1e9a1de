"""Every operator as a query over the star-schema tables of one directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.operators import digest, health, measures, quality, snapshots, validation, views
from heartwood.operators.actions import build_action_center
from heartwood.operators.workload import (
    add_next_renewal,
    categorise_workload,
    owner_workload,
)
from heartwood.functions import as_of_day
from heartwood.plans.automation_run import standalone_summary
from heartwood.plans.scoring_run import run_summary, score_tables
from heartwood.session import store_once
from heartwood.sources.sql import names_of
from heartwood.sources.star_binding import CanonicalTables, known_by

AS_OF = datetime(2001, 8, 15)
PREVIOUS = datetime(2001, 5, 15)


class Bound:
    """The canonical tables of one directory and what derives from them, all lazy."""

    def __init__(self, spark: SparkSession, directory: str):
        self.tables = CanonicalTables(spark, directory)
        self.events = spark.read.parquet(f"{directory}/events.parquet")

    @cached_property
    def accounts(self) -> DataFrame:
        return self.tables["accounts"]

    @cached_property
    def tickets(self) -> DataFrame:
        return self.tables["support_tickets"]

    @cached_property
    def scores(self) -> DataFrame:
        return health.compute_health_scores(self.tables, AS_OF)

    @cached_property
    def history(self) -> DataFrame:
        return health.compute_health_history(
            [(known_by(self.tables, PREVIOUS), PREVIOUS), (self.tables, AS_OF)]
        )

    @cached_property
    def pairs(self) -> DataFrame:
        return snapshots.pair_snapshots(self.history, as_of_day(AS_OF), as_of_day(PREVIOUS))

    def store_scores(self) -> Bound:
        """Score once for all that follows, as a run does, and go on from what is stored."""
        self.history = store_once(self.history)
        self.scores = self.history.filter(F.col("score_date") == as_of_day(AS_OF))
        return self

    @cached_property
    def account_health(self) -> DataFrame:
        return views.account_health(self.accounts, self.scores, self.tables["renewals"], AS_OF)

    @cached_property
    def health_counted(self) -> DataFrame:
        return views.account_health_counted(
            self.accounts, self.scores, self.tables["renewals"], AS_OF
        )

    @cached_property
    def actions(self) -> DataFrame:
        return build_action_center(self.scores, self.accounts, AS_OF)

    @cached_property
    def owner_workload(self) -> DataFrame:
        rolled = add_next_renewal(self.accounts, AS_OF)
        return owner_workload(self.scores, rolled, self.tickets)

    def performance(self, fan_out: bool) -> DataFrame:
        return views.csm_performance(
            self.accounts, self.health_counted, self.tickets, fan_out
        )

    @cached_property
    def usage_trend(self) -> DataFrame:
        return views.usage_trend(self.tables["product_usage"], self.accounts)

    @cached_property
    def newly_critical(self) -> DataFrame:
        return snapshots.newly_critical_in(self.pairs)

    @cached_property
    def score_drops(self) -> DataFrame:
        return snapshots.score_drops_in(self.pairs)

    @cached_property
    def urgent(self) -> DataFrame:
        return snapshots.due_actions(self.actions, self.accounts, AS_OF)

    @cached_property
    def report(self) -> DataFrame:
        return quality.quality_report(self.tables)

    @cached_property
    def summary(self) -> DataFrame:
        actions, workload = score_tables(self.tables, self.scores, AS_OF)
        return run_summary(self.report, self.scores, actions, workload, AS_OF)

    def checks(self, *kinds: str) -> DataFrame:
        return quality.run_checks(self.tables, quality.rules_of(*kinds)).drop("rule")


def _event_usage(events: DataFrame) -> DataFrame:
    """Every event as a usage row: many rows per day, and a ninth of them dealt to accounts of
    three rows."""
    few = F.lit(1_000_000_000) + F.floor(F.col("event_id") / 27)
    pct = F.least(F.lit(100.0), "value").cast("decimal(5,2)")
    return events.select(
        F.col("event_id").alias("usage_id"),
        F.when(F.col("event_id") % 9 == 0, few).otherwise(F.col("user_id")).alias("account_id"),
        F.col("ts").cast("date").alias("usage_date"),
        F.floor("value").cast("int").alias("sessions"),
        F.length("event_type").alias("active_users"),
        F.when(F.col("event_id") % 11 > 0, pct).alias("feature_usage_pct"),
    )


def _median_split(b: Bound) -> DataFrame:
    """Scores of 0 and 1 only, so quartile edges always coincide."""
    parity = F.col("open_tickets") % 2
    owners = b.owner_workload.select("csm_owner", parity.cast("double").alias("workload_score"))
    return categorise_workload(owners)


def _workload_latest(b: Bound) -> DataFrame:
    b.store_scores()
    earlier = b.history.filter(F.col("score_date") == as_of_day(PREVIOUS))

    def run(tables, scores, as_of):
        return score_tables(tables, scores, as_of)[1]

    before = run(known_by(b.tables, PREVIOUS), earlier, PREVIOUS)
    return views.csm_workload_latest(before.unionByName(run(b.tables, b.scores, AS_OF)))


def _last_two_snapshots(b: Bound) -> DataFrame:
    current, previous = snapshots.current_and_previous_scores(b.history)
    return (
        current.withColumn("snapshot", F.lit("current"))
        .unionByName(previous.withColumn("snapshot", F.lit("previous")), allowMissingColumns=True)
    )


def _changed_accounts(b: Bound) -> DataFrame:
    # both lists read the snapshots; else one task would carry out the scoring plan twice at once
    b.store_scores()
    ids = snapshots.changed_accounts(b.newly_critical, b.score_drops)
    return snapshots.account_names(b.accounts, ids)


def _run_summary(b: Bound) -> DataFrame:
    b.scores = store_once(b.scores)
    return b.summary


def _standalone_summary(b: Bound) -> DataFrame:
    b.scores = store_once(b.scores)
    return standalone_summary(b.scores, b.actions)


def _digest_lines(b: Bound) -> DataFrame:
    b.store_scores()
    return digest.digest_lines(
        store_once(b.summary),
        b.newly_critical,
        b.score_drops,
        b.urgent,
        b.accounts,
        as_of_day(AS_OF),
        as_of_day(PREVIOUS),
    )


def _plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare by value in any engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


DEFINITIONS: dict[str, Callable[[Bound], DataFrame]] = {
    # scoring
    "engagement_score": lambda b: health.score_engagement(b.tables["product_usage"]),
    "engagement_score_events": lambda b: health.score_engagement(_event_usage(b.events)),
    "support_score": lambda b: health.score_support(b.tickets, AS_OF),
    "csat_nps_score": lambda b: health.score_csat_nps(b.tables["surveys"]),
    "onboarding_score": lambda b: health.score_onboarding(b.tables["customer_success"]),
    "health_scores": lambda b: b.scores,
    "risk_drivers": lambda b: b.scores.select("account_id", "risk_drivers"),
    "status_distribution": lambda b: b.scores.groupBy("health_status").agg(
        F.count(F.lit(1)).alias("accounts")
    ),
    # actions and workload
    "action_center": lambda b: b.actions,
    "next_renewal": lambda b: add_next_renewal(b.accounts, AS_OF).select(
        "account_id", "renewal_date", "next_renewal_date", "days_to_next_renewal"
    ),
    "csm_workload": lambda b: b.owner_workload.orderBy(F.desc("workload_score"), "csm_owner"),
    "workload_category": lambda b: categorise_workload(
        b.owner_workload.select("csm_owner", "workload_score")
    ),
    "workload_category_median_split": _median_split,
    # views
    "account_health": lambda b: views.account_health(
        b.accounts, b.history, b.tables["renewals"], AS_OF
    ),
    "ticket_sla": lambda b: views.ticket_sla(b.tickets, b.accounts, AS_OF),
    "usage_trend": lambda b: b.usage_trend,
    "latest_survey": lambda b: views.latest_survey_view(b.tables["surveys"]),
    "csm_performance": lambda b: b.performance(fan_out=True),
    "csm_performance_dedup": lambda b: b.performance(fan_out=False),
    "action_center_view": lambda b: views.action_center_view(b.actions, b.accounts),
    "csm_workload_latest": _workload_latest,
    # data quality
    "dq_missing": lambda b: b.checks("missing"),
    "dq_duplicates": lambda b: b.checks("duplicate"),
    "dq_orphans": lambda b: b.checks("orphan"),
    "dq_date_order": lambda b: b.checks("order"),
    "dq_range": lambda b: b.checks("range"),
    "dq_status_date": lambda b: b.checks("status"),
    "dq_issues": lambda b: quality.quality_issues(b.report),
    "dq_score": lambda b: quality.quality_score(b.report),
    # snapshots and digest
    "last_two_snapshots": _last_two_snapshots,
    "newly_critical": lambda b: b.newly_critical,
    "score_drops": lambda b: b.score_drops.orderBy(F.desc("drop"), "account_id"),
    "urgent_actions": lambda b: snapshots.urgent_action_items(b.actions, b.accounts, AS_OF),
    "changed_accounts": _changed_accounts,
    # ids below 1 and far beyond the last one name no account
    "account_names_by_id": lambda b: names_of(b.accounts, [-1, 0, 1, 2, 3, 5, 8, 13, 10**12]),
    "digest_lines": _digest_lines,
    "run_summary": _run_summary,
    "standalone_summary": _standalone_summary,
    # measures
    "accounts_by_account_status": lambda b: measures.accounts_by_account_status(b.accounts),
    "kpi_counts": lambda b: measures.kpi_counts(b.health_counted),
    "kpi_averages": lambda b: measures.kpi_averages(b.health_counted),
    "retention_rate": lambda b: measures.retention_rate(b.health_counted),
    "portfolio_value": lambda b: measures.portfolio_value(b.health_counted),
    "open_tickets": lambda b: measures.open_tickets(b.tickets, b.accounts, AS_OF),
    "sla_breach_rate": lambda b: measures.sla_breach_rate(b.tickets, b.accounts, AS_OF),
    "accounts_by_status": lambda b: measures.accounts_by(b.health_counted, "health_status"),
    "accounts_by_segment": lambda b: measures.accounts_by(b.health_counted, "segment"),
    "upcoming_renewals": lambda b: measures.upcoming_renewals(b.account_health),
    "score_vs_value": lambda b: measures.score_vs_value(b.account_health),
    "sessions_over_time": lambda b: measures.sessions_over_time(b.usage_trend),
    "score_by_industry": lambda b: measures.average_score_by(b.health_counted, "industry"),
    "score_by_region": lambda b: measures.average_score_by(b.health_counted, "region"),
    "critical_by_owner": lambda b: measures.critical_by_owner(b.performance(fan_out=True)),
    # validation
    "score_outcome_gap": lambda b: validation.score_outcome_gap(b.scores, b.tables["renewals"]),
    "engagement_middle_share": lambda b: validation.engagement_middle_share(
        health.score_engagement(b.tables["product_usage"])
    ),
    "max_status_share": lambda b: validation.max_status_share(b.scores),
    "score_bounds": lambda b: validation.score_bounds(b.scores),
    "view_checks": lambda b: validation.view_checks(b.accounts, b.health_counted),
    "latest_survey_checks": lambda b: validation.latest_survey_checks(
        b.tables["surveys"], views.latest_survey_view(b.tables["surveys"])
    ),
    "renewal_rule_mismatches": lambda b: validation.renewal_rule_mismatches(
        b.health_counted, b.accounts, AS_OF
    ),
    "owner_critical_mismatches": lambda b: validation.owner_critical_mismatches(
        b.performance(fan_out=True), b.health_counted
    ),
}


def registered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(define):
        return lambda spark, directory: _plain_numbers(define(Bound(spark, directory)))

    return {name: bind(define) for name, define in DEFINITIONS.items()}
