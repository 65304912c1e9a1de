"""The reporting views."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.functions import (
    as_of_day,
    as_of_moment,
    count_where,
    elapsed_hours_rounded,
    sla_breached,
    sql_average,
    view_rows,
)
from heartwood.operators.grouping import left_join_many, newest_per_key
from heartwood.operators.health import latest_survey
from heartwood.operators.workload import add_next_renewal


_ACCOUNT_COLUMNS = (
    "account_id",
    "company_name",
    "industry",
    "segment",
    "region",
    "csm_owner",
    "account_status",
    "contract_value",
    "start_date",
    "renewal_date",
)
_SCORE_COLUMNS = (
    "score_date",
    "engagement_score",
    "support_score",
    "csat_score",
    "nps_score",
    "onboarding_score",
    "overall_score",
    "health_status",
    "risk_drivers",
)
_ROLLED_COLUMNS = ("days_to_renewal", "next_renewal_date", "days_to_next_renewal")


def _scored_accounts(
    accounts: DataFrame, health_scores: DataFrame, as_of: datetime
) -> DataFrame:
    """Accounts with their newest score and the distance to their renewal."""
    newest = newest_per_key(
        health_scores.filter(F.col("account_id").isNotNull()),
        "account_id",
        F.desc_nulls_first("score_date"),
    )
    days = F.datediff("renewal_date", as_of_day(as_of))
    scored = accounts.join(newest, "account_id", "left")
    return add_next_renewal(scored, as_of).withColumn("days_to_renewal", days)


def account_health(
    accounts: DataFrame, health_scores: DataFrame, renewals: DataFrame, as_of: datetime
) -> DataFrame:
    """Accounts with their newest score and their renewals, one row per renewal."""
    renewed = renewals.select("account_id", "renewal_status", "renewal_value", "churn_reason")
    scored = _scored_accounts(accounts, health_scores, as_of)
    return left_join_many(scored, renewed, "account_id", accounts).select(
        *_ACCOUNT_COLUMNS,
        *_SCORE_COLUMNS,
        "renewal_status",
        "renewal_value",
        "churn_reason",
        *_ROLLED_COLUMNS,
    )


def account_health_counted(
    accounts: DataFrame, health_scores: DataFrame, renewals: DataFrame, as_of: datetime
) -> DataFrame:
    """:func:`account_health` for counting: one row per account and renewal status.

    ``view_rows`` says how many rows of the view it stands for. Renewals are counted
    before the join, so neither they nor a hot account among them are shuffled. The
    measures and :func:`csm_performance` take either form.
    """
    per_status = (
        renewals.filter(F.col("account_id").isNotNull())
        .groupBy("account_id", "renewal_status")
        .agg(F.count(F.lit(1)).alias("renewals"))
    )
    scored = _scored_accounts(accounts, health_scores, as_of)
    return scored.join(per_status, "account_id", "left").select(
        *_ACCOUNT_COLUMNS,
        *_SCORE_COLUMNS,
        "renewal_status",
        *_ROLLED_COLUMNS,
        F.coalesce("renewals", F.lit(1)).alias("view_rows"),
    )


def ticket_sla(tickets: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    """Tickets of known accounts with their age and whether they broke their SLA."""
    owners = accounts.select("account_id", "company_name", "csm_owner", "segment")
    created, resolved = F.col("created_date"), F.col("resolved_date")
    until = F.coalesce(resolved, as_of_moment(as_of))
    return tickets.join(owners, "account_id").select(
        "ticket_id",
        "account_id",
        "company_name",
        "csm_owner",
        "segment",
        "priority",
        "category",
        "created_date",
        "resolved_date",
        "sla_hours",
        "status",
        elapsed_hours_rounded(created, until).alias("age_or_resolution_hours"),
        sla_breached(created, resolved, F.col("sla_hours"), as_of).alias("sla_breached"),
    )


def usage_trend(usage: DataFrame, accounts: DataFrame) -> DataFrame:
    owners = accounts.select("account_id", "company_name", "segment", "csm_owner")
    return usage.join(owners, "account_id").select(
        "account_id",
        "company_name",
        "segment",
        "csm_owner",
        "usage_date",
        "sessions",
        "active_users",
        "feature_usage_pct",
    )


def latest_survey_view(surveys: DataFrame) -> DataFrame:
    named = surveys.withColumn("date", F.col("survey_date"))
    latest = latest_survey(named, "date", "csat_score", "nps_score", "feedback_category")
    return latest.withColumnRenamed("date", "survey_date")


def csm_performance(
    accounts: DataFrame, health: DataFrame, tickets: DataFrame, fan_out: bool = True
) -> DataFrame:
    """Per owner: accounts, risk counts, average scores, open tickets, contract value.

    The view is defined over accounts ⟕ account health ⟕ tickets, so with ``fan_out``
    an account counts once per ticket (and renewal) in the averages and the contract
    value. The join is not carried out: its row count per account is a weight. Without
    ``fan_out`` every account counts once.
    """
    scores = ["overall_score", "csat_score", "nps_score"]
    # one row per account again, however many renewals it has
    per_account = health.groupBy("account_id", "health_status", *scores).agg(
        F.sum(view_rows(health)).alias("health_rows")
    )
    per_account_tickets = tickets.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("ticket_rows")
    )
    weight = F.lit(1).cast("bigint")
    if fan_out:
        weight = F.coalesce("health_rows", F.lit(1)) * F.coalesce("ticket_rows", F.lit(1))
    owned = (
        accounts.select("account_id", "csm_owner", "contract_value")
        .join(per_account, "account_id", "left")
        .join(per_account_tickets, "account_id", "left")
        .withColumn("weight", weight)
    )

    def total(name: str, scale: str):
        return F.sum(F.col(name).cast(scale) * F.col("weight").cast("decimal(18,0)"))

    distinct_accounts = owned.groupBy("csm_owner", "account_id").agg(
        F.max(F.col("health_status") == "Critical").alias("critical"),
        F.max(F.col("health_status") == "At Risk").alias("at_risk"),
        total("contract_value", "decimal(12,2)").alias("value"),
        *[total(name, "decimal(5,2)").alias(f"{name}_sum") for name in scores],
        *[
            F.sum(F.when(F.col(name).isNotNull(), F.col("weight"))).alias(f"{name}_rows")
            for name in scores
        ],
    )

    def average(name: str):
        return sql_average(F.sum(f"{name}_sum"), F.sum(f"{name}_rows"), 1)

    per_owner = distinct_accounts.groupBy("csm_owner").agg(
        F.count("account_id").alias("total_accounts"),
        count_where(F.col("critical")).alias("critical_accounts"),
        count_where(F.col("at_risk")).alias("at_risk_accounts"),
        average("overall_score").alias("avg_health_score"),
        average("csat_score").alias("avg_csat"),
        average("nps_score").alias("avg_nps"),
        F.sum("value").cast("decimal(38,2)").alias("total_portfolio_value"),
    )
    open_tickets = (
        tickets.filter(F.col("status") == "Open")
        .select("account_id", "ticket_id")
        .join(accounts.select("account_id", "csm_owner"), "account_id")
        .select(F.col("csm_owner").alias("_owner"), "ticket_id")
        .distinct()
        .groupBy("_owner")
        .agg(F.count("ticket_id").alias("open_tickets"))
    )
    same_owner = per_owner["csm_owner"].eqNullSafe(open_tickets["_owner"])
    return per_owner.join(open_tickets, same_owner, "left").select(
        "csm_owner",
        "total_accounts",
        "critical_accounts",
        "at_risk_accounts",
        "avg_health_score",
        "avg_csat",
        "avg_nps",
        F.coalesce("open_tickets", F.lit(0)).alias("open_tickets"),
        "total_portfolio_value",
    )


def action_center_view(actions: DataFrame, accounts: DataFrame) -> DataFrame:
    named = accounts.select("account_id", "company_name", "segment")
    return actions.join(named, "account_id").select(
        "action_id",
        "account_id",
        "company_name",
        "segment",
        "risk_level",
        "reason",
        "recommended_action",
        "owner",
        "due_date",
        "status",
        "created_at",
    )


def csm_workload_latest(workload: DataFrame) -> DataFrame:
    newest = workload.agg(F.max("run_date").alias("run_date")).scalar()
    return workload.filter(F.col("run_date") == newest)


def register_views(
    tables: Mapping[str, DataFrame],
    health_scores: DataFrame,
    action_center: DataFrame,
    csm_workload: DataFrame,
    as_of: datetime,
) -> None:
    """All seven views as temp views under their names."""
    accounts, tickets = tables["accounts"], tables["support_tickets"]
    scored = (accounts, health_scores, tables["renewals"], as_of)
    counted = account_health_counted(*scored)
    views = {
        "vw_account_health": account_health(*scored),
        "vw_ticket_sla": ticket_sla(tickets, accounts, as_of),
        "vw_usage_trend": usage_trend(tables["product_usage"], accounts),
        "vw_latest_survey": latest_survey_view(tables["surveys"]),
        "vw_csm_performance": csm_performance(accounts, counted, tickets),
        "vw_action_center": action_center_view(action_center, accounts),
        "vw_csm_workload_latest": csm_workload_latest(csm_workload),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
