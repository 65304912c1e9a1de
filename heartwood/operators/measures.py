"""Dashboard measures and datasets over the reporting views.

``health`` is the account-health view, for counts and averages in either of its forms.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.functions import count_where, sla_breached, view_rows, weighted_count


def accounts_by_account_status(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("account_status").agg(F.count(F.lit(1)).alias("accounts"))


def _average(health: DataFrame, name: str) -> Column:
    """Mean as sum over count. The sum is taken over decimals, so it is exact."""
    value, weight = F.col(name), view_rows(health)
    total = F.sum(value.cast("decimal(12,2)") * weight.cast("decimal(18,0)"))
    return F.try_divide(total.cast("double"), F.sum(F.when(value.isNotNull(), weight)))


def kpi_counts(health: DataFrame) -> DataFrame:
    weight, status = view_rows(health), F.col("health_status")
    return health.agg(
        weighted_count(weight).alias("total_accounts"),
        weighted_count(weight, status == "Healthy").alias("healthy_accounts"),
        weighted_count(weight, status == "At Risk").alias("at_risk_accounts"),
        weighted_count(weight, status == "Critical").alias("critical_accounts"),
    )


def kpi_averages(health: DataFrame) -> DataFrame:
    return health.agg(
        _average(health, "overall_score").alias("avg_health_score"),
        _average(health, "csat_score").alias("avg_csat"),
        _average(health, "nps_score").alias("avg_nps"),
    )


def retention_rate(health: DataFrame) -> DataFrame:
    """Renewed out of Renewed and Churned; NULL when there are neither."""
    weight, status = view_rows(health), F.col("renewal_status")
    renewed = weighted_count(weight, status == "Renewed")
    decided = weighted_count(weight, status.isin("Renewed", "Churned"))
    return health.agg(F.try_divide(renewed, decided).alias("retention_rate"))


def portfolio_value(health: DataFrame) -> DataFrame:
    value = F.col("contract_value") * view_rows(health).cast("decimal(18,0)")
    return health.agg(F.sum(value).alias("total_portfolio_value"))


def _ticket_counts(tickets: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    """Tickets, open and breached ones per known account, counted before the join."""
    breached = sla_breached(
        F.col("created_date"), F.col("resolved_date"), F.col("sla_hours"), as_of
    )
    per_account = tickets.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("tickets"),
        count_where(F.col("status") == "Open").alias("open"),
        count_where(breached).alias("breached"),
    )
    return per_account.join(accounts.select("account_id"), "account_id")


def open_tickets(tickets: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    counts = _ticket_counts(tickets, accounts, as_of)
    return counts.agg(F.coalesce(F.sum("open"), F.lit(0)).alias("open_tickets"))


def sla_breach_rate(tickets: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    counts = _ticket_counts(tickets, accounts, as_of)
    rate = F.try_divide(F.sum("breached"), F.sum("tickets"))
    return counts.agg(rate.alias("sla_breach_rate"))


def accounts_by(health: DataFrame, column: str) -> DataFrame:
    """Accounts per ``health_status``, ``segment`` or another attribute."""
    return health.groupBy(column).agg(weighted_count(view_rows(health)).alias("accounts"))


def upcoming_renewals(health: DataFrame, days: int = 90) -> DataFrame:
    return (
        health.filter(F.col("days_to_next_renewal") <= days)
        .select(
            "account_id",
            "company_name",
            "csm_owner",
            "health_status",
            "next_renewal_date",
            "days_to_next_renewal",
        )
        .orderBy("days_to_next_renewal", "account_id")
    )


def score_vs_value(health: DataFrame) -> DataFrame:
    return health.select("account_id", "overall_score", "contract_value", "health_status")


def sessions_over_time(usage_trend: DataFrame, account_id: int | None = None) -> DataFrame:
    """Sessions per day, of all accounts or of one."""
    if account_id is not None:
        usage_trend = usage_trend.filter(F.col("account_id") == account_id)
    return (
        usage_trend.groupBy("usage_date")
        .agg(F.sum("sessions").alias("sessions"))
        .orderBy("usage_date")
    )


def average_score_by(health: DataFrame, column: str) -> DataFrame:
    return health.groupBy(column).agg(_average(health, "overall_score").alias("avg_health_score"))


def critical_by_owner(performance: DataFrame) -> DataFrame:
    return performance.select(
        "csm_owner", "critical_accounts", "total_portfolio_value"
    ).orderBy(F.desc("critical_accounts"), "csm_owner")
