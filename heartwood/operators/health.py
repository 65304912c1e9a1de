"""Account health: the component scores, the overall score, its status and drivers.

Engagement, the one component that orders an account's rows, has its own module.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import (
    as_of_day,
    classify_status,
    clip_score,
    count_where,
    elapsed_days,
    np_round,
    risk_drivers,
    sla_breached,
)
from heartwood.operators.engagement import score_engagement

def score_support(tickets: DataFrame, as_of: datetime) -> DataFrame:
    breached = sla_breached(
        F.col("created_date"), F.col("resolved_date"), F.col("sla_hours"), as_of
    )
    per_account = (
        tickets.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            count_where(F.col("priority").isin(*fixed.SEVERE_PRIORITIES)).alias("severe"),
            count_where(breached).alias("breached"),
            count_where(F.col("status") == "Open").alias("open"),
        )
    )
    open_points = F.least(
        F.lit(fixed.OPEN_TICKET_POINTS_CAP), F.col("open") * fixed.OPEN_TICKET_POINTS
    )
    score = (
        F.lit(100.0)
        - F.col("severe") / F.col("tickets") * fixed.SEVERE_SHARE_POINTS
        - F.col("breached") / F.col("tickets") * fixed.BREACH_SHARE_POINTS
        - open_points
    )
    return per_account.select(
        "account_id", np_round(clip_score(score), 2).alias("support_score")
    )


def latest_survey(surveys: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the newest survey per account; one without date counts as newest.

    The greatest struct of date, id and columns: an aggregate, so combined before the
    shuffle, and cheaper than ranking where all columns are needed anyway.
    """
    newest = F.max(
        F.struct(F.col("survey_date").isNull(), "survey_date", "survey_id", *columns)
    )
    return (
        surveys.groupBy("account_id")
        .agg(newest.alias("newest"))
        .select("account_id", *[F.col(f"newest.{name}") for name in columns])
    )


def score_csat_nps(surveys: DataFrame) -> DataFrame:
    known = surveys.filter(F.col("account_id").isNotNull())
    csat = F.col("csat_score").cast("double")
    nps = (F.col("nps_score") + 100) / 2
    return latest_survey(known, "csat_score", "nps_score").select(
        "account_id",
        F.when(csat.isNotNull(), clip_score(csat)).alias("csat_score"),
        F.when(nps.isNotNull(), clip_score(nps)).alias("nps_score"),
    )


def score_onboarding(customer_success: DataFrame) -> DataFrame:
    score = F.lit(100.0)
    for start, end, allowed, points, cap in fixed.ONBOARDING_RULES:
        if start in customer_success.columns and end in customer_success.columns:
            over = elapsed_days(F.col(start), F.col(end)) - allowed
            penalty = F.least(F.lit(cap), over * points)
            score = score - F.when(over > 0, penalty).otherwise(F.lit(0))
    return customer_success.select(
        "account_id", np_round(clip_score(score), 2).alias("onboarding_score")
    )


def compute_health_scores(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """One row per account, scored as of ``as_of``; a missing component is neutral."""
    return compute_health_history([(tables, as_of)])


def compute_health_history(
    snapshots: Sequence[tuple[Mapping[str, DataFrame], datetime]],
) -> DataFrame:
    """One row per account and snapshot, for snapshots that differ in tickets and surveys only.

    Engagement and onboarding do not depend on the day: they are computed once, from the first
    snapshot's tables, and joined to all of them.
    """
    tables, _ = snapshots[0]
    dated = [
        tables["accounts"]
        .select("account_id")
        .join(score_support(known["support_tickets"], as_of), "account_id", "left")
        .join(score_csat_nps(known["surveys"]), "account_id", "left")
        .withColumn("score_date", as_of_day(as_of))
        for known, as_of in snapshots
    ]
    scored = (
        reduce(DataFrame.unionByName, dated)
        .join(score_engagement(tables["product_usage"]), "account_id", "left")
        .join(score_onboarding(tables["customer_success"]), "account_id", "left")
    )

    names = [name for name, _ in fixed.COMPONENT_WEIGHTS]
    scored = scored.select(
        "account_id",
        "score_date",
        *[F.coalesce(F.col(name), F.lit(fixed.NEUTRAL_SCORE)).alias(name) for name in names],
    )
    total = None
    for name, weight in fixed.COMPONENT_WEIGHTS:
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    scored = scored.withColumn("overall_score", np_round(total, 2))
    return scored.withColumns(
        {
            "health_status": classify_status(F.col("overall_score")),
            "risk_drivers": risk_drivers({name: F.col(name) for name in names}),
        }
    )
