"""Checks on results that are queries themselves."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import count_where, view_rows, weighted_count
from heartwood.operators.workload import add_next_renewal


def score_outcome_gap(scores: DataFrame, renewals: DataFrame) -> DataFrame:
    """Average score of churned and of renewed accounts, once per renewal, and the gap."""
    # counted before the join, so an account with very many renewals is a few rows
    outcomes = renewals.groupBy("account_id", "renewal_status").agg(
        F.count(F.lit(1)).alias("renewals")
    )
    joined = scores.select("account_id", "overall_score").join(outcomes, "account_id")

    def average(status: str):
        counted = F.when(F.col("renewal_status") == status, F.col("renewals"))
        score = F.col("overall_score").cast("decimal(5,2)") * counted.cast("decimal(18,0)")
        return F.try_divide(F.sum(score).cast("double"), F.sum(counted))

    averages = joined.agg(
        average("Churned").alias("churned_avg"), average("Renewed").alias("renewed_avg")
    )
    return averages.withColumn("gap", F.col("renewed_avg") - F.col("churned_avg"))


def engagement_middle_share(engagement: DataFrame) -> DataFrame:
    """Share of accounts whose engagement is neither 0 nor 100."""
    score = F.col("engagement_score")
    middle = count_where((score != 0) & (score != 100))
    return engagement.agg(F.try_divide(middle, F.count(F.lit(1))).alias("middle_share"))


def max_status_share(scores: DataFrame) -> DataFrame:
    """Share of accounts in the most frequent status."""
    counts = scores.groupBy("health_status").agg(F.count(F.lit(1)).alias("accounts"))
    share = F.try_divide(F.max("accounts"), F.sum("accounts"))
    return counts.agg(share.alias("max_share"))


def score_bounds(scores: DataFrame) -> DataFrame:
    """Rows, distinct accounts, and scores outside 0..100 (all of them should be none)."""
    names = [name for name, _ in fixed.COMPONENT_WEIGHTS] + ["overall_score"]
    outside = [F.when(~F.col(name).between(0, 100), 1).otherwise(0) for name in names]
    per_account = scores.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(sum(outside, F.lit(0))).alias("outside")
    )
    return per_account.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("score_rows"),
        F.count("account_id").alias("accounts"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("out_of_bounds"),
    )


def view_checks(accounts: DataFrame, health: DataFrame) -> DataFrame:
    """Row counts of accounts and the view, past next renewals, blank status or owner."""
    weight = view_rows(health)
    return health.agg(
        weighted_count(weight).alias("rows_in_view"),
        weighted_count(weight, F.col("days_to_next_renewal") < 0).alias("negative_days"),
        weighted_count(weight, F.col("health_status").isNull()).alias("blank_status"),
        weighted_count(weight, F.col("csm_owner").isNull()).alias("blank_owner"),
    ).withColumn("account_rows", accounts.agg(F.count(F.lit(1)).alias("n")).scalar())


def latest_survey_checks(surveys: DataFrame, latest: DataFrame) -> DataFrame:
    """Surveyed accounts against rows of the latest-survey view."""
    surveyed = surveys.select("account_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    return latest.agg(F.count(F.lit(1)).alias("latest_rows")).withColumn(
        "surveyed_accounts", surveyed.scalar()
    )


def renewal_rule_mismatches(
    health: DataFrame, accounts: DataFrame, as_of: datetime
) -> DataFrame:
    """Accounts whose rolled-forward renewal differs between view and workload input."""
    rolled = add_next_renewal(accounts, as_of).select(
        "account_id", F.col("days_to_next_renewal").alias("days_in_workload")
    )
    view = health.groupBy("account_id").agg(
        F.max("days_to_next_renewal").alias("days_in_view")
    )
    differs = ~F.col("days_in_view").eqNullSafe(F.col("days_in_workload"))
    return view.join(rolled, "account_id").agg(count_where(differs).alias("mismatches"))


def owner_critical_mismatches(performance: DataFrame, health: DataFrame) -> DataFrame:
    """Owners whose critical count differs from the accounts listed as Critical."""
    listed = (
        health.filter(F.col("health_status") == "Critical")
        .select(F.col("csm_owner").alias("_owner"), "account_id")
        .distinct()
        .groupBy("_owner")
        .agg(F.count(F.lit(1)).alias("listed"))
    )
    same_owner = performance["csm_owner"].eqNullSafe(listed["_owner"])
    differs = F.col("critical_accounts") != F.coalesce("listed", F.lit(0))
    return performance.join(listed, same_owner, "left").agg(
        F.count(F.lit(1)).alias("owners"), count_where(differs).alias("mismatches")
    )
