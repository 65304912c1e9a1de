"""The follow-up queue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import as_of_day, as_of_moment, due_in_days, recommended_action


def build_action_center(scores: DataFrame, accounts: DataFrame, as_of: datetime) -> DataFrame:
    """One open action per account that is Critical, At Risk or Monitor.

    Urgency comes from the account's own renewal date, not the rolled-forward one.
    """
    followed_up = [status for status, _, _ in fixed.RISK_ACTIONS]
    flagged = scores.filter(F.col("health_status").isin(*followed_up)).select(
        "account_id", "health_status", "risk_drivers"
    )
    owners = accounts.select("account_id", "csm_owner", "renewal_date")
    today = as_of_day(as_of)
    days_to_renewal = F.datediff("renewal_date", today)
    status = F.col("health_status")
    return flagged.join(owners, "account_id", "left").select(
        F.col("account_id").alias("action_id"),
        "account_id",
        status.alias("risk_level"),
        F.col("risk_drivers").alias("reason"),
        recommended_action(status, days_to_renewal).alias("recommended_action"),
        F.col("csm_owner").alias("owner"),
        F.date_add(today, due_in_days(status, days_to_renewal)).alias("due_date"),
        F.lit("Open").alias("status"),
        as_of_moment(as_of).alias("created_at"),
    )
