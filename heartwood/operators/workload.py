"""Renewal roll-forward, owner workload and its categories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import as_of_day, count_where, next_renewal_date, np_round
from heartwood.operators.order_statistics import histogram, quantiles
from heartwood.session import store_once


def add_next_renewal(accounts: DataFrame, as_of: datetime) -> DataFrame:
    rolled = next_renewal_date(F.col("renewal_date"), as_of)
    return accounts.withColumns(
        {
            "next_renewal_date": rolled,
            "days_to_next_renewal": F.datediff(rolled, as_of_day(as_of)),
        }
    )


def _renewal_in_window() -> Column:
    return F.col("days_to_next_renewal").between(0, fixed.RENEWAL_WINDOW_DAYS)


def owner_workload(
    scores: DataFrame,
    accounts: DataFrame,
    tickets: DataFrame,
    renewals_upcoming: DataFrame | None = None,
) -> DataFrame:
    """Weighted workload per owner.

    An account has an upcoming renewal if ``renewals_upcoming`` lists it with
    ``days_to_next_renewal`` inside the window; without that frame the column is
    taken from ``accounts`` itself, and without the column there are none.
    Accounts without owner are left out.
    """
    kept = ["account_id", "csm_owner"]
    if renewals_upcoming is None and "days_to_next_renewal" in accounts.columns:
        owned = accounts.select(*kept, _renewal_in_window().alias("upcoming"))
    elif renewals_upcoming is not None and "days_to_next_renewal" in renewals_upcoming.columns:
        listed = renewals_upcoming.filter(_renewal_in_window()).select("account_id").distinct()
        listed = listed.withColumn("upcoming", F.lit(True))
        owned = accounts.select(*kept).join(listed, "account_id", "left")
    else:
        owned = accounts.select(*kept, F.lit(False).alias("upcoming"))

    open_tickets = (
        tickets.filter(F.col("status") == "Open")
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("open_tickets"))
    )
    per_account = (
        owned.filter(F.col("csm_owner").isNotNull())
        .join(scores.select("account_id", "health_status"), "account_id", "left")
        .join(open_tickets, "account_id", "left")
    )
    per_owner = per_account.groupBy("csm_owner").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        count_where(F.col("health_status") == "At Risk").alias("at_risk_accounts"),
        count_where(F.col("health_status") == "Critical").alias("critical_accounts"),
        F.coalesce(F.sum("open_tickets"), F.lit(0)).alias("open_tickets"),
        count_where(F.col("upcoming")).alias("upcoming_renewals"),
    )
    points = sum((F.col(name) * weight for name, weight in fixed.WORKLOAD_POINTS), F.lit(0.0))
    return per_owner.withColumn("workload_score", np_round(points, 1))


def compute_csm_workload(
    scores: DataFrame,
    accounts: DataFrame,
    tickets: DataFrame,
    renewals_upcoming: DataFrame | None = None,
) -> DataFrame:
    """:func:`owner_workload` with its category, heaviest first."""
    scored = owner_workload(scores, accounts, tickets, renewals_upcoming)
    return categorise_workload(scored).orderBy(F.desc("workload_score"), "csm_owner")


def categorise_workload(scored: DataFrame) -> DataFrame:
    """Quartile categories of ``workload_score`` over the rows at hand.

    When any two quartile edges coincide the split is at the median instead. The rows, one per
    owner, are stored first, so that what they come from is carried out once; the edges are
    exact and come from the histogram of the scores.
    """
    score = F.col("workload_score")
    stored = store_once(scored)
    edges = quantiles(histogram(stored, "workload_score"), (0.0, 0.25, 0.5, 0.75, 1.0))
    ranked = stored.withColumn("_edges", edges.scalar())
    lowest, q1, median, q3, highest = (F.col("_edges")[i] for i in range(5))
    balanced, elevated, high, overloaded = (F.lit(c) for c in fixed.WORKLOAD_CATEGORIES)
    all_differ = (lowest < q1) & (q1 < median) & (median < q3) & (q3 < highest)
    by_quartile = (
        F.when(score <= q1, balanced)
        .when(score <= median, elevated)
        .when(score <= q3, high)
        .otherwise(overloaded)
    )
    by_median = F.when(score > median, overloaded).otherwise(balanced)
    category = F.when(all_differ, by_quartile).otherwise(by_median)
    return ranked.withColumn("workload_category", category).drop("_edges")
