"""What changed between the last two score snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import as_of_day


def last_two_dates(health_scores: DataFrame) -> DataFrame:
    """The dates of the newest two snapshots, newest first."""
    return health_scores.select("score_date").distinct().orderBy(F.desc("score_date")).limit(2)


def snapshot_dates(health_scores: DataFrame) -> tuple[Column, Column]:
    """Newest and second newest date as scalars; NULL where there is none.

    As scalars they prune the partitions of a stored history at run time.
    """
    newest = last_two_dates(health_scores).agg(F.max("score_date").alias("newest"))
    oldest = last_two_dates(health_scores).agg(
        F.when(F.count(F.lit(1)) == 2, F.min("score_date")).alias("previous")
    )
    return newest.scalar(), oldest.scalar()


def current_and_previous_scores(
    health_scores: DataFrame, dates: tuple[Column, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of the newest snapshot and of the one before (none on a first run).

    ``dates`` are the two dates where they are known already.
    """
    newest, previous = dates or snapshot_dates(health_scores)
    score = F.col("overall_score").cast("double").alias("overall_score")
    columns = ["account_id", "health_status", score]
    current = health_scores.filter(F.col("score_date") == newest)
    earlier = health_scores.filter(F.col("score_date") == previous)
    return current.select(*columns, "risk_drivers"), earlier.select(*columns)


def pair_snapshots(health_scores: DataFrame, newest: Column, previous: Column) -> DataFrame:
    """One row per account with its scores in two snapshots, each NULL where it is not in it.

    Takes both from one pass over the history, for a history that is dear to compute.
    Snapshots have one row per account.
    """
    score = F.col("overall_score").cast("double")
    columns = [c for c in health_scores.columns if c != "account_id"]
    now = F.struct(*[score.alias(c) if c == "overall_score" else F.col(c) for c in columns])
    before = F.struct("health_status", score.alias("overall_score"))
    return health_scores.groupBy("account_id").agg(
        F.max(F.when(F.col("score_date") == newest, now)).alias("current"),
        F.max(F.when(F.col("score_date") == previous, before)).alias("previous"),
    )


def newly_critical_in(pairs: DataFrame) -> DataFrame:
    """:func:`find_newly_critical` on paired snapshots."""
    was_critical = F.col("previous.health_status").eqNullSafe("Critical")
    return pairs.filter((F.col("current.health_status") == "Critical") & ~was_critical).select(
        "account_id", "current.*"
    )


def score_drops_in(pairs: DataFrame) -> DataFrame:
    """:func:`find_score_drops` on paired snapshots, in no order."""
    lost = F.col("previous.overall_score") - F.col("current.overall_score")
    return pairs.filter(lost >= fixed.SCORE_DROP_POINTS).select(
        "account_id",
        "current.*",
        F.col("previous.health_status").alias("health_status_previous"),
        F.col("previous.overall_score").alias("overall_score_previous"),
        lost.alias("drop"),
    )


def find_newly_critical(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Critical now and not Critical in the previous snapshot, or not in it at all."""
    critical = F.col("health_status") == "Critical"
    was_critical = previous.filter(critical).select("account_id")
    return current.filter(critical).join(was_critical, "account_id", "left_anti")


def find_score_drops(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Accounts in both snapshots that lost at least ten points, largest drop first."""
    before = previous.select(
        "account_id",
        F.col("health_status").alias("health_status_previous"),
        F.col("overall_score").alias("overall_score_previous"),
    )
    lost = F.col("overall_score_previous") - F.col("overall_score")
    return (
        current.join(before, "account_id")
        .withColumn("drop", lost)
        .filter(F.col("drop") >= fixed.SCORE_DROP_POINTS)
        .orderBy(F.desc("drop"), "account_id")
    )


def urgent_action_items(
    actions: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    days_ahead: int = fixed.URGENT_DAYS_AHEAD,
) -> DataFrame:
    """Open actions due within the next days or overdue, earliest first."""
    return due_actions(actions, accounts, as_of, days_ahead).orderBy("due_date", "account_id")


def due_actions(
    actions: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    days_ahead: int = fixed.URGENT_DAYS_AHEAD,
) -> DataFrame:
    """:func:`urgent_action_items` in no order."""
    cutoff = F.date_add(as_of_day(as_of), days_ahead)
    due = actions.filter((F.col("due_date") <= cutoff) & (F.col("status") == "Open"))
    return (
        due.join(accounts.select("account_id", "company_name"), "account_id")
        .select(
            "account_id",
            "company_name",
            "risk_level",
            "recommended_action",
            "owner",
            "due_date",
        )
    )


def changed_accounts(newly_critical: DataFrame, score_drops: DataFrame) -> DataFrame:
    """Ids of all accounts in either list, once each."""
    return newly_critical.select("account_id").union(score_drops.select("account_id")).distinct()


def account_names(accounts: DataFrame, ids: DataFrame) -> DataFrame:
    """Names of the accounts in ``ids`` that exist."""
    return accounts.select("account_id", "company_name").join(ids, "account_id", "left_semi")
