"""Quality report, scores, action queue and workload of one day, written to a store."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.functions import as_of_day, count_where
from heartwood.operators.actions import build_action_center
from heartwood.operators.health import compute_health_scores
from heartwood.operators.quality import quality_report, quality_score
from heartwood.operators.workload import add_next_renewal, compute_csm_workload
from heartwood.sources import schemas
from heartwood.sources.commits import Commit
from heartwood.sources.writers import put_result

#: the run summary
SUMMARY = {
    "data_quality_score": "double",
    "total_accounts": "bigint",
    "healthy_count": "bigint",
    "monitor_count": "bigint",
    "at_risk_count": "bigint",
    "critical_count": "bigint",
    "action_items_created": "bigint",
    "overloaded_csm_count": "bigint",
    "score_date": "string",
}
SUMMARY_SCHEMA = schemas.ddl(SUMMARY)


def score_tables(
    tables: Mapping[str, DataFrame], scores: DataFrame, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """Action queue and owner workload that follow from ``scores``."""
    accounts = tables["accounts"]
    actions = build_action_center(scores, accounts, as_of)
    workload = compute_csm_workload(
        scores, add_next_renewal(accounts, as_of), tables["support_tickets"]
    )
    return actions, workload.withColumn("run_date", as_of_day(as_of))


def run_summary(
    report: DataFrame,
    scores: DataFrame,
    actions: DataFrame,
    workload: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """One row with the quality score, status counts, actions and overloaded owners."""
    action_count = actions.agg(F.count(F.lit(1)).alias("n"))
    overloaded = workload.agg(count_where(F.col("workload_category") == "Overloaded").alias("n"))
    quality = quality_score(report).select("data_quality_score")
    counts = scores.agg(*[count.alias(name) for name, count in status_counts().items()])
    return counts.select(
        quality.scalar().alias("data_quality_score"),
        "*",
        action_count.scalar().alias("action_items_created"),
        overloaded.scalar().alias("overloaded_csm_count"),
        F.date_format(as_of_day(as_of), "yyyy-MM-dd").alias("score_date"),
    )


def status_counts() -> dict[str, Column]:
    """How many accounts there are, and of each status, as aggregates of scores."""
    status = F.col("health_status")
    return {
        "total_accounts": F.count(F.lit(1)),
        "healthy_count": count_where(status == "Healthy"),
        "monitor_count": count_where(status == "Monitor"),
        "at_risk_count": count_where(status == "At Risk"),
        "critical_count": count_where(status == "Critical"),
    }


def run_pipeline(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, as_of: datetime
) -> DataFrame:
    """Score ``tables`` as of ``as_of`` and write the three results under ``root`` as one commit.

    Scores are computed once: everything after them reads the written snapshot, which
    also outlives a lost executor. The figures of the one-row summary are observed while the
    results are written, so none is read again. A run that fails at any point leaves the
    results as they were.
    """
    day = as_of.date()
    with Commit(spark, root) as commit:
        quality = quality_score(quality_report(tables)).first()
        found = compute_health_scores(tables, as_of)
        scores = put_result(commit, "health_scores", found, day, status_counts())
        scores = scores.select(*schemas.HEALTH_SCORES)
        actions, workload = score_tables(tables, scores, as_of)
        created = {"action_items_created": F.count(F.lit(1))}
        put_result(commit, "action_center", actions, figures=created)
        overloaded = count_where(F.col("workload_category") == "Overloaded")
        put_result(commit, "csm_workload", workload, day, {"overloaded_csm_count": overloaded})
    figures = {
        "data_quality_score": quality["data_quality_score"],
        **commit.figures,
        "score_date": day.isoformat(),
    }
    return spark.createDataFrame([tuple(figures[name] for name in SUMMARY)], SUMMARY_SCHEMA)
