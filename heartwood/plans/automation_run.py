"""The digest of the latest run, and the audited run of everything."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood import fixed_values as fixed
from heartwood.functions import to_datetime
from heartwood.operators import snapshots
from heartwood.operators.digest import digest_lines
from heartwood.plans.scoring_run import run_pipeline, status_counts
from heartwood.sources.readers import read_result, snapshot_days
from heartwood.sources.writers import append_run, write_digest


def standalone_summary(current: DataFrame, actions: DataFrame) -> DataFrame:
    """A run summary from stored results alone, without a quality score."""
    action_count = actions.agg(F.count(F.lit(1)).alias("n"))
    counts = current.agg(*[count.alias(name) for name, count in status_counts().items()])
    return counts.select(
        F.lit(fixed.DIGEST_STANDALONE_QUALITY).alias("data_quality_score"),
        "*",
        action_count.scalar().alias("action_items_created"),
    )


def generate_digest(
    spark: SparkSession,
    accounts: DataFrame,
    root: str,
    as_of: datetime,
    summary: DataFrame | None = None,
) -> str:
    """Write the digest of the newest snapshot against the one before; returns its path.

    ``as_of`` is the day urgent actions are counted from. Without ``summary`` the
    figures are taken from the stored results.
    """
    history = read_result(spark, root, "health_scores")
    dates = snapshot_days(spark, root)[:2]
    if not dates:
        raise RuntimeError("no health scores: run the scoring pipeline before the digest")
    newest = F.lit(dates[0])
    previous_date = F.lit(dates[1] if len(dates) > 1 else None).cast("date")
    current, _ = snapshots.current_and_previous_scores(history, (newest, previous_date))
    # the two dates are literals, so only their partitions are read
    stored = history.filter(F.col("score_date").isin(dates))
    pairs = snapshots.pair_snapshots(stored, newest, previous_date)
    actions = read_result(spark, root, "action_center")
    if summary is None:
        summary = standalone_summary(current, actions)
    lines = digest_lines(
        summary,
        snapshots.newly_critical_in(pairs),
        snapshots.score_drops_in(pairs),
        snapshots.due_actions(actions, accounts, as_of, fixed.URGENT_DAYS_AHEAD),
        accounts,
        newest,
        previous_date,
    )
    path = f"{root}/reports/digest_{dates[0].isoformat()}.md"
    write_digest(lines, path)
    return path


def run_once(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    as_of: datetime,
    clock: Callable[[], datetime] = datetime.now,
) -> dict:
    """Pipeline and digest with one audit row at the end, also when they fail.

    Returns the run summary; a failure is recorded and raised again.
    """
    started_at = clock()
    as_of = to_datetime(as_of)
    try:
        # one row, needed by both digest and audit: fetched so that it is computed once
        summary = run_pipeline(spark, tables, root, as_of).first().asDict()
        figures = spark.createDataFrame([summary])
        generate_digest(spark, tables["accounts"], root, as_of, figures)
    except Exception as error:
        try:
            append_run(spark, root, started_at, clock(), "Failed", error_message=str(error))
        except Exception:
            logging.getLogger(__name__).exception("the failed run could not be recorded")
        raise
    append_run(spark, root, started_at, clock(), "Success", summary)
    return summary
