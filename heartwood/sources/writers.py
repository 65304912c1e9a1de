"""Sinks: raw-table reload, CSV export, and the result tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.sources import schemas
from heartwood.sources.commits import Commit, next_number
from heartwood.sources.files import join_parts, remove
from heartwood.sources.readers import CSV_OPTIONS


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema.items()])


def reload_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], location: str
) -> None:
    """Replace the raw tables under ``location`` in one commit; again, and nothing changes.

    A table missing from ``tables`` ends up empty, since a reload starts from
    empty tables. Result tables and their history are left alone.
    """
    with Commit(spark, location) as commit:
        for name, schema in schemas.RAW_SCHEMAS.items():
            if name in tables:
                rows = conform(tables[name], schema)
            else:
                rows = spark.createDataFrame([], schemas.ddl(schema))
            commit.refresh(name, rows)


def export_csv(
    tables: Mapping[str, DataFrame], location: str, internal=("risk_profile",)
) -> None:
    """One CSV folder with header per table, without the ``internal`` columns."""
    for name, df in tables.items():
        (
            df.drop(*internal)
            .write.mode("overwrite")
            .options(**CSV_OPTIONS)
            .csv(f"{location}/{name}.csv")
        )


#: the partition column of tables with one snapshot a day
SNAPSHOT_DAYS = {"health_scores": "score_date", "csm_workload": "run_date"}


def put_result(
    commit: Commit,
    name: str,
    rows: DataFrame,
    day: date | None = None,
    figures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write a result table as part of ``commit``; returns the rows as written.

    A table with one snapshot a day gets that of ``day`` replaced, which is empty afterwards if
    there are no rows; the others keep theirs. Any other table is refreshed as a whole.
    ``figures`` are aggregates observed on the way, left in ``commit.figures``.
    """
    rows = conform(rows, schemas.RESULT_SCHEMAS[name])
    if name in SNAPSHOT_DAYS:
        return commit.replace_day(name, rows, SNAPSHOT_DAYS[name], day, figures)
    return commit.refresh(name, rows, figures)


def write_health_scores(scores: DataFrame, root: str, day: date) -> None:
    """Replace the snapshot of ``day``, keep the others."""
    with Commit(scores.sparkSession, root) as commit:
        put_result(commit, "health_scores", scores, day)


def write_csm_workload(workload: DataFrame, root: str, day: date) -> None:
    """Replace the workload of ``day``, keep the others."""
    with Commit(workload.sparkSession, root) as commit:
        put_result(commit, "csm_workload", workload, day)


def write_action_center(actions: DataFrame, root: str) -> None:
    """Full refresh of the queue."""
    with Commit(actions.sparkSession, root) as commit:
        put_result(commit, "action_center", actions)


def append_run(
    spark: SparkSession,
    root: str,
    started_at: datetime,
    completed_at: datetime,
    status: str,
    summary: Mapping | None = None,
    error_message: str | None = None,
) -> None:
    """Add one audit row; a failed run has no metrics.

    Its key is a number no other run gets, also one that ends at the same moment.
    """
    summary = summary or {}
    run_id = next_number(spark, root, "automation_runs")
    given = {
        "run_id": F.lit(run_id),
        "run_started_at": F.lit(started_at.isoformat(" ")),
        "run_completed_at": F.lit(completed_at.isoformat(" ")),
        "status": F.lit(status),
        "error_message": F.lit(error_message),
    }
    row = spark.range(1).select(
        *[
            given.get(name, F.lit(summary.get(name))).cast(kind).alias(name)
            for name, kind in schemas.AUTOMATION_RUNS.items()
        ]
    )
    with Commit(spark, root) as commit:
        commit.append("automation_runs", row, str(run_id))


def write_digest(lines: DataFrame, path: str) -> None:
    """The digest as one text file, in document order.

    Sorted and written by the cluster as ordered parts, which are then copied on end to
    ``path``; the file is replaced when it is complete.
    """
    ordered = lines.orderBy("block", "sort_value", "account_id").select("line")
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    try:
        ordered.write.text(parts)
        join_parts(lines.sparkSession, parts, path)
    finally:
        remove(lines.sparkSession, parts)
