from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from heartwood.sources import readers, schemas, writers


def raw(frames):
    return {
        "accounts": frames.table(
            "accounts",
            {"account_id": 1, "company_name": ' A, "B" \\ ', "contract_value": "12.50",
             "start_date": "2024-01-31"},
            {"account_id": 2, "company_name": None},
        ),
        "support_tickets": frames.table(
            "support_tickets",
            {"ticket_id": 1, "account_id": 1, "created_date": "2024-01-01 10:20:30",
             "sla_hours": 8, "status": "Open"},
        ),
    }


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def test_csv_round_trip_without_internal_columns(spark, frames, tmp_path):
    tables = raw(frames)
    tables["accounts"] = tables["accounts"].withColumn("risk_profile", F.lit("high"))
    writers.export_csv(tables, str(tmp_path))
    back = readers.load_tables(spark, str(tmp_path), "csv", optional=True)
    assert sorted(back) == ["accounts", "support_tickets"]
    assert same(back["accounts"], tables["accounts"].drop("risk_profile"))
    assert same(back["support_tickets"], tables["support_tickets"])
    types = dict(back["support_tickets"].dtypes)
    assert types == schemas.SUPPORT_TICKETS


def test_csv_written_elsewhere(spark, tmp_path):
    (tmp_path / "surveys.csv").write_text(
        "survey_id,account_id,survey_date,csat_score,nps_score,feedback_category\n"
        "1,7,2024-02-03,88.25,-20,Support\n2,7,,,,\n"
    )
    (tmp_path / "customer_success.csv").write_text(
        ",".join(schemas.CUSTOMER_SUCCESS) + "\n"
        "7,x,2024-01-01 08:00:00,2024-01-02,Complete,,,plan,\n"
    )
    tables = readers.load_tables(spark, str(tmp_path), "csv", optional=True)
    first, second = tables["surveys"].orderBy("survey_id").collect()
    assert (str(first.survey_date), float(first.csat_score), first.nps_score) == (
        "2024-02-03", 88.25, -20,
    )
    assert second.survey_date is None and second.nps_score is None
    handoff = tables["customer_success"].first()
    assert handoff.handoff_created_at == datetime(2024, 1, 1, 8)
    assert handoff.handoff_accepted_at == datetime(2024, 1, 2)
    assert handoff.onboarding_started_at is None


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "accounts.csv").write_text(
        "contract_value,risk_profile,company_name,account_id\n"
        '1.50,high,"A ""B"", C ",3\n'
    )
    accounts = readers.load_tables(spark, str(tmp_path), "csv", optional=True)["accounts"]
    row = accounts.first()
    assert (row.account_id, row.company_name, float(row.contract_value)) == (3, 'A "B", C ', 1.5)
    assert row.risk_profile == "high"
    assert "region" not in accounts.columns


def test_csv_headers_of_a_folder_have_to_agree(spark, tmp_path):
    folder = tmp_path / "renewals.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("renewal_id,account_id\n1,2\n")
    (folder / "b.csv").write_text("renewal_id,account_id\n3,4\n")
    renewals = readers.load_tables(spark, str(tmp_path), "csv", optional=True)["renewals"]
    assert sorted((r.renewal_id, r.account_id) for r in renewals.collect()) == [(1, 2), (3, 4)]
    assert renewals.select("account_id").count() == 2
    (folder / "c.csv").write_text("account_id,renewal_id\n5,6\n")
    renewals = readers.load_tables(spark, str(tmp_path), "csv", optional=True)["renewals"]
    with pytest.raises(Exception, match="(?i)header"):
        renewals.collect()


def test_malformed_csv_stops_the_read(spark, tmp_path):
    (tmp_path / "surveys.csv").write_text(
        "survey_id,account_id,survey_date,csat_score,nps_score,feedback_category\n"
        "1,7,2024-02-03,many,0,Support\n"
    )
    tables = readers.load_tables(spark, str(tmp_path), "csv", optional=True)
    with pytest.raises(Exception, match="MALFORMED"):
        tables["surveys"].collect()


def test_a_required_table_has_to_exist(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.load_tables(spark, str(tmp_path))


def test_reload_is_idempotent_and_empties_missing_tables(spark, frames, tmp_path):
    root = str(tmp_path)
    tables = raw(frames)
    writers.reload_tables(spark, tables, root)
    writers.reload_tables(spark, tables, root)
    back = readers.load_tables(spark, root)
    assert sorted(back) == sorted(schemas.RAW_SCHEMAS)
    assert same(back["accounts"], tables["accounts"])
    assert back["renewals"].count() == 0
    writers.reload_tables(spark, {"accounts": tables["accounts"]}, root)
    assert readers.load_tables(spark, root)["support_tickets"].count() == 0


def test_catalog_tables(spark, frames):
    tables = raw(frames)
    spark.sql("CREATE DATABASE IF NOT EXISTS heartwood_test")
    narrow = tables["accounts"].withColumn("account_id", F.col("account_id").cast("int"))
    narrow.write.mode("overwrite").saveAsTable("heartwood_test.accounts")
    try:
        back = readers.load_tables(spark, "heartwood_test", "table", optional=True)
        assert same(back["accounts"], tables["accounts"])
        assert dict(back["accounts"].dtypes) == schemas.ACCOUNTS
    finally:
        spark.sql("DROP DATABASE heartwood_test CASCADE")


def scores(frames, day, *overall):
    return frames.table(
        "health_scores",
        *[{"account_id": i, "score_date": day, "overall_score": v} for i, v in enumerate(overall)],
    )


def test_scores_are_replaced_by_date(spark, frames, tmp_path):
    root = str(tmp_path)
    may, june = date(2024, 5, 1), date(2024, 6, 1)
    writers.write_health_scores(scores(frames, "2024-05-01", 1, 2, 3), root, may)
    writers.write_health_scores(scores(frames, "2024-06-01", 4), root, june)
    writers.write_health_scores(scores(frames, "2024-06-01", 5, 6), root, june)
    back = readers.read_result(spark, root, "health_scores")
    assert sorted(float(r.overall_score) for r in back.collect()) == [1, 2, 3, 5, 6]
    # the day is written again without rows
    writers.write_health_scores(scores(frames, "2024-06-01"), root, june)
    back = readers.read_result(spark, root, "health_scores")
    assert back.filter("score_date = '2024-06-01'").count() == 0
    assert sorted(float(r.overall_score) for r in back.collect()) == [1, 2, 3]


def test_actions_are_refreshed_and_workload_replaced_by_date(spark, frames, tmp_path):
    root = str(tmp_path)
    for ids in ([1, 2, 3], [4]):
        actions = frames.table("action_center", *[{"action_id": i} for i in ids])
        writers.write_action_center(actions, root)
    assert [r.action_id for r in readers.read_result(spark, root, "action_center").collect()] == [4]
    for day, owner in (("2024-05-01", "x"), ("2024-06-01", "y"), ("2024-06-01", "z")):
        row = {"csm_owner": owner, "run_date": day, "workload_score": "123456789.5",
               "open_tickets": 2**40}
        writers.write_csm_workload(
            frames.table("csm_workload", row), root, date.fromisoformat(day)
        )
    back = readers.read_result(spark, root, "csm_workload")
    assert (float(back.first().workload_score), back.first().open_tickets) == (123456789.5, 2**40)
    assert sorted(r.csm_owner for r in back.collect()) == ["x", "z"]
    writers.write_csm_workload(frames.table("csm_workload"), root, date(2024, 6, 1))
    back = readers.read_result(spark, root, "csm_workload")
    assert [r.csm_owner for r in back.collect()] == ["x"]


def test_database_reads_are_split_by_table():
    bounds = {"numPartitions": 64, "lowerBound": 0, "upperBound": 10**9}
    options = {"url": "jdbc:x", "partitions": {name: bounds for name in schemas.RAW_SCHEMAS}}
    options["partitions"]["surveys"] = {**bounds, "partitionColumn": "account_id"}
    for name, columns in schemas.RAW_SCHEMAS.items():
        got = readers.jdbc_options(name, options)
        key = "account_id" if name == "surveys" else next(iter(columns))
        assert got == {"preferTimestampNTZ": True, "url": "jdbc:x", "dbtable": name,
                       "partitionColumn": key, **bounds}
    for broken in ({"url": "x"}, {"partitions": {"accounts": {"numPartitions": 4}}}):
        with pytest.raises(ValueError, match="accounts"):
            readers.jdbc_options("accounts", broken)


def test_absent_database_tables_are_recognised():
    assert readers._is_absent(Exception('PSQLException: relation "x" does not exist'))
    assert readers._is_absent(Exception("SQLSyntaxErrorException: Table 'd.x' doesn't exist"
                                        " java.sql.SQLException"))
    assert not readers._is_absent(Exception("java.sql.SQLException: connection refused"))
    assert not readers._is_absent(Exception("file does not exist"))


def test_audit_rows_are_appended(spark, tmp_path):
    root = str(tmp_path)
    start, end = datetime(2024, 6, 1, 6), datetime(2024, 6, 1, 6, 5, 1, 7)
    summary = {"data_quality_score": 93.5, "total_accounts": 4, "healthy_count": 1,
               "monitor_count": 1, "at_risk_count": 1, "critical_count": 1,
               "action_items_created": 3, "overloaded_csm_count": 2, "score_date": "2024-06-01"}
    writers.append_run(spark, root, start, end, "Success", summary)
    writers.append_run(spark, root, datetime(2024, 6, 2), end, "Failed", error_message="it's broken")
    good, bad = readers.read_result(spark, root, "automation_runs").orderBy("run_id").collect()
    assert (good.status, float(good.data_quality_score), good.action_items_created) == (
        "Success", 93.5, 3,
    )
    assert (good.run_started_at, good.run_completed_at) == (start, end)
    assert good.error_message is None
    assert (bad.status, bad.error_message) == ("Failed", "it's broken")
    assert bad.total_accounts is None and bad.data_quality_score is None


def test_long_digest_keeps_its_order_over_parts(spark, tmp_path):
    n = 5000
    lines = spark.range(n).select(
        (F.col("id") % 5).cast("int").alias("block"),
        (F.col("id") * 7919 % 101).cast("double").alias("sort_value"),
        F.col("id").alias("account_id"),
        F.concat_ws(" ", F.col("id") % 5, F.col("id") * 7919 % 101, "id").alias("line"),
    )
    path = tmp_path / "digest"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_digest(lines.repartition(3), str(path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [tuple(map(int, line.split())) for line in path.read_text().splitlines()]
    assert got == sorted((i % 5, i * 7919 % 101, i) for i in range(n))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["digest"]
