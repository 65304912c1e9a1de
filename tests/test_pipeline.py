from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from heartwood.operators.views import register_views
from heartwood.plans.automation_run import generate_digest, run_once
from heartwood.plans.scoring_run import run_pipeline
from heartwood.sources.readers import load_tables, read_result
from heartwood.sources.writers import reload_tables

FIRST, SECOND = datetime(2024, 5, 1), datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def tables(spark, frames, tmp_path_factory):
    def rows(name, *given):
        return frames.table(name, *given)

    accounts = [
        {"account_id": i, "company_name": f"C{i}", "csm_owner": f"o{i % 3}",
         "account_status": "Active", "contract_value": 100 * i, "start_date": "2023-01-01",
         "renewal_date": f"2024-06-{10 + i}", "segment": "SMB"}
        for i in range(1, 9)
    ]
    tickets = [
        {"ticket_id": 10 * i + j, "account_id": i, "priority": "Critical", "status": "Open",
         "created_date": "2024-05-02 00:00:00", "sla_hours": 8}
        for i in (1, 2) for j in range(7)
    ]
    surveys = [
        {"survey_id": i, "account_id": i, "survey_date": "2024-05-10", "csat_score": 10 * i,
         "nps_score": -100 if i < 3 else 100}
        for i in range(1, 9)
    ]
    given = {
        "accounts": rows("accounts", *accounts),
        "support_tickets": rows("support_tickets", *tickets),
        "surveys": rows("surveys", *surveys),
        "renewals": rows("renewals", {"renewal_id": 1, "account_id": 1, "renewal_status": "Churned"}),
    }
    location = str(tmp_path_factory.mktemp("raw"))
    reload_tables(spark, given, location)
    return load_tables(spark, location)


def test_two_runs_then_digest_and_views(spark, tables, tmp_path):
    root = str(tmp_path)
    early = {**tables, "support_tickets": tables["support_tickets"].limit(0),
             "surveys": tables["surveys"].limit(0)}
    first = run_once(spark, early, root, FIRST)
    assert (first["total_accounts"], first["critical_count"]) == (8, 0)
    second = run_once(spark, tables, root, SECOND)
    assert second["score_date"] == "2024-06-01"
    assert second["critical_count"] == 2
    assert second["data_quality_score"] == 100.0
    counts = [second[f"{s}_count"] for s in ("healthy", "monitor", "at_risk", "critical")]
    assert sum(counts) == second["total_accounts"] == 8
    assert second["action_items_created"] == 8 - second["healthy_count"]

    history = read_result(spark, root, "health_scores")
    assert history.groupBy("score_date").count().count() == 2
    actions = read_result(spark, root, "action_center")
    assert actions.count() == second["action_items_created"]
    runs = read_result(spark, root, "automation_runs").collect()
    assert [r.status for r in runs] == ["Success"] * 2

    text = (Path(root) / "reports" / "digest_2024-06-01.md").read_text().splitlines()
    assert text[0] == "# Customer Success Daily Digest — 2024-06-01"
    assert text[2] == "Compared against previous run: 2024-05-01"
    assert sum(line.startswith("- **C") for line in text) >= 4
    assert text[text.index("## Newly Critical Accounts") + 1].startswith("- **C1** (score ")

    workload = read_result(spark, root, "csm_workload")
    register_views(tables, history, actions, workload, SECOND)
    assert spark.table("vw_account_health").count() == 8
    assert spark.table("vw_ticket_sla").filter("sla_breached").count() == 14
    assert spark.table("vw_csm_workload_latest").count() == 3
    assert spark.table("vw_csm_performance").agg(F.sum("critical_accounts")).first()[0] == 2
    assert spark.table("vw_action_center").count() == actions.count()
    assert spark.table("vw_latest_survey").count() == 8
    assert spark.table("vw_usage_trend").count() == 0
    owned = spark.sql(
        "SELECT account_id FROM vw_account_health WHERE csm_owner = :owner AND account_id = :id",
        args={"owner": "o1", "id": 4},
    )
    assert owned.count() == 1


def test_rerun_of_a_day_replaces_it(spark, tables, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        run_pipeline(spark, tables, root, SECOND).collect()
    assert read_result(spark, root, "health_scores").count() == 8
    assert read_result(spark, root, "csm_workload").count() == 3


def test_standalone_digest(spark, tables, tmp_path):
    root = str(tmp_path)
    run_pipeline(spark, tables, root, SECOND)
    path = generate_digest(spark, tables["accounts"], root, SECOND)
    text = Path(path).read_text().splitlines()
    assert text[2] == "Compared against previous run: none (first run)"
    assert text[5] == "- Data Quality Score: **N/A (standalone run)/100**"


def test_failed_run_is_recorded_and_raised(spark, tables, tmp_path):
    root = str(tmp_path)
    broken = {name: df for name, df in tables.items() if name != "surveys"}
    times = iter([datetime(2024, 6, 1, 6), datetime(2024, 6, 1, 7)])
    with pytest.raises(KeyError):
        run_once(spark, broken, root, SECOND, clock=lambda: next(times))
    row = read_result(spark, root, "automation_runs").first()
    assert (row.status, row.total_accounts) == ("Failed", None)
    assert row.run_completed_at == datetime(2024, 6, 1, 7)
    assert "surveys" in row.error_message


def test_digest_without_scores(spark, frames, tmp_path):
    frames.table("health_scores").write.partitionBy("score_date").parquet(
        str(tmp_path / "health_scores")
    )
    with pytest.raises(RuntimeError, match="no health scores"):
        generate_digest(spark, frames.table("accounts"), str(tmp_path), SECOND)
