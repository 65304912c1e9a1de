from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heartwood.operators.actions import build_action_center
from heartwood.operators.workload import (
    add_next_renewal,
    categorise_workload,
    compute_csm_workload,
)
from tests.conftest import as_dict

AS_OF = datetime(2024, 6, 1, 15, 30)
SCORES = "account_id bigint, health_status string, risk_drivers string"


def test_action_center(frames):
    scores = frames.of(
        SCORES,
        (1, "Critical", "a"), (2, "At Risk", "b"), (3, "Monitor", "c"), (4, "Healthy", "d"),
        (5, "At Risk", "e"), (6, "Monitor", "f"), (7, "At Risk", "g"), (8, "Unknown", "h"),
    )
    renewal = {1: "2024-06-01", 2: "2024-07-31", 3: "2024-08-01", 5: "2024-05-31", 7: "2024-06-30"}
    accounts = frames.table(
        "accounts",
        *[{"account_id": i, "csm_owner": f"o{i}", "renewal_date": renewal.get(i)}
          for i in (1, 2, 3, 4, 5, 7, 8)],
    )
    rows = {r.account_id: r for r in build_action_center(scores, accounts, AS_OF).collect()}
    assert sorted(rows) == [1, 2, 3, 5, 6, 7]
    assert rows[1].recommended_action == (
        "CSM intervention required within 48 hours (renewal in 0 days)"
    )
    assert rows[1].due_date == date(2024, 6, 3)
    assert rows[2].recommended_action == (
        "Schedule account review call this week (renewal in 60 days)"
    )
    assert rows[2].due_date == date(2024, 6, 3)
    assert rows[3].recommended_action == "Add to weekly watchlist review"
    assert rows[3].due_date == date(2024, 6, 15)
    assert rows[5].due_date == date(2024, 6, 6)  # renewal passed yesterday
    assert rows[6].owner is None  # unknown account
    assert rows[7].owner == "o7"
    assert {r.status for r in rows.values()} == {"Open"}
    assert rows[7].reason == "g"
    assert rows[7].created_at == AS_OF


def test_add_next_renewal(frames):
    accounts = frames.table(
        "accounts", {"account_id": 1, "renewal_date": "2023-05-01"}, {"account_id": 2}
    )
    rows = {r.account_id: r for r in add_next_renewal(accounts, AS_OF).collect()}
    assert rows[1].days_to_next_renewal == 333  # 397 days back, two cycles
    assert rows[2].days_to_next_renewal is None


def workload(frames, statuses, days=None, open_tickets=(), owners=None):
    n = len(statuses)
    accounts = frames.of(
        "account_id bigint, csm_owner string, days_to_next_renewal int",
        *[(i, (owners or ["x"] * n)[i], (days or [999] * n)[i]) for i in range(n)],
    )
    scores = frames.of(SCORES, *[(i, s, "") for i, s in enumerate(statuses)])
    tickets = frames.of("account_id bigint, status string", *open_tickets)
    return compute_csm_workload(scores, accounts, tickets)


def test_workload_counts_and_points(frames):
    df = workload(
        frames,
        ["At Risk", "Critical", "Healthy", "Critical", "Critical"],
        days=[0, 60, 61, None, 5],
        open_tickets=[(0, "Open"), (0, "Open"), (1, "Resolved"), (4, "Open"), (99, "Open")],
        owners=["x", "x", "x", "y", None],
    )
    rows = df.collect()
    assert [r.csm_owner for r in rows] == ["x", "y"]
    x = rows[0]
    assert (x.total_accounts, x.at_risk_accounts, x.critical_accounts) == (3, 1, 1)
    assert (x.open_tickets, x.upcoming_renewals) == (2, 2)
    assert x.workload_score == 3 + 2 + 3 + 1 + 3
    assert rows[1].workload_score == 4.0


def test_workload_rises_with_one_more_critical_account(frames):
    base = workload(frames, ["Healthy"] * 10).first().workload_score
    worse = workload(frames, ["Critical"] + ["Healthy"] * 9).first().workload_score
    assert worse > base


def test_upcoming_renewals_from_another_frame(frames):
    accounts = frames.of("account_id bigint, csm_owner string", (1, "x"), (2, "x"))
    scores = frames.of(SCORES, (1, "Healthy", ""), (2, "Healthy", ""))
    tickets = frames.of("account_id bigint, status string")
    upcoming = frames.of(
        "account_id bigint, days_to_next_renewal int", (1, 3), (1, 5), (2, 400)
    )
    listed = compute_csm_workload(scores, accounts, tickets, upcoming)
    assert listed.first().upcoming_renewals == 1
    unlisted = compute_csm_workload(scores, accounts, tickets, upcoming.select("account_id"))
    assert unlisted.first().upcoming_renewals == 0


@pytest.mark.parametrize(
    "scores, categories",
    [
        (
            range(1, 9),
            ["Balanced"] * 2 + ["Elevated"] * 2 + ["High"] * 2 + ["Overloaded"] * 2,
        ),
        ([29, 29, 30, 31, 57], ["Balanced"] * 3 + ["Overloaded"] * 2),
        ([7], ["Balanced"]),
        ([], []),
    ],
)
def test_categories(frames, scores, categories):
    df = frames.of("id int, workload_score double", *[(i, float(s)) for i, s in enumerate(scores)])
    got = as_dict(categorise_workload(df), "id", "workload_category")
    assert [got[i] for i in range(len(categories))] == categories


def test_owner_with_a_third_of_all_accounts(spark):
    n = 90_000
    accounts = spark.range(n).select(
        F.col("id").alias("account_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("o"), (F.col("id") % 50).cast("string")))
        .alias("csm_owner"),
        F.lit(10).alias("days_to_next_renewal"),
    )
    scores = spark.range(n).select(
        F.col("id").alias("account_id"), F.lit("Critical").alias("health_status")
    )
    tickets = spark.range(n * 2).select(
        (F.col("id") % 10).alias("account_id"), F.lit("Open").alias("status")
    )
    hot = compute_csm_workload(scores, accounts, tickets).first()
    assert (hot.csm_owner, hot.total_accounts, hot.workload_category) == ("hot", 30_000, "Overloaded")
    assert hot.open_tickets == 4 * n * 2 // 10  # accounts 0, 3, 6 and 9
