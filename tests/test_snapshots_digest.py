import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract.registered import registered_queries
from heartwood.operators import snapshots
from heartwood.operators.digest import digest_lines
from heartwood.sources.readers import read_result
from heartwood.sources.star_binding import STAR_SCHEMAS
from heartwood.sources.writers import write_health_scores
from tests.conftest import as_dict

AS_OF = datetime(2024, 6, 1)
SUMMARY = (
    "data_quality_score double, total_accounts int, healthy_count int, monitor_count int,"
    " at_risk_count int, critical_count int, action_items_created int"
)


@pytest.fixture(scope="module")
def history(frames):
    def row(account, day, overall, status):
        return {"account_id": account, "score_date": day, "overall_score": overall,
                "health_status": status, "risk_drivers": f"d{account}"}

    return frames.table(
        "health_scores",
        row(1, "2024-04-01", 10, "Critical"),
        row(1, "2024-05-01", 54.5, "At Risk"), row(1, "2024-06-01", 44.5, "Critical"),
        row(2, "2024-05-01", 40, "Critical"), row(2, "2024-06-01", 30.01, "Critical"),
        row(3, "2024-05-01", 90, "Healthy"), row(3, "2024-06-01", 70, "Monitor"),
        row(4, "2024-06-01", 20, "Critical"),
        row(5, "2024-05-01", 90, "Healthy"),
    )


@pytest.fixture(scope="module")
def accounts(frames):
    return frames.table(
        "accounts", *[{"account_id": i, "company_name": n} for i, n in ((1, "A"), (3, "C"))]
    )


def test_last_two_snapshots(history):
    dates = [r.score_date for r in snapshots.last_two_dates(history).collect()]
    assert dates == [date(2024, 6, 1), date(2024, 5, 1)]
    current, previous = snapshots.current_and_previous_scores(history)
    assert sorted(r.account_id for r in current.collect()) == [1, 2, 3, 4]
    assert sorted(r.account_id for r in previous.collect()) == [1, 2, 3, 5]


def test_stored_history_is_pruned_to_the_two_dates(spark, history, tmp_path):
    for row in history.select("score_date").distinct().collect():
        write_health_scores(history, str(tmp_path), row.score_date)
    stored = read_result(spark, str(tmp_path), "health_scores")
    dates = (F.lit(date(2024, 6, 1)), F.lit(date(2024, 5, 1)))
    for known in (dates, None):
        for snapshot in snapshots.current_and_previous_scores(stored, known):
            plan = snapshot._jdf.queryExecution().executedPlan().toString()
            scan = plan[: plan.index("FileScan") + 2000]
            assert "score_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
            assert snapshot.count() == 4


def test_first_run_has_no_previous_snapshot(history):
    only = history.filter("score_date = '2024-06-01'")
    current, previous = snapshots.current_and_previous_scores(only)
    assert (current.count(), previous.count()) == (4, 0)
    new = snapshots.find_newly_critical(current, previous)
    assert sorted(r.account_id for r in new.collect()) == [1, 2, 4]
    assert snapshots.find_score_drops(current, previous).count() == 0


def test_changes(history):
    current, previous = snapshots.current_and_previous_scores(history)
    new = snapshots.find_newly_critical(current, previous)
    assert sorted(r.account_id for r in new.collect()) == [1, 4]
    drops = snapshots.find_score_drops(current, previous).collect()
    # 10 is a drop, 9.99 is not
    assert [(r.account_id, r["drop"]) for r in drops] == [(3, 20.0), (1, 10.0)]
    ids = snapshots.changed_accounts(new, snapshots.find_score_drops(current, previous))
    assert sorted(r.account_id for r in ids.collect()) == [1, 3, 4]


def action(i, due, status="Open", **values):
    return {"action_id": i, "account_id": i, "due_date": due, "status": status,
            "risk_level": "Critical", "recommended_action": "act", **values}


def test_pairs_give_the_same_as_two_snapshots(history):
    current, previous = snapshots.current_and_previous_scores(history)
    pairs = snapshots.pair_snapshots(
        history, F.lit(date(2024, 6, 1)), F.lit(date(2024, 5, 1))
    )
    for one, two in (
        (snapshots.find_newly_critical(current, previous), snapshots.newly_critical_in(pairs)),
        (snapshots.find_score_drops(current, previous), snapshots.score_drops_in(pairs)),
    ):
        assert set(one.columns) <= set(two.columns)
        assert sorted(map(str, one.collect())) == sorted(
            map(str, two.select(*one.columns).collect())
        )


def test_urgent_actions(frames):
    accounts = frames.table("accounts", *[{"account_id": i, "company_name": "N"} for i in range(6)])
    actions = frames.table(
        "action_center",
        action(1, "2024-06-03"), action(2, "2024-06-04"), action(3, "2024-01-01"),
        action(4, "2024-06-01", "Done"), action(99, "2024-06-01"),
    )
    got = [r.account_id for r in snapshots.urgent_action_items(actions, accounts, AS_OF).collect()]
    assert got == [3, 1]
    later = snapshots.urgent_action_items(actions, accounts, AS_OF, days_ahead=3)
    assert later.count() == 3


def test_names_of_known_accounts(frames, accounts):
    ids = frames.of("account_id bigint", (1,), (9,))
    assert as_dict(snapshots.account_names(accounts, ids), "account_id", "company_name") == {1: "A"}


def lines(frames, history, accounts, actions, previous_date):
    current, previous = snapshots.current_and_previous_scores(history)
    summary = frames.of(SUMMARY, (93.5, 4, 0, 1, 0, 3, 7))
    df = digest_lines(
        summary,
        snapshots.find_newly_critical(current, previous),
        snapshots.find_score_drops(current, previous),
        snapshots.urgent_action_items(actions, accounts, AS_OF),
        accounts,
        F.lit(date(2024, 6, 1)),
        F.lit(previous_date).cast("date"),
    )
    return [r.line for r in df.orderBy("block", "sort_value", "account_id").collect()]


def test_digest(frames, history, accounts):
    actions = frames.table("action_center", action(3, "2024-06-02"), action(1, "2024-06-01", owner="x"))
    assert lines(frames, history, accounts, actions, date(2024, 5, 1)) == [
        "# Customer Success Daily Digest — 2024-06-01",
        "",
        "Compared against previous run: 2024-05-01",
        "",
        "## Summary",
        "- Data Quality Score: **93.5/100**",
        "- Total accounts: 4",
        "- Healthy: 0 · Monitor: 1 · At Risk: 0 · Critical: 3",
        "- Open action items: 7",
        "",
        "## Newly Critical Accounts",
        "- **A** (score 44) — d1",
        "- **Account 4** (score 20) — d4",
        "",
        "## Accounts With Significant Score Drops (>10 pts)",
        "- **C**: 90 -> 70 (-20)",
        "- **A**: 54 -> 44 (-10)",
        "",
        "## Action Items Due in the Next 2 Days",
        "- **A** (Critical) — act — owner: x — due 2024-06-01",
        "- **C** (Critical) — act — owner: None — due 2024-06-02",
        "",
    ]


def test_digest_of_a_quiet_first_run(frames, history, accounts):
    quiet = history.filter("account_id = 3 AND score_date = '2024-06-01'")
    got = lines(frames, quiet, accounts, frames.table("action_center"), None)
    assert got[2] == "Compared against previous run: none (first run)"
    assert got[10:] == [
        "## Newly Critical Accounts",
        "- None. No accounts newly entered Critical status since the last run.",
        "",
        "## Accounts With Significant Score Drops (>10 pts)",
        "- None.",
        "",
        "## Action Items Due in the Next 2 Days",
        "- None.",
        "",
    ]


def test_changed_accounts_scores_once(spark, tmp_path):
    """Both lists go on from stored snapshots: the plan of the ids reads no ticket or usage row,
    so no task carries out the scoring plan for each of them."""
    r = random.Random(3)
    day = datetime(2001, 1, 1)
    orders = [
        (i, r.choice([None, *range(40)]), r.choice("FOP"), r.uniform(1e3, 5e5),
         day + timedelta(days=r.randrange(220)), r.choice(["1-URGENT", "2-HIGH", "5-LOW"]))
        for i in range(400)
    ]
    rows = {
        "customer": [(i, f"c{i}", i % 3, 10.0, "S") for i in range(40)],
        "orders": orders,
        "lineitem": [
            (i, 1, 1, k, float(r.randrange(1, 99)), 5.0, 0.0, 0.0, "R", "F", x[4] + timedelta(days=9))
            for i, x in enumerate(orders) for k in range(2)
        ],
        "events": [
            (i, day + timedelta(days=r.randrange(200)), r.randrange(40), "view", r.uniform(0, 99), "")
            for i in range(400)
        ],
        "supplier": [(1, "s", 1, 0.0)],
        "nation": [(i, f"n{i}", 0) for i in range(3)],
        "region": [(0, "r")],
    }
    for name, some in rows.items():
        spark.createDataFrame(some, STAR_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    queries = registered_queries()
    changed = queries["changed_accounts"](spark, str(tmp_path))
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "user_id" not in plan
    ids = [
        {x.account_id for x in queries[q](spark, str(tmp_path)).collect()}
        for q in ("newly_critical", "score_drops")
    ]
    got = [tuple(x) for x in changed.collect()]
    assert sorted(got) == [(i, f"c{i}") for i in sorted(ids[0] | ids[1])]
    assert got
