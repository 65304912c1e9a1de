from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from heartwood.operators import measures, validation, views
from heartwood.operators.grouping import left_join_many
from tests.conftest import as_dict

AS_OF = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def accounts(frames):
    return frames.table(
        "accounts",
        {"account_id": 1, "company_name": "A", "csm_owner": "x", "segment": "SMB",
         "region": "EU", "industry": "Retail", "account_status": "Active",
         "contract_value": "10.00", "renewal_date": "2024-06-11"},
        {"account_id": 2, "company_name": "B", "csm_owner": "x", "segment": "SMB",
         "region": "US", "industry": "Retail", "account_status": "Churned",
         "contract_value": "5.50", "renewal_date": "2024-05-31"},
        {"account_id": 3, "company_name": "C", "csm_owner": None, "segment": "Enterprise",
         "region": "EU", "industry": "Bank", "account_status": "Active",
         "contract_value": "1.00"},
    )


@pytest.fixture(scope="module")
def scores(frames):
    def row(account, day, overall, status):
        return {"account_id": account, "score_date": day, "overall_score": overall,
                "csat_score": overall, "nps_score": overall, "health_status": status}

    return frames.table(
        "health_scores",
        row(1, "2024-05-01", 90, "Healthy"),
        row(1, "2024-06-01", 40.25, "Critical"),
        row(2, "2024-05-01", 50.15, "At Risk"),
    )


@pytest.fixture(scope="module")
def renewals(frames):
    def row(i, account, status):
        return {"renewal_id": i, "account_id": account, "renewal_status": status,
                "renewal_value": 7}

    return frames.table(
        "renewals", row(1, 1, "Renewed"), row(2, 1, "Churned"), row(3, 3, "Renewed"),
        row(4, None, "Renewed"), row(5, 99, "Pending"),
    )


@pytest.fixture(scope="module")
def tickets(frames):
    def row(i, account, status, resolved=None):
        return {"ticket_id": i, "account_id": account, "status": status, "priority": "Low",
                "created_date": "2024-05-01 00:00:00", "resolved_date": resolved, "sla_hours": 24}

    return frames.table(
        "support_tickets", row(1, 1, "Open"), row(2, 1, "Open"),
        row(3, 1, "Resolved", "2024-05-01 10:30:00"), row(4, 9, "Open"),
    )


@pytest.fixture(scope="module")
def rows_of_health(accounts, scores, renewals):
    return views.account_health(accounts, scores, renewals, AS_OF)


@pytest.fixture(scope="module", params=["rows", "counted"])
def health(request, accounts, scores, renewals):
    make = {"rows": views.account_health, "counted": views.account_health_counted}
    return make[request.param](accounts, scores, renewals, AS_OF)


def test_left_join_many_equals_a_left_join(frames):
    left = frames.of("k bigint, a string", (1, "p"), (1, "q"), (2, "r"), (None, "s"), (3, "t"))
    right = frames.of("k bigint, b string", (1, "u"), (1, "v"), (None, "w"), (9, "x"), (3, None))
    expected = left.join(right, "k", "left").select("k", "a", "b").collect()
    got = left_join_many(left, right, "k", left).select("k", "a", "b").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_account_health(rows_of_health):
    rows = rows_of_health.collect()
    assert len(rows) == 4  # account 1 has two renewals
    first = [r for r in rows if r.account_id == 1]
    assert {r.renewal_status for r in first} == {"Renewed", "Churned"}
    assert {(r.score_date, r.health_status) for r in first} == {(date(2024, 6, 1), "Critical")}
    assert {(r.days_to_renewal, r.days_to_next_renewal) for r in first} == {(10, 10)}
    second = next(r for r in rows if r.account_id == 2)
    assert (second.renewal_status, second.days_to_renewal) == (None, -1)
    assert (second.next_renewal_date, second.days_to_next_renewal) == (date(2025, 5, 31), 364)
    third = next(r for r in rows if r.account_id == 3)
    assert (third.overall_score, third.renewal_status, third.days_to_renewal) == (
        None, "Renewed", None,
    )


def test_counted_rows_stand_for_the_view(frames, accounts, scores):
    many = frames.table(
        "renewals",
        *[{"renewal_id": i, "account_id": a, "renewal_status": s}
          for i, (a, s) in enumerate([(1, "Renewed")] * 3 + [(1, None), (2, "Churned"), (9, "Renewed")])],
    )
    columns = ["account_id", "overall_score", "renewal_status", "days_to_next_renewal"]
    expected = views.account_health(accounts, scores, many, AS_OF).groupBy(columns).count()
    counted = views.account_health_counted(accounts, scores, many, AS_OF)
    got = counted.select(*columns, F.col("view_rows").alias("count"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_ticket_sla(tickets, accounts):
    rows = {r.ticket_id: r for r in views.ticket_sla(tickets, accounts, AS_OF).collect()}
    assert sorted(rows) == [1, 2, 3]  # ticket 4 has no account
    assert (rows[1].age_or_resolution_hours, rows[1].sla_breached) == (744.0, True)
    assert (rows[3].age_or_resolution_hours, rows[3].sla_breached) == (10.5, False)
    assert rows[3].csm_owner == "x"


def test_usage_trend_and_sessions(frames, accounts):
    usage = frames.table(
        "product_usage",
        {"account_id": 1, "usage_date": "2024-01-01", "sessions": 3},
        {"account_id": 2, "usage_date": "2024-01-01", "sessions": 4},
        {"account_id": 77, "usage_date": "2024-01-01", "sessions": 5},
    )
    trend = views.usage_trend(usage, accounts)
    assert trend.count() == 2
    assert measures.sessions_over_time(trend).first().sessions == 7
    assert measures.sessions_over_time(trend, 2).first().sessions == 4


def test_performance_as_written_multiplies_by_tickets(frames, tickets):
    accounts = frames.table(
        "accounts", {"account_id": 1, "csm_owner": "x", "contract_value": 10}
    )
    none = frames.table("renewals")
    health = views.account_health(accounts, frames.table("health_scores"), none, AS_OF)
    written = views.csm_performance(accounts, health, tickets).first()
    once = views.csm_performance(accounts, health, tickets, fan_out=False).first()
    assert (float(written.total_portfolio_value), float(once.total_portfolio_value)) == (30, 10)
    assert written.open_tickets == once.open_tickets == 2


def test_performance_per_owner(accounts, health, tickets):
    rows = as_dict(views.csm_performance(accounts, health, tickets), "csm_owner", "total_accounts")
    assert rows == {"x": 2, None: 1}
    x = views.csm_performance(accounts, health, tickets).filter("csm_owner = 'x'").first()
    # account 1: 2 renewals x 3 tickets, account 2: once
    assert float(x.total_portfolio_value) == 6 * 10 + 5.5
    assert x.avg_health_score == round((6 * 40.25 + 50.15) / 7, 1)
    assert (x.critical_accounts, x.at_risk_accounts, x.open_tickets) == (1, 1, 2)
    assert validation.owner_critical_mismatches(
        views.csm_performance(accounts, health, tickets), health
    ).first().asDict() == {"owners": 2, "mismatches": 0}


COLUMNS = ["csm_owner", "total_accounts", "critical_accounts", "at_risk_accounts",
           "avg_health_score", "avg_csat", "avg_nps", "open_tickets", "total_portfolio_value"]


def plain_performance(accounts, health, tickets):
    """The definition row by row: each account with each of its health rows and tickets."""
    owners = {}
    for a in accounts:
        mine = lambda rows: [r for r in rows if r.account_id == a.account_id is not None]  # noqa: E731,B023
        rows = [(h, t) for h in mine(health) or [None] for t in mine(tickets) or [None]]
        owners.setdefault(a.csm_owner, []).extend((a, h, t) for h, t in rows)

    def mean(values):
        values = [v for v in values if v is not None]
        if not values:
            return None
        exact = (sum(values) / len(values)).quantize(Decimal("1e-6"), ROUND_HALF_UP)
        return float(exact.quantize(Decimal("0.1"), ROUND_HALF_UP))

    out = []
    for owner, rows in owners.items():
        ids = lambda keep: len({a.account_id for a, h, t in rows if keep(h, t)} - {None})  # noqa: E731,B023
        opened = {t.ticket_id for _, _, t in rows if t and t.status == "Open"} - {None}
        values = [a.contract_value for a, _, _ in rows if a.contract_value is not None]
        out.append((
            owner,
            ids(lambda h, t: True),
            ids(lambda h, t: h and h.health_status == "Critical"),
            ids(lambda h, t: h and h.health_status == "At Risk"),
            *[mean([h and h[c] for _, h, _ in rows])
              for c in ("overall_score", "csat_score", "nps_score")],
            len(opened),
            sum(values) if values else None,
        ))
    return out


def test_performance_is_the_join_it_stands_for(spark):
    """Against the definition on random tables with repeats everywhere."""
    def random_rows(n, seed, **columns):
        df = spark.range(n)
        for i, (name, (kind, values)) in enumerate(columns.items()):
            pick = F.floor(F.rand(seed + i) * values)
            df = df.withColumn(name, F.when(F.rand(seed + 50 + i) > 0.1, pick).cast(kind))
        return spark.createDataFrame(df.collect(), df.schema)

    accounts = random_rows(60, 1, account_id=("bigint", 40), owner=("bigint", 4),
                           contract_value=("decimal(12,2)", 900))
    accounts = accounts.withColumn("csm_owner", F.concat(F.lit("o"), F.col("owner")))
    health = random_rows(60, 2, account_id=("bigint", 40), s=("bigint", 3),
                         overall_score=("decimal(5,2)", 100), csat_score=("decimal(5,2)", 100),
                         nps_score=("decimal(5,2)", 100))
    health = health.withColumn(
        "health_status", F.element_at(F.array(*map(F.lit, ["Critical", "At Risk", "Healthy"])),
                                      (F.col("s") + 1).cast("int")))
    tickets = random_rows(300, 3, ticket_id=("bigint", 200), account_id=("bigint", 45),
                          s=("bigint", 2))
    tickets = tickets.withColumn("status", F.when(F.col("s") == 0, "Open").otherwise("Resolved"))
    expected = plain_performance(accounts.collect(), health.collect(), tickets.collect())
    got = views.csm_performance(accounts, health, tickets)
    assert sorted(repr(tuple(r)) for r in got.select(*COLUMNS).collect()) == sorted(
        map(repr, expected)
    )


def test_latest_workload(frames):
    workload = frames.table(
        "csm_workload",
        {"csm_owner": "x", "run_date": "2024-01-01"}, {"csm_owner": "x", "run_date": "2024-02-01"},
        {"csm_owner": "y", "run_date": "2024-02-01"},
    )
    assert views.csm_workload_latest(workload).count() == 2


def test_measures(accounts, health, tickets):
    assert measures.kpi_counts(health).first().asDict() == {
        "total_accounts": 4, "healthy_accounts": 0, "at_risk_accounts": 1, "critical_accounts": 2,
    }
    assert measures.retention_rate(health).first().retention_rate == pytest.approx(2 / 3)
    nobody = health.filter("account_id = 2")
    assert measures.retention_rate(nobody).first().retention_rate is None
    assert float(measures.portfolio_value(health).first().total_portfolio_value) == 26.5
    assert measures.open_tickets(tickets, accounts, AS_OF).first().open_tickets == 2
    rate = measures.sla_breach_rate(tickets, accounts, AS_OF).first().sla_breach_rate
    assert rate == pytest.approx(2 / 3)
    assert as_dict(measures.accounts_by(health, "segment"), "segment", "accounts") == {
        "SMB": 3, "Enterprise": 1,
    }
    assert as_dict(
        measures.accounts_by_account_status(accounts), "account_status", "accounts"
    ) == {"Active": 2, "Churned": 1}
    soon = [r.account_id for r in measures.upcoming_renewals(health).collect()]
    assert soon == [1, 1]
    average = as_dict(measures.average_score_by(health, "region"), "region", "avg_health_score")
    assert average == {"EU": 40.25, "US": 50.15}
    owners = measures.critical_by_owner(views.csm_performance(accounts, health, tickets))
    assert [r.csm_owner for r in owners.collect()] == ["x", None]


def test_validation(frames, accounts, health, scores, renewals):
    gap = validation.score_outcome_gap(scores.filter("score_date = '2024-06-01'"), renewals)
    assert gap.first().asDict() == {"churned_avg": 40.25, "renewed_avg": 40.25, "gap": 0.0}
    checks = validation.view_checks(accounts, health).first()
    assert (checks.rows_in_view, checks.account_rows) == (4, 3)
    assert (checks.negative_days, checks.blank_status, checks.blank_owner) == (0, 1, 1)
    assert validation.renewal_rule_mismatches(health, accounts, AS_OF).first().mismatches == 0
    engagement = frames.of(
        "account_id bigint, engagement_score double", (1, 0.0), (2, 100.0), (3, 40.0), (4, 60.0)
    )
    assert validation.engagement_middle_share(engagement).first().middle_share == 0.5
    assert validation.max_status_share(scores).first().max_share == pytest.approx(1 / 3)
    surveys = frames.table("surveys", {"survey_id": 1, "account_id": 1}, {"survey_id": 2, "account_id": 1})
    latest = views.latest_survey_view(surveys)
    assert validation.latest_survey_checks(surveys, latest).first().asDict() == {
        "latest_rows": 1, "surveyed_accounts": 1,
    }


def test_outcome_gap_on_a_portfolio_where_scores_tell(frames):
    scores = frames.of(
        "account_id bigint, overall_score double", (1, 40.0), (2, 44.0), (3, 75.0), (4, 77.0)
    )
    outcomes = frames.table(
        "renewals",
        *[{"account_id": i, "renewal_status": s}
          for i, s in ((1, "Churned"), (2, "Churned"), (3, "Renewed"), (4, "Renewed"))],
    )
    row = validation.score_outcome_gap(scores, outcomes).first()
    assert (row.churned_avg, row.renewed_avg, row.gap) == (42.0, 76.0, 34.0)


def test_hot_account_in_renewals(spark, frames):
    """An account with most of the renewals keeps every one of them."""
    accounts = frames.table("accounts", *[{"account_id": i} for i in range(50)])
    renewals = spark.range(60_000).select(
        F.col("id").alias("renewal_id"),
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 40).alias("account_id"),
        F.lit("Renewed").alias("renewal_status"),
        F.lit(1).cast("decimal(12,2)").alias("renewal_value"),
        F.lit(None).cast("string").alias("churn_reason"),
    )
    health = views.account_health(accounts, frames.table("health_scores"), renewals, AS_OF)
    # ids 40..49 have no renewal and stay, once each
    assert health.count() == 60_000 + 10
