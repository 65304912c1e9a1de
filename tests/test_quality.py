import pytest

from heartwood import fixed_values as fixed
from heartwood.operators import quality


def counts(df):
    return [r.record_count for r in df.collect()]


def test_missing_required_skips_absent_columns(frames):
    df = frames.table("accounts", {"account_id": 1}, {"account_id": None, "company_name": "A"})
    rows = quality.check_missing_required_fields(
        df.drop("segment"), "accounts", ["account_id", "segment", "company_name"]
    ).collect()
    assert [(r.table, r.check, r.severity, r.record_count, r.detail) for r in rows] == [
        ("accounts", "missing_account_id", "critical", 1,
         "1 rows missing required field 'account_id'"),
        ("accounts", "missing_company_name", "critical", 1,
         "1 rows missing required field 'company_name'"),
    ]


@pytest.mark.parametrize(
    "keys, duplicates", [([1, None, None, 1], 2), ([1, 2, 3], 0), ([5, 5, 5], 2), ([], 0)]
)
def test_duplicates_count_rows_beyond_the_first(frames, keys, duplicates):
    df = frames.of("k bigint", *[(k,) for k in keys])
    row = quality.check_duplicate_keys(df, "t", "k").first()
    assert row.record_count == duplicates
    assert row.detail == f"{duplicates} duplicate values in 'k'"


@pytest.mark.parametrize(
    "parents, orphans", [([1, 2], 2), ([1, None], 1), ([], 3), ([1, 9, None, 9], 0)]
)
def test_orphans(frames, parents, orphans):
    child = frames.of("fk bigint", (1,), (None,), (9,))
    parent = frames.of("id bigint", *[(p,) for p in parents])
    row = quality.check_orphan_records(child, "contacts", "fk", parent, "id").first()
    assert row.record_count == orphans
    assert row.detail == f"{orphans} rows in contacts reference a non-existent id"


def test_date_order_needs_both_dates(frames):
    df = frames.table(
        "support_tickets",
        {"created_date": "2024-01-02", "resolved_date": "2024-01-01"},
        {"created_date": "2024-01-02", "resolved_date": "2024-01-02"},
        {"created_date": "2024-01-02"},
        {"resolved_date": "2024-01-02"},
    )
    row = quality.check_date_logic(df, "support_tickets", "created_date", "resolved_date").first()
    assert row.check == "invalid_date_order_created_date_resolved_date"
    assert row.record_count == 1
    assert row.detail == "1 rows where resolved_date is earlier than created_date"


def test_range_is_inclusive_and_allows_missing(frames):
    df = frames.table(
        "surveys", *[{"nps_score": v} for v in (-101, -100, 0, 100, 101, None)]
    )
    row = quality.check_value_range(df, "surveys", "nps_score", -100, 100).first()
    assert (row.severity, row.record_count) == ("warning", 2)
    assert row.detail == "2 rows where nps_score is outside expected range [-100, 100]"


def test_status_needs_a_date(frames):
    df = frames.table(
        "support_tickets",
        {"status": "Resolved"},
        {"status": "Resolved", "resolved_date": "2024-01-01"},
        {"status": "Open"},
        {"status": None},
    )
    row = quality.check_status_consistency(
        df, "support_tickets", "status", "resolved_date", "Resolved"
    ).first()
    assert (row.check, row.record_count) == ("status_date_mismatch_status", 1)
    assert row.detail == "1 rows with status 'Resolved' but no resolved_date"


def test_catalogue_has_26_rules():
    assert len(fixed.QUALITY_RULES) == 26


def account(i, **values):
    return {
        "account_id": i, "company_name": "A", "account_status": "Active", "contract_value": 1,
        **values,
    }


def test_report_issues_and_score(frames):
    tables = {
        "accounts": frames.table(
            "accounts", account(1), account(2, contract_value=-1), account(2, company_name=None)
        ),
        "contacts": frames.table(
            "contacts", {"contact_id": 1, "account_id": 1}, {"contact_id": 2, "account_id": 7}
        ),
        "opportunities": frames.table("opportunities", {"opportunity_id": 1, "account_id": 1}),
        "surveys": frames.table(
            "surveys", *[{"survey_id": i, "account_id": 1, "csat_score": 50, "nps_score": 0}
                         for i in range(14)]
        ),
    }
    report = quality.quality_report(tables)
    issues = [(r.table, r.check, r.record_count) for r in quality.quality_issues(report).collect()]
    assert issues == [
        ("accounts", "missing_company_name", 1),
        ("accounts", "duplicate_primary_key", 1),
        ("accounts", "out_of_range_contract_value", 1),
        ("contacts", "orphan_foreign_key", 1),
    ]
    row = quality.quality_score(report).first()
    assert row.total_records_checked == 20
    assert (row.critical_issue_records, row.warning_issue_records) == (3, 1)
    assert row.data_quality_score == round(100 - (3 * 2 + 1) / 20 * 100, 2)


def test_score_without_records_and_with_too_many_issues(frames):
    empty = {"accounts": frames.table("accounts")}
    assert quality.quality_score(quality.quality_report(empty)).first().data_quality_score == 100.0
    broken = {"accounts": frames.table("accounts", {}, {})}
    assert quality.quality_score(quality.quality_report(broken)).first().data_quality_score == 0.0


def test_one_account_owning_most_references(spark, frames):
    tables = {
        "accounts": frames.table("accounts", account(1)),
        "product_usage": spark.range(200_000).selectExpr(
            "id AS usage_id", "CASE WHEN id % 3 = 0 THEN 77 ELSE 1 END AS account_id",
            "CAST(50 AS DECIMAL(5,2)) AS feature_usage_pct",
        ),
    }
    issues = quality.quality_issues(quality.quality_report(tables)).collect()
    assert [(r.check, r.record_count) for r in issues] == [("orphan_foreign_key", 66_667)]
