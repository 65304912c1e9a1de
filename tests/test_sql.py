"""SQL with bound parameters, and column defaults of catalog tables."""

from datetime import date

import pytest

from heartwood.sources import schemas
from heartwood.sources.sql import create_result_tables, names_of, read_sql


@pytest.fixture(scope="module")
def accounts(frames):
    return frames.table(
        "accounts",
        *[{"account_id": i, "company_name": f"C{i}", "renewal_date": f"2024-06-{i:02}"}
          for i in range(1, 10)],
        {"account_id": 5, "company_name": "again"},
        {"company_name": "no id"},
    )


def test_names_of_bound_ids(accounts):
    found = sorted((r.account_id, r.company_name) for r in names_of(accounts, [5, 2, 99, 2]).collect())
    assert found == [(2, "C2"), (5, "C5"), (5, "again")]
    assert names_of(accounts, []).count() == 0
    assert names_of(accounts, []).columns == names_of(accounts, [1]).columns


def test_parameters_are_values_and_never_text(spark, accounts):
    text = "SELECT account_id FROM {a} WHERE company_name = :name OR renewal_date >= :day"
    rows = read_sql(spark, text, {"name": "C1' OR 'x' = 'x", "day": date(2024, 6, 9)}, a=accounts)
    assert [r.account_id for r in rows.collect()] == [9]
    rows = read_sql(spark, "SELECT count(*) AS n FROM {a} WHERE array_contains(:names, company_name)",
                    {"names": ["C1", "C2"]}, a=accounts)
    assert rows.first().n == 2
    with pytest.raises(Exception, match="(?i)unbound"):
        read_sql(spark, text, {"name": "C1"}, a=accounts).collect()


def test_tables_fill_in_their_defaults(spark):
    spark.sql("CREATE DATABASE heartwood_defaults")
    try:
        for _ in range(2):
            create_result_tables(spark, "heartwood_defaults")
        spark.sql("INSERT INTO heartwood_defaults.action_center (action_id, account_id) VALUES (1, 7)")
        spark.sql(
            "INSERT INTO heartwood_defaults.action_center (action_id, status) VALUES (2, 'Done')"
        )
        rows = {r.action_id: r for r in spark.table("heartwood_defaults.action_center").collect()}
        assert (rows[1].account_id, rows[1].status, rows[1].owner) == (7, "Open", None)
        assert rows[1].created_at is not None and rows[2].status == "Done"
        for name, schema in schemas.RESULT_SCHEMAS.items():
            assert dict(spark.table(f"heartwood_defaults.{name}").dtypes) == schema
    finally:
        spark.sql("DROP DATABASE heartwood_defaults CASCADE")
