"""What the physical plans must and must not contain."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contract.registered import registered_queries
from heartwood.operators import health, views

DIRECTORY = Path("/root/testdata/sf0.001")
AS_OF = datetime(2024, 6, 1)
on_test_tables = pytest.mark.skipif(not DIRECTORY.exists(), reason="test tables not present")


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan(spark, name):
    return text_of(registered_queries()[name](spark, str(DIRECTORY)))


@pytest.fixture
def small_skew_threshold(spark):
    """Shuffles of test size count as large: no broadcasts, hot partitions are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    """The plan after adaptive execution of a query that needs every column."""
    total = df.select(F.sum(F.xxhash64(*df.columns) % 1000).alias("h"))
    total.collect()
    return text_of(total).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def stored(spark, frames, tmp_path_factory):
    """Accounts, and facts a third of which belong to account 7."""
    root = tmp_path_factory.mktemp("skewed")
    n = 300_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000)
    facts = spark.range(n).select(
        F.col("id").alias("ticket_id"),
        F.col("id").alias("renewal_id"),
        F.col("id").alias("usage_id"),
        hot.cast("bigint").alias("account_id"),
        F.lit("Open").alias("status"),
        F.lit("Low").alias("priority"),
        F.sha1(F.col("id").cast("string")).alias("category"),
        F.sha1(F.col("id").cast("string")).alias("churn_reason"),
        F.lit("Renewed").alias("renewal_status"),
        F.lit(1).cast("decimal(12,2)").alias("renewal_value"),
        F.lit("2024-05-01").cast("timestamp_ntz").alias("created_date"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_date"),
        F.lit(8).alias("sla_hours"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") / 3).cast("int")).alias("usage_date"),
        (F.col("id") % 97).cast("int").alias("sessions"),
        (F.col("id") % 13).cast("int").alias("active_users"),
        (F.col("id") % 101).cast("decimal(5,2)").alias("feature_usage_pct"),
    )
    accounts = spark.range(20_000).select(
        F.col("id").alias("account_id"),
        *[F.lit("x").alias(c) for c in ("company_name", "industry", "segment", "region",
                                        "csm_owner", "account_status")],
        F.lit(1).cast("decimal(12,2)").alias("contract_value"),
        F.lit("2024-01-01").cast("date").alias("start_date"),
        F.lit("2025-01-01").cast("date").alias("renewal_date"),
    )
    tables = {}
    for name, df in {"facts": facts, "accounts": accounts}.items():
        df.write.parquet(str(root / name))
        tables[name] = spark.read.parquet(str(root / name))
    return tables


def test_hot_account_is_split_in_the_ticket_view(stored, small_skew_threshold):
    df = views.ticket_sla(stored["facts"], stored["accounts"], AS_OF)
    assert "skew=true" in final_plan(df)


def test_hot_account_is_split_in_account_health(frames, stored, small_skew_threshold):
    df = views.account_health(
        stored["accounts"], frames.table("health_scores"), stored["facts"], AS_OF
    )
    assert "skew=true" in final_plan(df)


def test_newest_score_is_reduced_before_the_shuffle(frames, stored):
    scores = frames.table("health_scores", {"account_id": 1, "score_date": "2024-05-01"})
    df = views.account_health(stored["accounts"], scores, stored["facts"], AS_OF)
    assert "row_number(), 1, Partial" in text_of(df)


def test_engagement_shuffles_days_and_not_rows(stored):
    df = health.score_engagement(stored["facts"])
    df.collect()
    final = text_of(df).split("Initial Plan")[0]
    # one scan is left of the many in the initial plan: no day is split here
    assert final.count("FileScan") == 1
    assert "partial_sum" in final


@on_test_tables
@pytest.mark.parametrize(
    "name", ["health_scores", "csm_workload", "csm_performance", "dq_score", "account_health"]
)
def test_no_python_and_no_products(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@on_test_tables
def test_newest_row_is_reduced_before_the_shuffle(spark):
    text = plan(spark, "latest_survey")
    assert text.index("partial_max") > text.index("Exchange hash")  # printed from the root down
    assert text.count("Exchange hash") == 1


@on_test_tables
def test_support_aggregates_before_the_shuffle_and_reads_what_it_needs(spark):
    text = plan(spark, "support_score")
    assert "partial_count" in text
    assert "o_totalprice" not in text and "l_extendedprice" not in text


@on_test_tables
def test_filter_reaches_the_scan(spark):
    assert "EqualTo(o_orderstatus,F)" in plan(spark, "latest_survey")


@on_test_tables
@pytest.mark.parametrize(
    "name, most",
    [("engagement_score", 8), ("account_health", 33), ("newly_critical", 24), ("dq_issues", 23)],
)
def test_tables_are_not_read_over_and_over(spark, name, most):
    df = registered_queries()[name](spark, str(DIRECTORY))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= most


@on_test_tables
def test_nothing_is_sorted_below_the_digest(spark):
    df = registered_queries()["digest_lines"](spark, str(DIRECTORY))
    assert "Sort [" not in df._jdf.queryExecution().optimizedPlan().toString()


@on_test_tables
@pytest.mark.parametrize("name", ["engagement_score", "engagement_score_events"])
def test_engagement_plans_few_scans_and_windows(spark, name):
    df = registered_queries()[name](spark, str(DIRECTORY))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    starts = [line.lstrip(" :+-") for line in lines]
    assert sum(start.startswith("Relation") for start in starts) <= 5
    assert sum(start.startswith("Window") for start in starts) <= 3
