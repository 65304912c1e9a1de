"""The canonical tables derived from an order-management star schema.

customer, orders, lineitem, supplier, nation, region and events take the parts of
accounts, tickets, surveys, renewals, deals, contacts and product usage, so that the
operators can run on data of any scale that has no customer-success tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.functions import as_of_day, as_of_moment, np_round
from heartwood.sources.schemas import RAW_SCHEMAS


def _accounts(customer, orders, nation, region) -> DataFrame:
    order_span = orders.groupBy(F.col("o_custkey").alias("account_id")).agg(
        F.min("o_orderdate").cast("date").alias("start_date"),
        F.date_add(F.max("o_orderdate").cast("date"), 365).alias("renewal_date"),
    )
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("company_name"),
            F.col("n_name").alias("industry"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("CSM_"), F.col("c_nationkey").cast("string")).alias("csm_owner"),
            F.lit("Active").alias("account_status"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("contract_value"),
        )
        .join(order_span, "account_id", "left")
    )


def _contacts(supplier) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("contact_id"),
        (F.col("s_suppkey") * 20).alias("account_id"),
        F.col("s_name").alias("full_name"),
        F.lit("Supplier").alias("role"),
        F.lit("Purchasing").alias("department"),
        F.lit("Active").alias("engagement_status"),
    )


def _opportunities(lineitem, orders) -> DataFrame:
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("opportunity_id"),
        F.col("o_custkey").alias("account_id"),
        F.concat(F.lit("Sales_"), F.col("l_suppkey").cast("string")).alias("sales_owner"),
        F.lit("Closed").alias("opportunity_stage"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.col("l_shipdate").cast("date").alias("close_date"),
        F.when(F.col("l_returnflag") == "R", "Lost").otherwise("Won").alias("outcome"),
    )


def _customer_success(accounts) -> DataFrame:
    account = F.col("account_id")
    accepted = F.date_add("start_date", (account % 12).cast("int"))
    started = F.date_add(accepted, 2)
    completed = F.date_add(started, (account % 45).cast("int"))
    return accounts.select(
        account,
        F.col("csm_owner"),
        F.col("start_date").cast("timestamp_ntz").alias("handoff_created_at"),
        accepted.cast("timestamp_ntz").alias("handoff_accepted_at"),
        F.lit("Complete").alias("onboarding_status"),
        started.cast("timestamp_ntz").alias("onboarding_started_at"),
        completed.cast("timestamp_ntz").alias("onboarding_completed_at"),
        F.lit(None).cast("string").alias("success_plan"),
        F.lit(None).cast("string").alias("health_status"),
    )


def _support_tickets(orders, lineitem) -> DataFrame:
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_quantity").cast("int").alias("resolution_hours"),
        F.min("l_shipdate").alias("first_shipped"),
    )
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    created = F.col("o_orderdate")
    return orders.join(per_order, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_custkey").alias("account_id"),
        F.when(priority == "1-URGENT", "Critical")
        .when(priority == "2-HIGH", "High")
        .when(priority == "3-MEDIUM", "Medium")
        .otherwise("Low")
        .alias("priority"),
        F.lit("Order").alias("category"),
        created.alias("created_date"),
        F.when(status == "F", F.timestamp_add("HOUR", F.col("resolution_hours"), created))
        .when(status == "P", F.col("first_shipped"))
        .alias("resolved_date"),
        F.when(priority == "1-URGENT", 8)
        .when(priority == "2-HIGH", 24)
        .when(priority == "3-MEDIUM", 48)
        .otherwise(72)
        .alias("sla_hours"),
        F.when(status == "F", "Resolved")
        .when(status == "O", "Open")
        .when(status == "P", "Escalated")
        .alias("status"),
    )


def _product_usage(events) -> DataFrame:
    day = F.col("ts").cast("date")
    per_day = events.groupBy(F.col("user_id").alias("account_id"), day.alias("usage_date"))
    daily = per_day.agg(
        F.count(F.lit(1)).cast("int").alias("sessions"),
        F.count_distinct("event_type").cast("int").alias("active_users"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("total"),
    )
    mean = F.col("total").cast("double") / F.col("sessions")
    return daily.select(
        (F.col("account_id") * 100000 + F.unix_date("usage_date")).alias("usage_id"),
        "account_id",
        "usage_date",
        "sessions",
        "active_users",
        np_round(F.least(F.lit(100.0), mean), 2)
        .cast("decimal(5,2)")
        .alias("feature_usage_pct"),
    )


def _surveys(orders) -> DataFrame:
    return orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("survey_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("survey_date"),
        np_round(F.least(F.lit(100.0), F.col("o_totalprice") / 5000), 2)
        .cast("decimal(5,2)")
        .alias("csat_score"),
        (F.col("o_orderkey") % 201 - 100).cast("int").alias("nps_score"),
        F.lit("Product").alias("feedback_category"),
    )


def _renewals(orders) -> DataFrame:
    newest = F.max_by(
        F.struct("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"),
        F.struct("o_orderdate", "o_orderkey"),
    )
    status = F.col("last.o_orderstatus")
    return (
        orders.groupBy(F.col("o_custkey").alias("account_id"))
        .agg(newest.alias("last"))
        .select(
            F.col("last.o_orderkey").alias("renewal_id"),
            "account_id",
            F.date_add(F.col("last.o_orderdate").cast("date"), 365).alias("renewal_date"),
            F.col("last.o_totalprice").cast("decimal(12,2)").alias("renewal_value"),
            F.when(status == "F", "Renewed")
            .when(status == "O", "Pending")
            .when(status == "P", "Churned")
            .alias("renewal_status"),
            F.when(status == "P", "Partial shipment").alias("churn_reason"),
        )
    )


STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


class CanonicalTables(Mapping):
    """The canonical tables of one directory by name, each derived on first use."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark, self._directory = spark, directory
        self._derived: dict[str, DataFrame] = {}

    def _star(self, name: str) -> DataFrame:
        reader = self._spark.read.schema(STAR_SCHEMAS[name])
        return reader.parquet(f"{self._directory}/{name}.parquet")

    def _derive(self, name: str) -> DataFrame:
        star = self._star
        if name == "accounts":
            return _accounts(star("customer"), star("orders"), star("nation"), star("region"))
        if name == "contacts":
            return _contacts(star("supplier"))
        if name == "opportunities":
            return _opportunities(star("lineitem"), star("orders"))
        if name == "customer_success":
            return _customer_success(self["accounts"])
        if name == "support_tickets":
            return _support_tickets(star("orders"), star("lineitem"))
        if name == "product_usage":
            return _product_usage(star("events"))
        if name == "surveys":
            return _surveys(star("orders"))
        return _renewals(star("orders"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(name)
        if name not in self._derived:
            self._derived[name] = self._derive(name)
        return self._derived[name]

    def __iter__(self):
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)


def known_by(tables: Mapping[str, DataFrame], as_of: datetime) -> dict[str, DataFrame]:
    """The tables with only the tickets and surveys dated up to ``as_of``."""
    tickets, surveys = tables["support_tickets"], tables["surveys"]
    return {
        **tables,
        "support_tickets": tickets.filter(F.col("created_date") <= as_of_moment(as_of)),
        "surveys": surveys.filter(F.col("survey_date") <= as_of_day(as_of)),
    }
