"""One explicit schema per table: column name to Spark type, in column order."""

ACCOUNTS = {
    "account_id": "bigint",
    "company_name": "string",
    "industry": "string",
    "segment": "string",
    "region": "string",
    "csm_owner": "string",
    "account_status": "string",
    "contract_value": "decimal(12,2)",
    "start_date": "date",
    "renewal_date": "date",
}
CONTACTS = {
    "contact_id": "bigint",
    "account_id": "bigint",
    "full_name": "string",
    "role": "string",
    "department": "string",
    "engagement_status": "string",
}
OPPORTUNITIES = {
    "opportunity_id": "bigint",
    "account_id": "bigint",
    "sales_owner": "string",
    "opportunity_stage": "string",
    "amount": "decimal(12,2)",
    "close_date": "date",
    "outcome": "string",
}
CUSTOMER_SUCCESS = {
    "account_id": "bigint",
    "csm_owner": "string",
    "handoff_created_at": "timestamp_ntz",
    "handoff_accepted_at": "timestamp_ntz",
    "onboarding_status": "string",
    "onboarding_started_at": "timestamp_ntz",
    "onboarding_completed_at": "timestamp_ntz",
    "success_plan": "string",
    "health_status": "string",
}
SUPPORT_TICKETS = {
    "ticket_id": "bigint",
    "account_id": "bigint",
    "priority": "string",
    "category": "string",
    "created_date": "timestamp_ntz",
    "resolved_date": "timestamp_ntz",
    "sla_hours": "int",
    "status": "string",
}
PRODUCT_USAGE = {
    "usage_id": "bigint",
    "account_id": "bigint",
    "usage_date": "date",
    "sessions": "int",
    "active_users": "int",
    "feature_usage_pct": "decimal(5,2)",
}
SURVEYS = {
    "survey_id": "bigint",
    "account_id": "bigint",
    "survey_date": "date",
    "csat_score": "decimal(5,2)",
    "nps_score": "int",
    "feedback_category": "string",
}
RENEWALS = {
    "renewal_id": "bigint",
    "account_id": "bigint",
    "renewal_date": "date",
    "renewal_value": "decimal(12,2)",
    "renewal_status": "string",
    "churn_reason": "string",
}

RAW_SCHEMAS = {
    "accounts": ACCOUNTS,
    "contacts": CONTACTS,
    "opportunities": OPPORTUNITIES,
    "customer_success": CUSTOMER_SUCCESS,
    "support_tickets": SUPPORT_TICKETS,
    "product_usage": PRODUCT_USAGE,
    "surveys": SURVEYS,
    "renewals": RENEWALS,
}

# Partition columns come last: that is where Spark puts them on read.
HEALTH_SCORES = {
    "account_id": "bigint",
    "engagement_score": "decimal(5,2)",
    "support_score": "decimal(5,2)",
    "csat_score": "decimal(5,2)",
    "nps_score": "decimal(5,2)",
    "onboarding_score": "decimal(5,2)",
    "overall_score": "decimal(5,2)",
    "health_status": "string",
    "risk_drivers": "string",
    "score_date": "date",
}
ACTION_CENTER = {
    "action_id": "bigint",
    "account_id": "bigint",
    "risk_level": "string",
    "reason": "string",
    "recommended_action": "string",
    "owner": "string",
    "due_date": "date",
    "status": "string",
    "created_at": "timestamp_ntz",
}
# Counts have 64 bits, and the workload score room for owners of any size.
CSM_WORKLOAD = {
    "csm_owner": "string",
    "total_accounts": "bigint",
    "at_risk_accounts": "bigint",
    "critical_accounts": "bigint",
    "open_tickets": "bigint",
    "upcoming_renewals": "bigint",
    "workload_score": "decimal(18,1)",
    "workload_category": "string",
    "run_date": "date",
}
AUTOMATION_RUNS = {
    "run_id": "bigint",
    "run_started_at": "timestamp_ntz",
    "run_completed_at": "timestamp_ntz",
    "status": "string",
    "data_quality_score": "decimal(5,2)",
    "total_accounts": "bigint",
    "healthy_count": "bigint",
    "monitor_count": "bigint",
    "at_risk_count": "bigint",
    "critical_count": "bigint",
    "action_items_created": "bigint",
    "error_message": "string",
}

RESULT_SCHEMAS = {
    "health_scores": HEALTH_SCORES,
    "action_center": ACTION_CENTER,
    "csm_workload": CSM_WORKLOAD,
    "automation_runs": AUTOMATION_RUNS,
}


def ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in schema.items())
