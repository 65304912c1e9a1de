"""Weights, thresholds, texts and rules that define the results.

Everything here is part of the result contract. Operators read these names and
hold no numbers or texts of their own.
"""

RAW_TABLES = (
    "accounts",
    "contacts",
    "opportunities",
    "customer_success",
    "support_tickets",
    "product_usage",
    "surveys",
    "renewals",
)

# --- health score -----------------------------------------------------------

# component column, weight; the overall score adds them in this order
COMPONENT_WEIGHTS = (
    ("engagement_score", 0.25),
    ("support_score", 0.20),
    ("csat_score", 0.20),
    ("nps_score", 0.15),
    ("onboarding_score", 0.20),
)
NEUTRAL_SCORE = 50.0

# lower bound, upper bound, status; both bounds inclusive, the gaps are Unknown
STATUS_BANDS = (
    (80.0, 100.0, "Healthy"),
    (65.0, 79.999, "Monitor"),
    (45.0, 64.999, "At Risk"),
    (0.0, 44.999, "Critical"),
)
STATUS_OUTSIDE_BANDS = "Unknown"

# component column, strict upper bound, text before the score, text after it
RISK_DRIVER_TEXTS = (
    ("engagement_score", 50, "product usage declining (engagement ", "/100)"),
    ("support_score", 50, "high support burden / SLA breaches (support ", "/100)"),
    ("csat_score", 60, "low CSAT (", "/100)"),
    ("nps_score", 50, "negative NPS trend (", "/100)"),
    ("onboarding_score", 60, "slow onboarding/handoff (onboarding ", "/100)"),
)
NO_RISK_DRIVERS = "No significant risk drivers"

# usage metric, weight within the engagement index
USAGE_WEIGHTS = (
    ("sessions", 0.4),
    ("active_users", 0.4),
    ("feature_usage_pct", 0.2),
)
ENGAGEMENT_MIN_ROWS = 4
ENGAGEMENT_SHORT_HISTORY = 60.0
ENGAGEMENT_MIDPOINT = 50.0
ENGAGEMENT_SLOPE = 150.0
ENGAGEMENT_EPSILON = 1e-9

SEVERE_PRIORITIES = ("High", "Critical")
SEVERE_SHARE_POINTS = 40
BREACH_SHARE_POINTS = 40
OPEN_TICKET_POINTS = 3
OPEN_TICKET_POINTS_CAP = 20

# start column, end column, allowed days, points per day over, cap
ONBOARDING_RULES = (
    ("handoff_created_at", "handoff_accepted_at", 3, 4, 30),
    ("onboarding_started_at", "onboarding_completed_at", 14, 2, 50),
)

# --- actions ----------------------------------------------------------------

# status, recommended action, days until due
RISK_ACTIONS = (
    ("Critical", "CSM intervention required within 48 hours", 2),
    ("At Risk", "Schedule account review call this week", 5),
    ("Monitor", "Add to weekly watchlist review", 14),
)
RENEWAL_WINDOW_DAYS = 60
RENEWAL_URGENT_DUE_DAYS = 2
# around the days to the renewal, after the action
RENEWAL_NOTE = (" (renewal in ", " days)")
RENEWAL_CYCLE_DAYS = 365

# --- workload ---------------------------------------------------------------

# owner measure, points each
WORKLOAD_POINTS = (
    ("total_accounts", 1.0),
    ("at_risk_accounts", 2.0),
    ("critical_accounts", 3.0),
    ("open_tickets", 0.5),
    ("upcoming_renewals", 1.5),
)
WORKLOAD_CATEGORIES = ("Balanced", "Elevated", "High", "Overloaded")

# --- snapshots and digest ---------------------------------------------------

SCORE_DROP_POINTS = 10
URGENT_DAYS_AHEAD = 2

DIGEST_TITLE = "# Customer Success Daily Digest — "
DIGEST_COMPARED = "Compared against previous run: "
DIGEST_FIRST_RUN = "none (first run)"
# text before a figure, figure; text after the last one
DIGEST_SUMMARY_LINES = (
    (("- Data Quality Score: **", "data_quality_score"), "/100**"),
    (("- Total accounts: ", "total_accounts"), ""),
    (
        (
            "- Healthy: ", "healthy_count", " · Monitor: ", "monitor_count",
            " · At Risk: ", "at_risk_count", " · Critical: ", "critical_count",
        ),
        "",
    ),
    (("- Open action items: ", "action_items_created"), ""),
)
DIGEST_STANDALONE_QUALITY = "N/A (standalone run)"
# around name, score and drivers of a newly critical account
DIGEST_CRITICAL_TEXTS = (" (score ", ") — ")
# around name, previous and current score and the drop
DIGEST_DROP_TEXTS = (": ", " -> ", " (-", ")")
# around company, risk, action, owner and due date of an urgent action
DIGEST_URGENT_TEXTS = ("- **", "** (", ") — ", " — owner: ", " — due ")
DIGEST_NAME_TEXTS = ("- **", "**")
DIGEST_UNKNOWN_ACCOUNT = "Account "
DIGEST_MISSING = "None"
DIGEST_SUMMARY_HEADING = "## Summary"
DIGEST_NEW_CRITICAL_HEADING = "## Newly Critical Accounts"
DIGEST_NEW_CRITICAL_NONE = (
    "- None. No accounts newly entered Critical status since the last run."
)
DIGEST_DROPS_HEADING = "## Accounts With Significant Score Drops (>10 pts)"
DIGEST_URGENT_HEADING = "## Action Items Due in the Next 2 Days"
DIGEST_NONE = "- None."

# --- data quality -----------------------------------------------------------

# Rules in report order. Kind and arguments:
#   missing   column                                   critical
#   duplicate key column                               critical
#   orphan    foreign key, parent table, parent key    critical
#   order     start column, end column                 critical
#   range     column, lowest, highest                  warning
#   status    status column, date column, status       warning
QUALITY_RULES = (
    ("accounts", "missing", ("account_id",)),
    ("accounts", "missing", ("company_name",)),
    ("accounts", "missing", ("account_status",)),
    ("accounts", "missing", ("contract_value",)),
    ("accounts", "duplicate", ("account_id",)),
    ("accounts", "range", ("contract_value", 0, 10_000_000)),
    ("contacts", "missing", ("contact_id",)),
    ("contacts", "missing", ("account_id",)),
    ("contacts", "duplicate", ("contact_id",)),
    ("contacts", "orphan", ("account_id", "accounts", "account_id")),
    ("opportunities", "duplicate", ("opportunity_id",)),
    ("opportunities", "orphan", ("account_id", "accounts", "account_id")),
    ("customer_success", "orphan", ("account_id", "accounts", "account_id")),
    ("customer_success", "order", ("handoff_created_at", "handoff_accepted_at")),
    ("customer_success", "order", ("onboarding_started_at", "onboarding_completed_at")),
    ("support_tickets", "duplicate", ("ticket_id",)),
    ("support_tickets", "orphan", ("account_id", "accounts", "account_id")),
    ("support_tickets", "order", ("created_date", "resolved_date")),
    ("support_tickets", "status", ("status", "resolved_date", "Resolved")),
    ("product_usage", "orphan", ("account_id", "accounts", "account_id")),
    ("product_usage", "range", ("feature_usage_pct", 0, 100)),
    ("surveys", "orphan", ("account_id", "accounts", "account_id")),
    ("surveys", "range", ("csat_score", 0, 100)),
    ("surveys", "range", ("nps_score", -100, 100)),
    ("renewals", "duplicate", ("renewal_id",)),
    ("renewals", "orphan", ("account_id", "accounts", "account_id")),
)
# kind: severity, check name, detail after the count; numbers stand for the rule's arguments
QUALITY_TEXTS = {
    "missing": ("critical", "missing_{0}", " rows missing required field '{0}'"),
    "duplicate": ("critical", "duplicate_primary_key", " duplicate values in '{0}'"),
    "orphan": (
        "critical",
        "orphan_foreign_key",
        " rows in {table} reference a non-existent {2}",
    ),
    "order": (
        "critical",
        "invalid_date_order_{0}_{1}",
        " rows where {1} is earlier than {0}",
    ),
    "range": (
        "warning",
        "out_of_range_{0}",
        " rows where {0} is outside expected range [{1}, {2}]",
    ),
    "status": (
        "warning",
        "status_date_mismatch_{0}",
        " rows with status '{2}' but no {1}",
    ),
    "size": ("size", "records", " rows"),
}
CRITICAL_ISSUE_PENALTY = 2
WARNING_ISSUE_PENALTY = 1

# --- sources ----------------------------------------------------------------

# how common databases say that a table is not there
ABSENT_TABLE_MESSAGES = ("does not exist", "doesn't exist", "no such table", "not found")
