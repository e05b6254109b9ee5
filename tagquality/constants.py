"""Literals that must be spelled exactly so for results to come out right."""

# Tag names read by the reports.
TENANT_TAG = "tenant"
PROJECT_TAG = "askid"
MONITOR_TAG = "dqm_monitor"
MONITOR_VALUE = "enabled"
EXCLUDE_TAG = "dqm_exclude"
EXCLUDE_VALUE = "true"

# Billing.
MONITORING_PRODUCT = "DATA_QUALITY_MONITORING"
SCANNING_COST_CENTER = "DQ-Scanning"
OPEN_END = "2099-12-31"

# Health status, compared in upper case.
HEALTHY = "HEALTHY"

# Coverage of schemas by scans.
SCANNED = "DQM ENABLED"
NOT_SCANNED = "NOT ENABLED"
SYSTEM_CATALOGS = ("system", "hive_metastore")

# Seed rules for person names, and the e-mail rule.
NAME_RULE = (
    "{col} IS NOT NULL AND LENGTH(TRIM({col})) >= 1 "
    "AND {col} RLIKE '^[A-Za-z][A-Za-z'' -]*$'"
)
EMAIL_RULE = "{col} IS NOT NULL AND {col} RLIKE '^[^@\\\\s]+@[^@\\\\s]+\\\\.[^@\\\\s]+$'"

# Score limits: rates for single results, scores for whole tables.
RATE_PASS, RATE_WARN = 5, 20
SCORE_PASS, SCORE_WARN = 95, 80
