"""Registered queries: name -> function of (spark, data folder)."""

from __future__ import annotations

from checks.operators import OPERATORS
from checks.settings import SETTINGS
from fieldledger.plans import billing, field_work, next_service, quality  # noqa: F401  (fill the report list)
from fieldledger.plans.report import REPORTS
from fieldledger.sources.adapter import domain_tables

# Registered number and report, in the order of the blueprint.
REPORT_IDS = {
    "r01_primary_hood_v1": "primary_hood_next_service",
    "r02_primary_hood_v2": "primary_hood_next_service_v2",
    "r03_primary_hood_v3": "primary_hood_next_service_v3",
    "r04_primary_hood_duplicates": "primary_hood_duplicates",
    "r05_active_locations_cleaning": "active_locations_cleaning",
    "r06_appointment_cancellations": "appointment_cancellations",
    "r07_ar_aging": "ar_aging",
    "r08_asset_inventory": "asset_inventory",
    "r09_assets_with_deficiencies": "assets_with_deficiencies",
    "r10_avg_days_to_payment": "avg_days_to_payment",
    "r11_compliance_overdue": "compliance_overdue",
    "r12_customer_churn_risk": "customer_churn_risk",
    "r13_deficiency_severity_by_customer": "deficiency_severity_by_customer",
    "r14_jobs_pending_invoice": "jobs_pending_invoice",
    "r15_jobs_without_invoice": "jobs_without_invoice",
    "r16_locations_no_recurrence": "locations_no_recurrence",
    "r17_locations_on_hold_with_recurrence": "locations_on_hold_with_recurrence",
    "r18_open_deficiencies": "open_deficiencies",
    "r19_overdue_invoices": "overdue_invoices",
    "r20_quote_acceptance": "quote_acceptance",
    "r21_revenue_by_customer": "revenue_by_customer",
    "r22_revenue_monthly": "revenue_monthly",
    "r23_stale_quotes": "stale_quotes",
    "r24_technician_workload": "technician_workload",
    "r25_visits": "visits",
}


def report_query(name: str):
    return lambda spark, sf_dir: REPORTS[name].frame(domain_tables(spark, sf_dir), SETTINGS)


def all_queries() -> dict:
    return {**{key: report_query(name) for key, name in REPORT_IDS.items()}, **OPERATORS}
