"""Report settings that fit the years of the test tables."""

from __future__ import annotations

from fieldledger.functions.dates import year_start
from fieldledger.plans.report import Settings
from fieldledger.sources.adapter import AS_OF

SETTINGS = Settings(
    AS_OF,
    visit_years=(2000, 2001),
    churn_past=(1999, 2000),
    churn_current=(2001,),
    completed_since=year_start(1996),
)
