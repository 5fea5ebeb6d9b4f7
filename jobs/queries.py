"""The jobs as queries for the driver, and their SQL."""

from __future__ import annotations

from . import log_days, text_profiles

QUERIES = {"job1_text_profiles": text_profiles.query, "job2_log_days": log_days.query}
ORACLES = {"job1_text_profiles": text_profiles.ORACLE, "job2_log_days": log_days.ORACLE}
