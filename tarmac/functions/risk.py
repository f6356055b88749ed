"""Severity and risk rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.choose import first_match

# Codes, limits and texts the results must show.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
CREW_TYPES = ("CREW_SICK", "CREW_TIMEOUT")
IMPACTED_STATUSES = ("DELAYED", "CANCELLED")
UNAVAILABLE_STATUSES = ("SICK", "GROUNDED")
LONG_DELAY_MINS = 240
SHORT_DELAY_MINS = 60
REASON_CRITICAL = "CRITICAL severity crew disruption on flight"
REASON_CREW = "Multiple crew members disrupted on same flight"
REASON_LONG = "Cumulative delay exceeds 4 hours"
REASON_HIGH = "HIGH severity crew disruption on flight"
REASON_SHORT = "Cumulative delay exceeds 1 hour"
REASON_NONE = "Within acceptable disruption thresholds"


def severity_rank(severity: Column) -> Column:
    """1 is the most severe; anything that is not one of the first three ranks 4."""
    ranks = [(severity == name, F.lit(position)) for position, name in enumerate(SEVERITIES[:3], start=1)]
    return first_match(ranks, F.lit(4))


def risk_flag(critical: Column, high: Column, medium: Column, delay: Column, crew: Column) -> Column:
    high_risk = (high > 0) | (delay >= LONG_DELAY_MINS) | (crew > 1)
    medium_risk = (medium > 0) | (delay >= SHORT_DELAY_MINS)
    flags = [(critical > 0, "CRITICAL"), (high_risk, "HIGH"), (medium_risk, "MEDIUM")]
    return first_match([(holds, F.lit(flag)) for holds, flag in flags], F.lit("NORMAL"))


def risk_reason(critical: Column, high: Column, delay: Column, crew: Column) -> Column:
    """First rule that holds. The order is not that of ``risk_flag``, and MEDIUM counts have no text."""
    rules = (
        (critical > 0, REASON_CRITICAL),
        (crew > 1, REASON_CREW),
        (delay >= LONG_DELAY_MINS, REASON_LONG),
        (high > 0, REASON_HIGH),
        (delay >= SHORT_DELAY_MINS, REASON_SHORT),
    )
    return first_match([(holds, F.lit(reason)) for holds, reason in rules], F.lit(REASON_NONE))
