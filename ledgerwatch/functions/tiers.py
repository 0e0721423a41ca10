"""Account tiers and their high-value limits (PRJ4, PRJ5, FN5)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# High-value limit per tier.
TIER_LIMITS = {"STANDARD": 50000, "PREMIUM": 100000, "ELITE": 500000}
DEFAULT_TIER = "STANDARD"


def _money(value) -> Column:
    return F.lit(Decimal(str(value))).cast("decimal(15,2)")


def normalise_tier(tier: Column, known: Mapping = TIER_LIMITS,
                   default: str = DEFAULT_TIER) -> Column:
    """Upper-cased tier name; unknown, padded or null text is ``default``."""
    upper = F.upper(tier)
    return F.when(upper.isin(*known), upper).otherwise(F.lit(default))


def tier_threshold(tier: Column, limits: Mapping = TIER_LIMITS,
                   default: str = DEFAULT_TIER) -> Column:
    """Limit of a raw tier string as DECIMAL(15,2)."""
    upper = F.upper(tier)
    limit = F
    for name, value in limits.items():
        if name != default:
            limit = limit.when(upper == name, _money(value))
    if limit is F:
        return _money(limits[default])
    return limit.otherwise(_money(limits[default]))


def lowest_limit(limits: Mapping = TIER_LIMITS) -> Column:
    """No amount up to this one can exceed any tier's limit."""
    return _money(min(Decimal(str(v)) for v in limits.values()))
