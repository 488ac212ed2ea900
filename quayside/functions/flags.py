"""Availability flags, scores and rating bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens read as available / unavailable after trim + lower;
# anything else (including NULL) counts as unavailable.
AVAILABLE_TOKENS = ["1", "y", "yes", "true", "available"]
UNAVAILABLE_TOKENS = ["0", "n", "no", "false", "unavailable"]

# The two scores and their bands (inclusive ranges -> label)
SUPPLY_COLUMNS = ["supplies_provisions", "supplies_fuel_oil", "supplies_diesel_oil",
                  "supplies_potable_water", "repairs"]
SUPPLY_BANDS = [(5, 5, "Excellent"), (3, 4, "Good"), (1, 2, "Limited")]
COMMUNICATION_COLUMNS = ["communications_radio", "communications_telephone",
                         "communications_airport", "communications_telefax"]
COMMUNICATION_BANDS = [(4, 4, "Excellent"), (3, 3, "Good"), (1, 2, "Limited")]
BAND_OTHERWISE = "Unavailable"


def availability_flag(c) -> Column:
    v = F.lower(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")))
    return F.when(v.isin(*AVAILABLE_TOKENS), F.lit(1)).otherwise(F.lit(0))


def band(c, bands, otherwise: str = BAND_OTHERWISE) -> Column:
    """Label a number by inclusive ``(low, high, label)`` ranges."""
    v = F.col(c) if isinstance(c, str) else c
    expr = None
    for lo, hi, label in bands:
        cond = v.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def availability_score(df: DataFrame, columns, count_col: str, rate_col: str, bands) -> DataFrame:
    total = None
    for c in columns:
        total = availability_flag(c) if total is None else total + availability_flag(c)
    return df.withColumns({count_col: total}).withColumn(rate_col, band(count_col, bands))


def add_supply_metrics(df: DataFrame) -> DataFrame:
    return availability_score(df, SUPPLY_COLUMNS, "supplies_count", "supplies_rate", SUPPLY_BANDS)


def add_communication_metrics(df: DataFrame) -> DataFrame:
    return availability_score(df, COMMUNICATION_COLUMNS, "communications_count", "comm_rate",
                              COMMUNICATION_BANDS)
