"""Calendar and reference dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.keys import date_key, time_key
from quayside.operators.dedupe import dedupe
from quayside.operators.keys import assign_surrogate_keys

DATE_COLUMNS = ["DATE_KEY", "FULL_DATE", "DAY", "MONTH", "MONTH_NAME", "QUARTER", "YEAR", "WEEK_OF_YEAR",
                "DAY_OF_WEEK", "DAY_NAME", "IS_WEEKEND"]
TIME_COLUMNS = ["TIME_KEY", "HOUR", "MINUTE", "SECOND", "HOUR_MINUTE"]


def date_attributes(d) -> list:
    """The DIM_DATE columns for a date column ``d`` (ISO week; ISO weekday
    1 = Monday ... 7 = Sunday)."""
    d = F.col(d) if isinstance(d, str) else d
    iso_dow = F.weekday(d) + 1
    return [
        date_key(d).alias("DATE_KEY"), d.alias("FULL_DATE"),
        F.dayofmonth(d).alias("DAY"), F.month(d).alias("MONTH"),
        F.date_format(d, "MMMM").alias("MONTH_NAME"), F.quarter(d).alias("QUARTER"),
        F.year(d).alias("YEAR"), F.weekofyear(d).alias("WEEK_OF_YEAR"),
        iso_dow.alias("DAY_OF_WEEK"), F.date_format(d, "EEEE").alias("DAY_NAME"),
        (iso_dow >= 6).alias("IS_WEEKEND"),
    ]


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end], generated in parallel from a range."""
    days = (end - start).days + 1
    base = F.lit(start).cast("date")
    return spark.range(0, max(days, 0)).select(F.date_add(base, F.col("id").cast("int")).alias("d")) \
        .select(*date_attributes("d"))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    s = F.col("id").cast("int")
    h, m, sec = (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), s % 60
    return spark.range(0, 86400).select(
        (h * 10000 + m * 100 + sec).alias("TIME_KEY"), h.alias("HOUR"), m.alias("MINUTE"),
        sec.alias("SECOND"), F.format_string("%02d:%02d", h, m).alias("HOUR_MINUTE"))


def quake_keys(quakes: DataFrame, time_col: str = "time", lastupdate_col: str | None = None,
               event_date_col: str | None = None) -> dict:
    """The integer date/time keys the semantic model derives from a quake."""
    out = {"TIME_DATE_KEY": date_key(time_col), "TIME_TIME_KEY": time_key(time_col)}
    if lastupdate_col:
        out["LAST_UPDATE_DATE_KEY"] = date_key(lastupdate_col)
        out["LAST_UPDATE_TIME_KEY"] = time_key(lastupdate_col)
    out["EVENT_DATE_KEY"] = date_key(F.to_date(event_date_col or time_col))
    return out


def dim_country(countries: DataFrame, code_col: str, name_col: str, existing: DataFrame | None = None) -> DataFrame:
    """DIM_COUNTRY: distinct (code, name), keyed incrementally."""
    distinct = dedupe(countries.select(code_col, name_col), [code_col], order=[name_col], keep="first")
    keyed = assign_surrogate_keys(distinct, existing, code_col, "COUNTRY_KEY")
    return keyed.select("COUNTRY_KEY", F.col(code_col).alias("COUNTRY_CODE"), F.col(name_col).alias("COUNTRY_NAME"))


def dim_vessel(vessels: DataFrame, existing: DataFrame | None = None, link_col: str = "detail_link",
               order: list[str] | None = None) -> DataFrame:
    """DIM_VESSEL: one row per detail link (the only unique identifier),
    keyed incrementally."""
    one = dedupe(vessels, [link_col], order=order or [], keep="last")
    return assign_surrogate_keys(one, existing, link_col, "VESSEL_KEY")
