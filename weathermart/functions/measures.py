"""Flags, buckets and rounding used by gold, the facts and the reports."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rain_flag(precipitation: Column) -> Column:
    """1 if any precipitation fell, else 0; a missing reading counts as dry."""
    return F.when(precipitation > 0, 1).otherwise(0)


def temperature_bucket(avg_temp: Column, cold_below: float = 10, hot_from: float = 20) -> Column:
    """Cold / Moderate / Hot; a missing temperature ends in Hot, the last branch."""
    return (
        F.when(avg_temp < cold_below, "Cold").when(avg_temp < hot_from, "Moderate").otherwise("Hot")
    )


def sales_bucket(total: Column, medium_from: float = 500, high_from: float = 2000) -> Column:
    """Low / Medium / High; a missing total ends in High, the last branch."""
    return F.when(total < medium_from, "Low").when(total < high_from, "Medium").otherwise("High")


def rolling_sales(frame: str = "rows") -> Column:
    """Rolling mean of ``total_sales`` per city in date order.

    ``rows`` (default) averages the current row and up to seven rows before it:
    eight rows, whatever dates they carry. ``days`` averages the seven calendar
    days that end with the current one. Both run on one row per city and day, so
    a city's window holds at most its number of trading days.
    """
    by_city = Window.partitionBy("city")
    if frame == "rows":
        window = by_city.orderBy("date").rowsBetween(-7, Window.currentRow)
    elif frame == "days":
        window = by_city.orderBy(F.unix_date("date")).rangeBetween(-6, Window.currentRow)
    else:
        raise ValueError(f"unknown rolling frame {frame!r}; use 'rows' or 'days'")
    return F.avg("total_sales").over(window)


def round_half_up(value: Column, places: int = 2) -> Column:
    """Round a double through DECIMAL, so ties do not hang on binary noise."""
    return F.round(value.cast("decimal(38,6)"), places).cast("double")
