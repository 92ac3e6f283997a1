"""Silver -> gold: daily sales joined with daily weather, plus features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.functions.measures import (
    rain_flag,
    rolling_sales,
    sales_bucket,
    temperature_bucket,
)
from weathermart.schemas import check_contract


def join_weather(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join on (date, city); works at daily and at line grain.

    No hint: weather read from a written table has a known size and is broadcast
    while it is small; otherwise adaptive execution splits skewed (date, city)
    pairs of a sort-merge join.
    """
    return sales.join(weather, ["date", "city"], "inner")


def sales_weather(daily: DataFrame, weather: DataFrame, frame: str = "rows") -> DataFrame:
    """The gold table: one row per date and city with flags, buckets and rolling mean."""
    return check_contract(
        join_weather(daily, weather).withColumns(
            {
                "is_rainy": rain_flag(F.col("precipitation")),
                "temp_category": temperature_bucket(F.col("avg_temp")),
                "sales_category": sales_bucket(F.col("total_sales")),
                "rolling_7d_sales": rolling_sales(frame),
            }
        ),
        "gold_sales_weather",
    )
