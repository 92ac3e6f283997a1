"""Bronze -> silver: cleaned lines, the daily roll-up and daily weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weathermart.schemas import check_contract


def positive_lines(bronze_sales: DataFrame) -> DataFrame:
    """Drop returns, free lines and lines without quantity or price."""
    return bronze_sales.filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))


def product_grain(bronze_sales: DataFrame) -> DataFrame:
    """Cleaned invoice lines with their total; a narrow step without a shuffle."""
    return check_contract(
        positive_lines(bronze_sales).select(
            "date",
            "city",
            "StockCode",
            "Description",
            "Quantity",
            "UnitPrice",
            (F.col("Quantity") * F.col("UnitPrice")).alias("total_price"),
        ),
        "silver_product_grain",
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """Sales per date and city from product-grain lines.

    Partial sums shrink the data to one row per task, date and city before the
    only shuffle, so a hot day or city moves no more rows than any other.
    """
    return check_contract(
        lines.groupBy("date", "city").agg(F.sum("total_price").alias("total_sales")),
        "silver_sales_daily",
    )


def weather(bronze_weather: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Daily weather with a real DATE key, cast once here instead of in every join.

    A date that cannot be read could never match a sale, so its row is dropped;
    ``observation`` counts these as ``unreadable_dates``.
    """
    days = bronze_weather.select(
        F.col("date").try_cast("date").alias("date"),
        "city",
        ((F.col("temp_max") + F.col("temp_min")) / 2).alias("avg_temp"),
        "precipitation",
    )
    if observation is not None:
        days = days.observe(observation, F.count_if(F.col("date").isNull()).alias("unreadable_dates"))
    return check_contract(days.filter(F.col("date").isNotNull()), "silver_weather")
