"""Daily fact and line-grain fact of the star schema.

Joins carry no hints: dimensions are passed as written tables, so Spark compares
their size with the broadcast threshold, and larger ones are sort-merged with
adaptive splitting of hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.functions.measures import rain_flag, temperature_bucket
from weathermart.operators.gold import join_weather
from weathermart.schemas import check_contract


def sales_weather(gold: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Gold rows with date and location keys."""
    return check_contract(
        gold.join(dim_date.select("date", "date_id"), "date")
        .join(dim_location.select("city", "location_id"), "city")
        .select(
            "date_id",
            "location_id",
            "total_sales",
            "avg_temp",
            "precipitation",
            "is_rainy",
            "rolling_7d_sales",
        ),
        "fact_sales_weather",
    )


def join_products(lines: DataFrame, dim_product: DataFrame, match: str = "code") -> DataFrame:
    """Left join of lines to product ids; lines without a product keep a null id.

    ``code`` (default) matches the stock code alone: a line repeats once for every
    description its code has, which also repeats its revenue.
    ``code_and_description`` matches the trimmed description too, so each line
    stays one line.
    """
    if match == "code":
        keys = dim_product.select(F.col("stock_code").alias("__code"), "product_id")
        condition = F.col("StockCode") == F.col("__code")
    elif match == "code_and_description":
        keys = dim_product.select(
            F.col("stock_code").alias("__code"),
            F.col("product_description").alias("__description"),
            "product_id",
        )
        condition = (F.col("StockCode") == F.col("__code")) & (
            F.trim("Description") == F.col("__description")
        )
    else:
        raise ValueError(f"unknown product match {match!r}")
    return lines.join(keys, condition, "left").drop("__code", "__description")


def sales_weather_product(
    lines: DataFrame,
    weather: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
    dim_product: DataFrame,
    match: str = "code",
) -> DataFrame:
    """Line-grain fact; the description is the sales text as it was entered."""
    keyed = (
        join_weather(lines, weather)
        .join(dim_date.select("date", "date_id"), "date")
        .join(dim_location.select("city", "location_id"), "city")
    )
    return check_contract(
        join_products(keyed, dim_product, match).select(
            "date_id",
            "location_id",
            "product_id",
            F.col("StockCode").alias("stock_code"),
            F.col("Description").alias("product_description"),
            "Quantity",
            "UnitPrice",
            "total_price",
            "avg_temp",
            "precipitation",
            rain_flag(F.col("precipitation")).alias("is_rainy"),
            temperature_bucket(F.col("avg_temp")).alias("temp_category"),
        ),
        "fact_sales_weather_product",
    )
