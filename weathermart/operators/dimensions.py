"""Date, location and product dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.functions.keys import with_dense_id
from weathermart.schemas import check_contract


def distinct_dates(gold: DataFrame) -> DataFrame:
    return gold.select("date").distinct()


def distinct_cities(gold: DataFrame) -> DataFrame:
    return gold.select("city").distinct()


def distinct_products(lines: DataFrame) -> DataFrame:
    """Distinct (code, trimmed description) pairs; case is kept."""
    return lines.select(
        F.col("StockCode").alias("stock_code"),
        F.trim("Description").alias("product_description"),
    ).distinct()


def named_products(products: DataFrame) -> DataFrame:
    """Products with a code and a non-blank description."""
    return products.filter(
        F.col("stock_code").isNotNull()
        & F.col("product_description").isNotNull()
        & (F.col("product_description") != "")
    )


def dim_date(gold: DataFrame) -> DataFrame:
    """Calendar parts per trading date; ``day_of_week`` 1 is Sunday, weeks are ISO."""
    date = F.col("date")
    return check_contract(
        distinct_dates(gold).select(
            "date",
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofmonth(date).alias("day"),
            F.dayofweek(date).alias("day_of_week"),
            F.weekofyear(date).alias("week_of_year"),
            date.cast("string").alias("date_id"),
        ),
        "dim_date",
    )


# Numbers distinct members by their key columns: ``(members, keys, id column)``.
Numbering = Callable[[DataFrame, list[str], str], DataFrame]


def dim_location(gold: DataFrame, number: Numbering = with_dense_id) -> DataFrame:
    """Cities with an id; ``number`` may look ids up in a key table instead."""
    return check_contract(number(distinct_cities(gold), ["city"], "location_id"), "dim_location")


def dim_product(lines: DataFrame, number: Numbering = with_dense_id) -> DataFrame:
    """Products by (code, description): a code with several descriptions has several rows."""
    members = named_products(distinct_products(lines))
    return check_contract(number(members, ["stock_code", "product_description"], "product_id"), "dim_product")
