"""Raw -> bronze: typed, projected, one city and one aligned date per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weathermart.functions.cities import assign_city
from weathermart.functions.temporal import parse_timestamp, shift_date
from weathermart.schemas import check_contract

# Sales of 2010-2011 move by twelve years to meet the weather of 2022-2024.
SHIFT_MONTHS = 144


def with_customer(raw: DataFrame) -> DataFrame:
    """Invoice lines that name a customer."""
    return raw.filter(F.col("CustomerID").isNotNull())


def customer_int(customer_id: Column) -> Column:
    """Integer id from a number or from text such as ``17850.0``; bad text gives null."""
    return customer_id.try_cast("double").try_cast("int")


def invoice_timestamp(raw: DataFrame) -> Column:
    """The invoice moment; text is parsed, real timestamps pass through."""
    moment = F.col("InvoiceDate")
    if isinstance(raw.schema["InvoiceDate"].dataType, StringType):
        return parse_timestamp(moment)
    return F.to_timestamp(moment)


def sales(
    raw: DataFrame,
    cities: Sequence[str] | None = None,
    shift_months: int = SHIFT_MONTHS,
) -> DataFrame:
    """Bronze sales, one row per invoice line with a customer.

    A narrow projection of the raw scan: no shuffle, and the customer filter and
    the column list reach the Parquet reader. ``Country`` resolves either case.
    """
    lines = with_customer(raw).withColumn("CustomerID", customer_int(F.col("CustomerID")))
    return check_contract(
        lines.select(
            "InvoiceNo",
            "StockCode",
            "Description",
            F.col("Quantity").cast("int").alias("Quantity"),
            F.col("UnitPrice").cast("double").alias("UnitPrice"),
            "CustomerID",
            F.col("Country").alias("Country"),
            assign_city("CustomerID", cities).alias("city"),
            shift_date(invoice_timestamp(lines), shift_months).alias("date"),
        ),
        "bronze_sales",
    )


def zip_days(documents: DataFrame) -> DataFrame:
    """One row per city and day from documents of parallel arrays.

    Arrays of unequal length pad with nulls; an empty or missing series gives no
    rows. Keeps the ``extracted_at`` stamp for ``dedupe.latest_weather``.
    """
    series = F.arrays_zip(
        F.col("daily.time"),
        F.col("daily.temperature_2m_max"),
        F.col("daily.temperature_2m_min"),
        F.col("daily.precipitation_sum"),
    )
    return documents.select(
        "city", F.col("_meta.extracted_at").alias("extracted_at"), F.inline(series)
    ).select(
        "city",
        F.col("time").alias("date"),
        F.col("temperature_2m_max").alias("temp_max"),
        F.col("temperature_2m_min").alias("temp_min"),
        F.col("precipitation_sum").alias("precipitation"),
        "extracted_at",
    )


def weather(documents: DataFrame) -> DataFrame:
    """Bronze weather, one row per city, day and document; ``date`` stays text."""
    return check_contract(zip_days(documents).drop("extracted_at"), "bronze_weather")
