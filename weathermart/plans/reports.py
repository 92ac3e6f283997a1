"""The ten reports. Each takes a table and returns a frame, sorted for reading.

Sort keys end with the grouping columns, so equal figures keep one order and
top-k rows do not change between runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.functions.temporal import weekday_name
from weathermart.operators.gold import join_weather


def register_views(gold: DataFrame, fact_product: DataFrame | None = None) -> None:
    """Name the tables for SQL: ``sales_weather`` and ``fact_sales_weather_product``."""
    gold.createOrReplaceTempView("sales_weather")
    if fact_product is not None:
        fact_product.createOrReplaceTempView("fact_sales_weather_product")


def _average(gold: DataFrame, *keys: str | Column) -> DataFrame:
    return gold.groupBy(*keys).agg(F.round(F.avg("total_sales"), 2).alias("avg_sales"))


def _revenue(gold: DataFrame, *keys: Column) -> DataFrame:
    return gold.groupBy(*keys).agg(F.round(F.sum("total_sales"), 2).alias("revenue"))


def temperature(gold: DataFrame) -> DataFrame:
    """R1: mean daily sales by temperature bucket."""
    return _average(gold, "temp_category").orderBy(F.desc("avg_sales"), "temp_category")


def monthly(gold: DataFrame) -> DataFrame:
    """R2: revenue by month of year, all years together."""
    return _revenue(gold, F.month("date").alias("month")).orderBy("month")


def city(gold: DataFrame) -> DataFrame:
    """R3: mean daily sales by city."""
    return _average(gold, "city").orderBy(F.desc("avg_sales"), "city")


def rain(gold: DataFrame) -> DataFrame:
    """R4: mean daily sales on dry (0) and rainy (1) days."""
    return _average(gold, "is_rainy").orderBy("is_rainy")


def top_days(gold: DataFrame, rows: int = 10) -> DataFrame:
    """R5: the city-days with the highest sales."""
    return (
        gold.select("date", "city", "total_sales")
        .orderBy(F.desc("total_sales"), "date", "city")
        .limit(rows)
    )


def top_days_label(gold: DataFrame, rows: int = 10) -> DataFrame:
    """R5 with the label ``date (city)``."""
    return top_days(gold, rows).withColumn(
        "label", F.concat(F.col("date").cast("string"), F.lit(" ("), "city", F.lit(")"))
    )


def weekly(gold: DataFrame) -> DataFrame:
    """R6: mean daily sales by ISO week."""
    return _average(gold, F.weekofyear("date").alias("week")).orderBy("week")


def day_of_week(gold: DataFrame) -> DataFrame:
    """R7: mean daily sales by weekday name of the aligned date."""
    return _average(gold, weekday_name(F.col("date")).alias("day_name")).orderBy(
        F.desc("avg_sales"), "day_name"
    )


def peak_conditions(gold: DataFrame, rows: int = 10) -> DataFrame:
    """R8: the best (city, temperature bucket, rain) combinations."""
    keys = ("city", "temp_category", "is_rainy")
    return _average(gold, *keys).orderBy(F.desc("avg_sales"), *keys).limit(rows)


def growth(gold: DataFrame) -> DataFrame:
    """R9: revenue by year and month."""
    keys = (F.year("date").alias("year"), F.month("date").alias("month"))
    return _revenue(gold, *keys).orderBy("year", "month")


_PEAK = ("city", "temp_category", "is_rainy")
# Aggregated report -> columns, figure, and whether the best figure goes first.
_GROUPED = {
    "temperature": (("temp_category",), "avg_sales", True),
    "monthly": (("month",), "revenue", False),
    "city": (("city",), "avg_sales", True),
    "rain": (("is_rainy",), "avg_sales", False),
    "weekly": (("week",), "avg_sales", False),
    "day_of_week": (("day_name",), "avg_sales", True),
    "peak_conditions": (_PEAK, "avg_sales", True),
    "growth": (("year", "month"), "revenue", False),
}


def grouped(gold: DataFrame) -> DataFrame:
    """The figures of all aggregated reports in one scan: a row per report and group.

    Columns: report, every grouping column (null where the report has it not), avg_sales and
    revenue. One Expand feeds one partial aggregate, so what is shuffled is a row per task and
    group, not per day.
    """
    date = F.col("date")
    days = gold.select(
        "temp_category", "city", "is_rainy", F.month(date).alias("month"), F.year(date).alias("year"),
        F.weekofyear(date).alias("week"), weekday_name(date).alias("day_name"), "total_sales",
    )
    columns = [c for c in days.columns if c != "total_sales"]
    sets = [keys for keys, *_ in _GROUPED.values()]
    # A bit of the id is set where the column is not part of the group.
    report = F.lit(None).cast("string")
    for name, (keys, *_) in _GROUPED.items():
        absent = sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys)
        report = F.when(F.grouping_id() == absent, name).otherwise(report)
    return days.groupingSets([[F.col(c) for c in keys] for keys in sets], *columns).agg(
        report.alias("report"),
        F.round(F.avg("total_sales"), 2).alias("avg_sales"),
        F.round(F.sum("total_sales"), 2).alias("revenue"),
    )


def from_grouped(table: DataFrame, name: str, rows: int = 10) -> DataFrame:
    """One report, as its own function gives it, from a written ``grouped`` table."""
    keys, figure, best_first = _GROUPED[name]
    found = table.filter(F.col("report") == name).select(*keys, figure)
    found = found.orderBy(F.desc(figure), *keys) if best_first else found.orderBy(*keys)
    return found.limit(rows) if name == "peak_conditions" else found


def _top_products(totals: DataFrame, rows: int) -> DataFrame:
    return totals.orderBy(
        F.desc("total_revenue"), F.asc_nulls_first("product_description")
    ).limit(rows)


def rainy_products(fact_product: DataFrame, rows: int = 15) -> DataFrame:
    """R10: best-selling products on rainy days, from the line-grain fact."""
    return _top_products(
        fact_product.filter(F.col("is_rainy") == 1)
        .groupBy("product_description")
        .agg(
            F.sum("total_price").alias("total_revenue"),
            F.sum("Quantity").alias("total_units"),
        ),
        rows,
    )


def rainy_products_from_lines(
    lines: DataFrame, weather: DataFrame, dim_product: DataFrame, rows: int = 15
) -> DataFrame:
    """R10 without building the fact table, with the same figures.

    The fact repeats a line once per description of its code. Here lines are
    first summed per code and description, then multiplied by the number of
    descriptions: the join sees one row per product instead of every repeated
    line, and a hot code weighs no more than any other.
    """
    rainy = weather.filter(F.col("precipitation") > 0).select("date", "city")
    sold = (
        join_weather(lines, rainy)
        .groupBy("StockCode", "Description")
        .agg(F.sum("total_price").alias("revenue"), F.sum("Quantity").alias("units"))
    )
    repeats = dim_product.groupBy(F.col("stock_code").alias("StockCode")).agg(
        F.count(F.lit(1)).alias("repeats")
    )
    weight = F.coalesce("repeats", F.lit(1))
    return _top_products(
        sold.join(repeats, "StockCode", "left")
        .groupBy(F.col("Description").alias("product_description"))
        .agg(
            F.sum(F.col("revenue") * weight).alias("total_revenue"),
            F.sum(F.col("units") * weight).alias("total_units"),
        ),
        rows,
    )


# Report functions over the gold table, by name.
GOLD_REPORTS = {
    "temperature": temperature,
    "monthly": monthly,
    "city": city,
    "rain": rain,
    "top_days": top_days,
    "weekly": weekly,
    "day_of_week": day_of_week,
    "peak_conditions": peak_conditions,
    "growth": growth,
}
