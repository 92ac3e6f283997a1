"""Data-quality checks over the gold table; each returns a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by date and city: any ten are a sample, these are the same every time."""
    return df.orderBy("date", "city").limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def cities(df: DataFrame) -> DataFrame:
    return df.select("city").distinct()


def average_sales(df: DataFrame, by: str) -> DataFrame:
    """Unrounded mean of daily sales per value of ``by``, highest first."""
    return (
        df.groupBy(by)
        .agg(F.avg("total_sales").alias("avg_sales"))
        .orderBy(F.desc("avg_sales"), by)
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls in every column, in one pass and one row."""
    return df.agg(*(F.sum(F.col(c).isNull().cast("int")).alias(c) for c in df.columns))
