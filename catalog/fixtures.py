"""Domain inputs derived from the driver tables, by Spark, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weathermart.functions.cities import assign_city
from weathermart.plans.mart import Mart, Options
from weathermart.sources.paths import materialize

# Moves 1995 to 2022, so that orders meet the weather of 2022-2024.
FIXTURE_OPTIONS = Options(shift_months=324)
UPLOAD_DATE = "M/d/yyyy H:mm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines with returns, free lines, missing customers and odd descriptions.

    Customers and nations are joined to orders, not to lines, so the line table
    takes part in two joins only.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "inner"
        )
        .join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "inner"
        )
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "inner")
    )
    returned = F.col("l_returnflag") == "R"
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    order_text = F.col("l_orderkey").cast("string")
    return lines.select(
        F.when(returned, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("InvoiceNo"),
        part.cast("string").alias("StockCode"),
        F.when(part % 50 == 0, "  ")
        .when(part % 50 == 1, F.lit(None))
        .when(line == 1, F.concat(F.lit(" "), "p_name"))
        .when(line == 7, F.upper("p_name"))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        F.when(returned, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("Quantity"),
        F.when((line == 6) & (part % 10 == 3), 0.0)
        .otherwise(F.round(F.col("l_extendedprice") / F.col("l_quantity")).cast("int") / 100.0)
        .alias("UnitPrice"),
        F.when(F.col("o_custkey") % 20 != 19, F.col("o_custkey").cast("double")).alias(
            "CustomerID"
        ),
        F.col("n_name").alias("Country"),
        F.col("o_orderdate").alias("InvoiceDate"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat weather, one row per city and day; at most five cities x 1,096 days."""
    whole = F.floor("value").cast("int")
    wet = F.when(F.col("event_type").isin("error", "view"), whole).otherwise(0)
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            assign_city("user_id").alias("city"),
            F.date_add(F.lit("2022-01-01").cast("date"), (F.col("event_id") % 1096).cast("int"))
            .cast("string")
            .alias("date"),
        )
        .agg(
            (F.max(whole) / 4.0).alias("temp_max"),
            (F.min(whole) / 4.0 - 5.0).alias("temp_min"),
            F.when(F.min("event_id") % 97 != 0, F.sum(wet) / 100.0).alias("precipitation"),
        )
    )


def mart(spark: SparkSession, sf_dir: str, options: Options = FIXTURE_OPTIONS) -> Mart:
    """One lazy plan per table."""
    return Mart(raw_sales(spark, sf_dir), raw_weather(spark, sf_dir), options)


def stored_mart(spark: SparkSession, sf_dir: str, options: Options = FIXTURE_OPTIONS) -> Mart:
    """Tables with several consumers are written once to the shared folder."""
    return Mart(raw_sales(spark, sf_dir), raw_weather(spark, sf_dir), options, materialize)


def upload_text(sales: DataFrame, date: Column | None = None) -> DataFrame:
    """Upload columns with the invoice date as the text a retail export holds, or as ``date``."""
    return sales.select(
        "InvoiceNo",
        "StockCode",
        "Description",
        "Quantity",
        (F.date_format("InvoiceDate", UPLOAD_DATE) if date is None else date).alias("InvoiceDate"),
        "UnitPrice",
        "CustomerID",
        "Country",
    )


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", *partition_cols: str) -> None:
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    df.write.mode("append").partitionBy(*partition_cols).options(
        header=True,
        encoding=encoding,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_one_csv(df: DataFrame, path: str, folder: str, name: str) -> None:
    """An upload of one file: all lines go through one task, as a retail export does."""
    write_csv(df.coalesce(1), path)
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    source = jvm.org.apache.hadoop.fs.Path(path)
    storage = source.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in storage.listStatus(source) if f.getPath().getName().endswith(".csv"))
    storage.rename(part, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


def weather_payloads(weather: DataFrame) -> DataFrame:
    """``city, year, payload``: one JSON document of parallel arrays per city and year.

    Packing gathers one calendar year of one city, at most 366 small structs.
    """
    days = F.sort_array(
        F.collect_list(F.struct("date", "temp_max", "temp_min", "precipitation"))
    ).alias("d")
    packed = weather.groupBy("city", F.substring("date", 1, 4).alias("year")).agg(days)
    return packed.select(
        "city",
        "year",
        F.struct(
            F.lit(51.5).alias("latitude"),
            F.lit(-0.13).alias("longitude"),
            F.lit("Europe/London").alias("timezone"),
            F.lit(25.5).alias("elevation"),
            F.struct(F.lit("iso8601").alias("time"), F.lit("mm").alias("precipitation_sum")).alias(
                "daily_units"
            ),
            F.struct(
                F.col("d.date").alias("time"),
                F.col("d.temp_max").alias("temperature_2m_max"),
                F.col("d.temp_min").alias("temperature_2m_min"),
                F.col("d.precipitation").alias("precipitation_sum"),
                F.transform("d", lambda day: F.lit(3).cast("bigint")).alias("weathercode"),
                F.col("d.temp_max").alias("sunshine_duration"),
            ).alias("daily"),
        ).alias("document"),
    ).select("city", "year", F.to_json("document").alias("payload"))


def damaged_payloads(weather: DataFrame) -> DataFrame:
    """The same documents, four of them broken in the four ways validation knows."""
    text = F.col("payload")

    def case(city: str, year: str):
        return (F.col("city") == city) & (F.col("year") == year)

    return weather_payloads(weather).withColumn(
        "payload",
        F.when(case("Leeds", "2023"), F.regexp_replace(text, r'"daily":\{', '"other":{'))
        .when(case("Glasgow", "2022"), F.regexp_replace(text, r'"time":\["[^\]]*\]', '"time":[]'))
        .when(case("Birmingham", "2024"), F.expr("left(payload, length(payload) - 30)"))
        .when(case("Manchester", "2022"), F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text),
    )


def write_payloads(payloads: DataFrame, path: str) -> None:
    """One file per document below ``city=<name>/``, as a landing folder holds them."""
    payloads.select(F.col("payload").alias("value"), "city").write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("city").text(path)
