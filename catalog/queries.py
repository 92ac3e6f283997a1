"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Sums and averages are rounded here, and only here where the table itself keeps
full doubles, because the order of floating-point additions differs by engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from weathermart.functions.cities import CITIES, assign_city
from weathermart.functions.keys import with_dense_id
from weathermart.functions.measures import (
    rain_flag,
    rolling_sales,
    round_half_up,
    sales_bucket,
    temperature_bucket,
)
from weathermart.operators import bronze, checks, dedupe, dimensions, facts, gold, rules, silver
from weathermart.plans import reports
from weathermart.schemas import RAW_SALES
from weathermart.sources import key_registry, tables, uploads, weather
from weathermart.sources.paths import materialize, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

# Stamps the queries pass in place of the clock.
STAMP_1 = "2025-01-01T00:00:00+00:00"
STAMP_2 = "2025-02-01T00:00:00+00:00"

SALES_PLACES = {"total_sales": 2, "rolling_7d_sales": 4}


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns(
        {name: round_half_up(F.col(name), n) for name, n in places.items() if name in df.columns}
    )


def _to_the_minute(df: DataFrame) -> DataFrame:
    return df.withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm"))


# --- sources and sinks -------------------------------------------------------


def scan_csv_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads in two encodings and three column orders, one of them with a column more."""
    path = scratch_dir(spark)
    text = materialize(
        fx.upload_text(fx.raw_sales(spark, sf_dir)).withColumn(
            "Description", F.concat("Description", F.lit(" é"))
        ),
        "upload_text",
    )
    returned = F.col("InvoiceNo").startswith("C")
    even = F.col("StockCode").cast("int") % 2 == 0
    turned = text.select(*reversed(text.columns))
    fx.write_csv(text.filter(~returned & even), path, "UTF-8")
    fx.write_csv(turned.filter(~returned & ~even), path, "UTF-8")
    fx.write_csv(turned.withColumn("Till", F.lit("t1")).filter(returned), path, "ISO-8859-1")
    return _to_the_minute(uploads.read_uploads(spark, path).drop("_metadata"))


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads whose customer numbers are whole in some files and doubles in others."""
    path = scratch_dir(spark)
    sales = materialize(fx.raw_sales(spark, sf_dir), "raw_sales")
    returned = F.col("InvoiceNo").startswith("C")
    whole = sales.withColumns({c: F.col(c).cast("bigint") for c in ("CustomerID", "Quantity")})
    sales.filter(returned).write.mode("append").parquet(path)
    whole.filter(~returned).write.mode("append").parquet(path)
    return _to_the_minute(uploads.read_uploads(spark, path).drop("_metadata"))


def upload_date_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day-first, a month-first and a mixed upload: dates as their own file's values have them."""
    folder, lake = scratch_dir(spark), scratch_dir(spark)
    sales = materialize(fx.raw_sales(spark, sf_dir), "raw_sales")
    third = F.col("StockCode").cast("int") % 3
    day_first = F.date_format("InvoiceDate", "d/M/yyyy H:mm")
    month_first = F.date_format("InvoiceDate", "M/d/yyyy H:mm")
    # Where both orders would read a date, the mixed upload has it month first.
    mixed = F.when(F.dayofmonth("InvoiceDate") > 27, day_first).otherwise(month_first)
    batches = {"day": (third == 0, day_first), "month": (third == 1, month_first), "mixed": (third == 2, mixed)}
    for name, (own, text) in batches.items():
        fx.write_one_csv(fx.upload_text(sales.filter(own), text), f"{folder}/{name}", folder, f"{name}.csv")
    path = uploads.land_uploads(spark, folder, lake, ingested_at=STAMP_1)
    return _to_the_minute(spark.read.schema(RAW_SALES).parquet(path)).select(
        "InvoiceNo", "StockCode", "InvoiceDate", "_source_file"
    )


def upload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that landing refuses, and how many it takes, by reason."""
    folder, lake = scratch_dir(spark), scratch_dir(spark)
    text = fx.upload_text(fx.raw_sales(spark, sf_dir))
    part = F.col("StockCode").cast("int")
    broken = text.withColumns(
        {
            "Quantity": F.when(part % 50 == 7, "many").otherwise(F.col("Quantity").cast("string")),
            "UnitPrice": F.when(part % 50 == 8, "?").otherwise(F.col("UnitPrice").cast("string")),
            "Description": F.when(part % 50 == 9, "cut\nhere").otherwise(F.col("Description")),
        }
    )
    fx.write_csv(broken, folder)
    path = uploads.land_uploads(spark, folder, lake, ingested_at=STAMP_1, on_error="reject")
    taken = spark.read.parquet(path).select(F.lit("").alias("reason"))
    refused = spark.read.parquet(uploads.report_path(lake, "rejects")).select("reason")
    return taken.unionByName(refused).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def add_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "_metadata"
    )
    return uploads.add_provenance(orders, "retail_sales", STAMP_1).drop("_metadata")


def validate_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    sales = fx.raw_sales(spark, sf_dir)
    text = fx.upload_text(sales)
    year = F.regexp_extract("InvoiceDate", r"/(\d{4}) ", 1)
    fx.write_csv(text.withColumn("batch", year), path, "UTF-8", "batch")
    fx.write_csv(text.filter(F.lit(False)), f"{path}/batch=none")
    return (
        uploads.validate_uploads(spark, f"{path}/*")
        .groupBy(F.regexp_extract("path", "batch=([^/]+)", 1).alias("batch"))
        .agg(F.sum("rows").alias("rows"), F.bool_and("accepted").alias("accepted"))
    )


def year_month_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fx.upload_text(fx.raw_sales(spark, sf_dir)).withColumn(
        "InvoiceDate",
        F.when(F.col("StockCode").endswith("7"), "not a date").otherwise(F.col("InvoiceDate")),
    )
    parted, _ = uploads.with_year_month(uploads.parse_date_column(text))
    return _to_the_minute(parted.select("InvoiceNo", "StockCode", "InvoiceDate", "year", "month"))


def raw_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, lake = scratch_dir(spark), scratch_dir(spark)
    fx.write_csv(fx.upload_text(fx.raw_sales(spark, sf_dir)), folder)
    path = uploads.land_uploads(spark, folder, lake, ingested_at=STAMP_1)
    return _to_the_minute(
        spark.read.parquet(path).withColumn("_source_file", F.regexp_extract("_source_file", r"\.\w+$", 0))
    )


def landing_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder landed twice, with one more upload in it the second time."""
    folder, lake = scratch_dir(spark), scratch_dir(spark)
    text = materialize(fx.upload_text(fx.raw_sales(spark, sf_dir)), "upload_text")
    late = F.col("InvoiceNo").startswith("C")
    fx.write_csv(text.filter(~late), folder)
    uploads.land_uploads(spark, folder, lake, ingested_at=STAMP_1, once=True)
    fx.write_csv(text.filter(late), folder)
    path = uploads.land_uploads(spark, folder, lake, ingested_at=STAMP_2, once=True)
    return spark.read.schema(RAW_SALES).parquet(path).select(
        "InvoiceNo", "StockCode", "Quantity", "_ingested_at"
    )


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    fx.write_payloads(fx.damaged_payloads(fx.raw_weather(spark, sf_dir)), path)
    return weather.read_payloads(spark, path)


def weather_payload_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("daily.time")
    return weather.valid_payloads(_landed(spark, sf_dir)).select(
        "city",
        F.array_min(time).alias("first_day"),
        F.array_max(time).alias("last_day"),
        F.size(time).alias("days"),
    )


def weather_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.rejected_payloads(_landed(spark, sf_dir)).select("city", "reason")


def weather_enrich_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = weather.valid_payloads(_landed(spark, sf_dir))
    return weather.enrich_payloads(valid, extracted_at=STAMP_1).select(
        "_meta.*", F.size("daily.time").alias("days")
    )


def weather_raw_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and series that no schema lists, as the raw layer holds them."""
    landing, lake = scratch_dir(spark), scratch_dir(spark)
    fx.write_payloads(fx.weather_payloads(fx.raw_weather(spark, sf_dir)), landing)
    path = weather.land_payloads(spark, landing, lake, extracted_at=STAMP_1)
    text = spark.read.schema("value string, city string").text(path, wholetext=True)
    kind = "elevation double, daily struct<time: array<string>, sunshine_duration: array<double>>, "
    doc = text.select("city", F.from_json("value", kind + "_meta struct<extracted_at: string>").alias("d"))
    return doc.select(
        "city",
        F.array_min("d.daily.time").alias("first_day"),
        F.size("d.daily.time").alias("days"),
        "d.elevation",
        F.aggregate("d.daily.sunshine_duration", F.lit(0.0), lambda a, x: a + x).alias("sunshine"),
        "d._meta.extracted_at",
    )


def raw_sales_mixed_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three uploads, landed one by one: undated, without a country, with one more column."""
    folder, lake = scratch_dir(spark), scratch_dir(spark)
    text = materialize(fx.upload_text(fx.raw_sales(spark, sf_dir)), "upload_text")
    third = F.col("StockCode").cast("int") % 3
    uploads_ = [
        text.filter(third == 0).drop("InvoiceDate"),
        text.filter(third == 1).drop("Country"),
        text.filter(third == 2).withColumn("GiftWrap", F.lit("no")),
    ]
    for number, upload in enumerate(uploads_):
        fx.write_csv(upload, f"{folder}/{number}")
        uploads.land_uploads(spark, f"{folder}/{number}", lake, ingested_at=STAMP_1)
    raw = spark.read.schema(RAW_SALES).parquet(f"{lake}/raw/retail_sales/uci_online_retail")
    return bronze.sales(raw, shift_months=fx.FIXTURE_OPTIONS.shift_months)


def read_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark)
    flat = fx.raw_weather(spark, sf_dir)
    flat.write.parquet(f"{root}/flat")
    fx.write_payloads(fx.weather_payloads(flat), f"{root}/documents")
    documents = tables.read(spark, f"{root}/documents", "json")
    days = documents.withColumn(
        "_meta", F.struct(F.lit(STAMP_1).alias("extracted_at"))
    ).transform(bronze.weather)
    columns = ("city", "date", "temp_max", "temp_min", "precipitation")
    return (
        tables.read(spark, f"{root}/flat", "parquet")
        .select(*columns, F.lit("parquet").alias("format"))
        .unionByName(days.select(*columns, F.lit("json").alias("format")))
    )


def write_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark)
    sales = fx.mart(spark, sf_dir).bronze_sales
    tables.write(sales, f"{root}/list", "parquet", ["city"])
    again = tables.read(spark, f"{root}/list")
    tables.write(again, f"{root}/text", "parquet", "Country", rebalance=True)
    tables.write(again, f"{root}/text", "parquet", "Country", mode="overwrite", rebalance=True)
    return tables.read(spark, f"{root}/text").select(
        "InvoiceNo", "StockCode", "Quantity", "CustomerID", "Country", "city", "date"
    )


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    days = fx.stored_mart(spark, sf_dir).silver_weather
    early = F.col("date") < "2023-01-01"
    tables.write(days.filter(early).drop("precipitation"), path, mode="append")
    tables.write(days.filter(~early), path, mode="append")
    return tables.read(spark, path, merge_schema=True).select(
        "date", "city", "avg_temp", "precipitation"
    )


# --- bronze and silver -------------------------------------------------------


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).bronze_sales


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake = scratch_dir(spark), scratch_dir(spark)
    fx.write_payloads(fx.weather_payloads(fx.raw_weather(spark, sf_dir)), landing)
    path = weather.land_payloads(spark, landing, lake, extracted_at=STAMP_1)
    return bronze.weather(weather.read_documents(spark, path))


def filter_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_customer(fx.raw_sales(spark, sf_dir)).select(
        "InvoiceNo", "StockCode", "CustomerID"
    )


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.positive_lines(fx.mart(spark, sf_dir).bronze_sales).select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice"
    )


def cast_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    text = F.when(
        F.col("o_orderpriority").startswith("1"), F.concat(F.lit("n/a "), "o_orderpriority")
    ).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    date = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        bronze.customer_int(text).alias("customer_id"),
        date.alias("order_date"),
        date.cast("string").alias("date_id"),
        (F.col("o_totalprice") > 150000).cast("int").alias("is_large"),
    )


def assign_city_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = F.when(F.col("o_orderkey") % 2 == 0, -F.col("o_custkey")).otherwise(
        F.col("o_custkey")
    )
    return (
        fx.table(spark, sf_dir, "orders")
        .select("o_orderkey", signed.alias("customer_id"))
        .withColumn("city", assign_city("customer_id"))
    )


def silver_product_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).silver_product_grain


def silver_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fx.mart(spark, sf_dir).silver_sales_daily, **SALES_PLACES)


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).silver_weather


def sales_latest_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = materialize(fx.raw_sales(spark, sf_dir), "raw_sales").withColumn(
        "_source_file", F.concat(F.lit("sales_"), F.year("InvoiceDate"), F.lit(".csv"))
    )
    first = sales.withColumn("_ingested_at", F.lit(STAMP_1))
    second = (
        sales.filter(F.year("InvoiceDate") >= 1998)
        .withColumn("Quantity", F.col("Quantity") + 1)
        .withColumn("_ingested_at", F.lit(STAMP_2))
    )
    raw = first.unionByName(second)
    newest = materialize(dedupe.newest_batches(raw), "newest_batches")
    return dedupe.latest_uploads(raw, newest).select(
        "InvoiceNo", "StockCode", "Quantity", "_source_file", "_ingested_at"
    )


def weather_latest_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fx.raw_weather(spark, sf_dir)
    first = days.withColumn("extracted_at", F.lit(STAMP_1))
    second = (
        days.filter(F.col("city").isin("London", "Leeds"))
        .withColumn("temp_max", F.col("temp_max") + 1)
        .withColumn("extracted_at", F.lit(STAMP_2))
    )
    return dedupe.latest_weather(first.unionByName(second))


# --- features, joins, windows ------------------------------------------------


def flag_rainy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_weather(spark, sf_dir).select(
        "date", "city", rain_flag(F.col("precipitation")).alias("is_rainy")
    )


def bucket_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_weather(spark, sf_dir).select(
        "date", "city", temperature_bucket(F.col("avg_temp")).alias("temp_category")
    )


def bucket_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).silver_sales_daily.select(
        "date", "city", sales_bucket(F.col("total_sales")).alias("sales_category")
    )


def join_sales_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fx.mart(spark, sf_dir)
    return rounded(gold.join_weather(mart.silver_sales_daily, mart.silver_weather), **SALES_PLACES)


def join_product_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fx.mart(spark, sf_dir)
    days = materialize(mart.silver_weather, "silver_weather")
    return gold.join_weather(mart.silver_product_grain, days)


def join_left_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fx.stored_mart(spark, sf_dir)
    return facts.join_products(mart.silver_product_grain, mart.dim_product)


def rolling_sales_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fx.mart(spark, sf_dir).silver_sales_daily
    return rounded(
        daily.select("date", "city", rolling_sales().alias("rolling_7d_sales")), **SALES_PLACES
    )


def rolling_sales_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fx.mart(spark, sf_dir).silver_sales_daily
    return rounded(
        daily.select("date", "city", rolling_sales("days").alias("rolling_7d_sales")),
        **SALES_PLACES,
    )


# --- gold, dimensions, facts -------------------------------------------------


def gold_sales_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fx.mart(spark, sf_dir).gold_sales_weather, **SALES_PLACES)


def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.distinct_dates(fx.mart(spark, sf_dir).gold_sales_weather)


def distinct_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cities(fx.mart(spark, sf_dir).gold_sales_weather)


def distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.distinct_products(fx.mart(spark, sf_dir).silver_product_grain)


def surrogate_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = dimensions.distinct_cities(fx.mart(spark, sf_dir).bronze_sales)
    return with_dense_id(cities, ["city"], "location_id")


def surrogate_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = dimensions.distinct_products(fx.mart(spark, sf_dir).bronze_sales)
    return with_dense_id(products, ["stock_code", "product_description"], "product_id")


def growing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of two loads, the second with new members: facts keep the ids of the first."""
    path = f"{scratch_dir(spark)}/dim_product"
    lines = materialize(fx.mart(spark, sf_dir).silver_product_grain, "lines")

    def number(members: DataFrame, keys: list[str], id_column: str) -> DataFrame:
        return key_registry.assign_keys(members, path, keys, id_column)

    early = lines.filter(F.col("date") < "2025-01-01")
    first = materialize(dimensions.dim_product(early, number), "first_load")
    facts_before = facts.join_products(early, first).groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    second = dimensions.dim_product(lines, number)
    return second.join(facts_before, "product_id", "left").select(
        *second.columns, F.coalesce("lines", F.lit(0)).alias("lines")
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).dim_date


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).dim_location


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mart(spark, sf_dir).dim_product


def fact_sales_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fx.stored_mart(spark, sf_dir).fact_sales_weather, **SALES_PLACES)


def fact_sales_weather_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored_mart(spark, sf_dir).fact_sales_weather_product


def fact_product_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = replace(fx.FIXTURE_OPTIONS, product_match="code_and_description")
    return fx.stored_mart(spark, sf_dir, options).fact_sales_weather_product


# --- reports and checks ------------------------------------------------------


# Added to every day's sales before a report rounds: engines add doubles in different
# orders, and a mean that ends in half a cent must not hang on that.
NUDGE = 1e-9


def _report(function: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = fx.mart(spark, sf_dir).gold_sales_weather
        nudged = gold.withColumn("total_sales", F.col("total_sales") + NUDGE)
        return rounded(function(nudged), **SALES_PLACES)

    return query


def reports_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of the eight aggregated reports, from one scan of gold."""
    gold = fx.mart(spark, sf_dir).gold_sales_weather
    nudged = gold.withColumn("total_sales", F.col("total_sales") + NUDGE)
    return rounded(reports.grouped(nudged), avg_sales=2, revenue=2)


def report_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fx.stored_mart(spark, sf_dir)
    reports.register_views(mart.gold_sales_weather, mart.fact_sales_weather_product)
    return spark.sql("""
        SELECT 'day' AS grain, city, count(*) AS rows, CAST(sum(is_rainy) AS BIGINT) AS rainy,
               CAST(NULL AS BIGINT) AS units
        FROM sales_weather GROUP BY city
        UNION ALL
        SELECT 'line', temp_category, count(*), CAST(sum(is_rainy) AS BIGINT),
               CAST(sum(Quantity) AS BIGINT)
        FROM fact_sales_weather_product GROUP BY temp_category""")


def report_rainy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fx.stored_mart(spark, sf_dir)
    return rounded(
        reports.rainy_products_from_lines(
            mart.silver_product_grain, mart.silver_weather, mart.dim_product
        ),
        total_revenue=2,
    )


def report_rainy_products_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fx.stored_mart(spark, sf_dir).fact_sales_weather_product
    return rounded(reports.rainy_products(fact), total_revenue=2)


def gold_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over gold, some of whose rows were damaged: rule, rows checked, rows failed."""
    gold = fx.mart(spark, sf_dir).gold_sales_weather
    day = F.dayofmonth("date")
    damaged = gold.withColumns(
        {
            "city": F.when(day == 1, "Paris").otherwise(F.col("city")),
            "is_rainy": F.when(day == 2, 1 - F.col("is_rainy")).otherwise(F.col("is_rainy")),
            "temp_category": F.when(day == 3, F.lit(None)).otherwise(F.col("temp_category")),
            "total_sales": F.when(day == 4, -F.col("total_sales")).otherwise(F.col("total_sales")),
            "precipitation": F.when(day == 5, -1.0).otherwise(F.col("precipitation")),
        }
    )
    return rules.summary(damaged, rules.gold_rules([city.name for city in CITIES]))


def _check(function: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: function(fx.mart(spark, sf_dir).gold_sales_weather)


def _check_average(by: str) -> Query:
    return lambda spark, sf_dir: rounded(
        checks.average_sales(fx.mart(spark, sf_dir).gold_sales_weather, by), avg_sales=4
    )


def queries() -> dict[str, Query]:
    return {
        "scan_csv_encoding": scan_csv_encoding,
        "scan_parquet": scan_parquet,
        "upload_date_votes": upload_date_votes,
        "upload_rejects": upload_rejects,
        "landing_once": landing_once,
        "add_provenance": add_provenance,
        "validate_nonempty": validate_nonempty,
        "year_month_partition": year_month_partition,
        "raw_sink_roundtrip": raw_sink_roundtrip,
        "weather_payload_valid": weather_payload_valid,
        "weather_payload_rejects": weather_payload_rejects,
        "weather_enrich_meta": weather_enrich_meta,
        "weather_raw_document": weather_raw_document,
        "raw_sales_mixed_uploads": raw_sales_mixed_uploads,
        "read_dispatch": read_dispatch,
        "write_dispatch": write_dispatch,
        "schema_evolution": schema_evolution,
        "bronze_sales": bronze_sales,
        "bronze_weather": bronze_weather,
        "filter_customer": filter_customer,
        "filter_positive": filter_positive,
        "cast_conform": cast_conform,
        "assign_city": assign_city_query,
        "silver_product_grain": silver_product_grain,
        "silver_sales_daily": silver_sales_daily,
        "silver_weather": silver_weather,
        "sales_latest_only": sales_latest_only,
        "weather_latest_only": weather_latest_only,
        "flag_rainy": flag_rainy,
        "bucket_temperature": bucket_temperature,
        "bucket_sales": bucket_sales,
        "join_sales_weather": join_sales_weather,
        "join_product_weather": join_product_weather,
        "join_left_product": join_left_product,
        "rolling_sales": rolling_sales_query,
        "rolling_sales_days": rolling_sales_days,
        "gold_sales_weather": gold_sales_weather,
        "distinct_dates": distinct_dates,
        "distinct_cities": distinct_cities,
        "distinct_products": distinct_products,
        "surrogate_location": surrogate_location,
        "surrogate_product": surrogate_product,
        "growing_keys": growing_keys,
        "dim_date": dim_date,
        "dim_location": dim_location,
        "dim_product": dim_product,
        "fact_sales_weather": fact_sales_weather,
        "fact_sales_weather_product": fact_sales_weather_product,
        "fact_product_matched": fact_product_matched,
        **{f"report_{name}": _report(fn) for name, fn in reports.GOLD_REPORTS.items()},
        "reports_one_pass": reports_one_pass,
        "report_sql_views": report_sql_views,
        "report_top_days_label": _report(reports.top_days_label),
        "report_rainy_products": report_rainy_products,
        "report_rainy_products_from_fact": report_rainy_products_from_fact,
        "check_sample": _report(checks.sample),
        "gold_rules": gold_rules,
        "check_row_count": _check(checks.row_count),
        "check_date_range": _check(checks.date_range),
        "check_avg_city": _check_average("city"),
        "check_avg_rain": _check_average("is_rainy"),
        "check_avg_temp": _check_average("temp_category"),
        "check_nulls": _check(checks.null_counts),
    }
