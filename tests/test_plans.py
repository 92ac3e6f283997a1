"""Physical plans: what is pushed down, what is broadcast, what is shuffled."""

import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from weathermart.functions.keys import with_dense_id
from weathermart.operators import bronze, dedupe, dimensions, facts, gold, silver
from weathermart.plans import reports
from weathermart.sources import tables
from weathermart.sources.paths import materialize

DAY = dt.date(2022, 1, 1)


@pytest.fixture(scope="module")
def lines(spark):
    """40,000 written lines, a third of them of one product, city and day."""
    n = F.col("id").cast("int")
    hot = n % 3 == 0
    df = spark.range(40000).select(
        F.when(hot, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), n % 300)).alias("date"),
        F.when(hot, "London").when(n % 3 == 1, "Leeds").otherwise("Glasgow").alias("city"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), n % 700)).alias("StockCode"),
        F.when(n % 2 == 0, F.sha2(F.col("id").cast("string"), 256))
        .otherwise(F.concat(F.lit("name "), n % 5))
        .alias("Description"),
        (n % 7 + 1).alias("Quantity"),
        (n % 11 + 1).cast("double").alias("UnitPrice"),
        ((n % 7 + 1) * (n % 11 + 1)).cast("double").alias("total_price"),
    )
    return materialize(df, "lines")


@pytest.fixture(scope="module")
def weather(spark):
    cities = F.explode(F.array(*map(F.lit, ("London", "Leeds", "Glasgow"))))
    df = spark.range(300).select(
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"),
        cities.alias("city"),
        (F.col("id") % 30).cast("double").alias("avg_temp"),
        (F.col("id") % 2).cast("double").alias("precipitation"),
    )
    return materialize(df, "weather")


def test_bronze_is_one_scan_with_pushed_filter_and_pruned_columns(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "A", "x", 1, dt.datetime(2010, 1, 1), 1.0, 1.0, "UK", "f", "e", "t")],
        "InvoiceNo string, StockCode string, Description string, Quantity int, "
        "InvoiceDate timestamp, UnitPrice double, CustomerID double, Country string, "
        "_source_file string, _entity string, _ingested_at string",
    )
    tables.write(raw, str(tmp_path))
    text = plan(bronze.sales(tables.read(spark, str(tmp_path))))
    assert "PushedFilters: [IsNotNull(CustomerID)]" in text
    assert "_ingested_at" not in text and "Exchange" not in text


def test_silver_filters_reach_the_scan(spark, tmp_path):
    sales = spark.createDataFrame(
        [("1", "A", "x", 1, 1.0, 1, "UK", "London", DAY)],
        "InvoiceNo string, StockCode string, Description string, Quantity int, UnitPrice double, "
        "CustomerID int, Country string, city string, date date",
    )
    tables.write(sales, str(tmp_path), partition_cols="city")
    text = plan(silver.product_grain(tables.read(spark, str(tmp_path))))
    assert "GreaterThan(Quantity,0)" in text and "GreaterThan(UnitPrice,0.0)" in text
    assert "CustomerID" not in text and "Exchange" not in text


def test_daily_sales_add_up_before_the_only_shuffle(lines):
    text = plan(silver.daily_sales(lines))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_sum")
    assert "ReadSchema: struct<date:date,city:string,total_price:double>" in text


def test_small_weather_is_broadcast_and_large_weather_is_not(lines, weather, conf):
    joined = gold.join_weather(lines, weather)
    assert "BroadcastHashJoin" in plan(joined)
    conf(spark__sql__autoBroadcastJoinThreshold="1")
    assert "SortMergeJoin" in plan(gold.join_weather(lines, weather))


def skewed(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="8k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def test_hot_day_is_split_when_weather_is_too_large_to_broadcast(lines, weather, conf):
    expected = rows(gold.join_weather(lines, weather).groupBy("city").count())
    skewed(conf)
    joined = gold.join_weather(lines.repartition(12), weather)
    assert rows(joined.groupBy("city").count()) == expected
    found = joined.select("Description", "avg_temp")
    found.collect()
    assert "skew=true" in plan(found)


def test_hot_product_is_split_in_the_product_join(lines, conf):
    named = lines.filter(F.col("Description").startswith("name"))
    products = materialize(dimensions.dim_product(named), "dim_product")
    expected = facts.join_products(lines, products).count()
    skewed(conf)
    joined = facts.join_products(lines.repartition(12), products)
    found = joined.select("Description", "product_id")
    assert len(found.collect()) == expected
    assert "skew=true" in plan(found)


def test_dense_ids_sort_members_in_many_partitions(spark):
    members = spark.range(1000).select(F.col("id").cast("string").alias("k")).distinct()
    df = with_dense_id(members, ["k"], "id")
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("Exchange SinglePartition") == 1
    offsets = final[final.index("Exchange SinglePartition") :]
    assert "partial_count" in offsets and "ReusedExchange" in offsets


def test_top_reports_keep_no_full_sort(lines, weather):
    table = gold.sales_weather(silver.daily_sales(lines), weather)
    for report in (reports.top_days, reports.peak_conditions):
        assert "TakeOrderedAndProject" in plan(report(table))


def test_rainy_filter_is_pushed_and_lines_are_summed_before_the_product_join(lines, weather):
    products = materialize(dimensions.dim_product(lines), "dim_product")
    text = plan(reports.rainy_products_from_lines(lines, weather, products))
    assert "GreaterThan(precipitation,0.0)" in text
    join = text.index("LeftOuter")
    assert "partial_sum" in text[join:]


def test_rainy_report_on_skewed_lines_agrees_with_the_fact(lines, weather):
    table = gold.sales_weather(silver.daily_sales(lines), weather)
    named = lines.filter(F.col("Description").startswith("name"))
    products = materialize(dimensions.dim_product(named), "dim_product")
    fact = facts.sales_weather_product(
        lines,
        weather,
        dimensions.dim_date(table),
        dimensions.dim_location(table),
        products,
    )
    short = reports.rainy_products_from_lines(lines, weather, products)
    assert rows(short) == rows(reports.rainy_products(fact))


def test_newest_batch_list_is_broadcast_against_a_hot_source_file(spark, lines):
    raw = materialize(
        lines.select(
            "StockCode", F.lit("one.csv").alias("_source_file"), F.lit("t1").alias("_ingested_at")
        ),
        "raw",
    )
    newest = materialize(dedupe.newest_batches(raw), "newest")
    text = plan(dedupe.latest_uploads(raw, newest))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert dedupe.latest_uploads(raw, newest).count() == 40000


def test_latest_weather_collapses_runs_before_the_shuffle(spark, weather):
    days = weather.select(
        "city",
        F.col("date").cast("string").alias("date"),
        F.col("avg_temp").alias("temp_max"),
        F.col("avg_temp").alias("temp_min"),
        "precipitation",
        F.lit("t").alias("extracted_at"),
    )
    text = plan(dedupe.latest_weather(days))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_partition_columns_prune_table_scans(spark, lines, tmp_path):
    tables.write(lines, str(tmp_path), partition_cols="city")
    text = plan(tables.read(spark, str(tmp_path)).filter("city = 'Leeds'").select("total_price"))
    assert "PartitionFilters: [isnotnull(city" in text
