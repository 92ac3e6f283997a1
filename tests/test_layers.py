import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from weathermart.operators import bronze, checks, dedupe, dimensions, facts, gold, silver
from weathermart.plans import reports
from weathermart.schemas import CONTRACTS, check_contract
from weathermart.sources import key_registry

RAW = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, "
    "InvoiceDate {date}, UnitPrice double, CustomerID {customer}, {country} string"
)


def raw(spark, *lines, date="timestamp", customer="double", country="Country"):
    return spark.createDataFrame(
        list(lines), RAW.format(date=date, customer=customer, country=country)
    )


MOMENT = dt.datetime(2010, 12, 1, 8, 26)
DAY = dt.date(2022, 12, 1)


def lines_of(spark, *data):
    return spark.createDataFrame(list(data), CONTRACTS["silver_product_grain"])


def weather_of(spark, *data):
    return spark.createDataFrame(list(data), CONTRACTS["silver_weather"])


def test_bronze_sales_types_city_date_and_missing_customers(spark):
    found = bronze.sales(
        raw(
            spark,
            ("1", "A", " x", 6, MOMENT, 2.55, 17850.0, "UK"),
            ("C2", "A", None, -6, MOMENT, 2.55, -7.0, "UK"),
            ("3", "A", "x", 1, None, 2.55, 1.0, "UK"),
            ("4", "A", "x", 1, MOMENT, 2.55, None, "UK"),
        )
    )
    assert found.schema.simpleString() == CONTRACTS["bronze_sales"].simpleString()
    assert rows(found) == [
        ("1", "A", " x", 6, 2.55, 17850, "UK", "London", DAY),
        ("3", "A", "x", 1, 2.55, 1, "UK", "Manchester", None),
        ("C2", "A", None, -6, 2.55, -7, "UK", "Glasgow", DAY),
    ]


def test_bronze_accepts_text_customers_text_dates_and_lower_case_country(spark):
    found = bronze.sales(
        raw(
            spark,
            ("1", "A", "x", 6, "2010-12-01 08:26:00", 2.55, "17850.0", "UK"),
            ("2", "A", "x", 6, "12/1/2010 8:26", 2.55, "guest", "UK"),
            date="string",
            customer="string",
            country="country",
        )
    ).select("InvoiceNo", "CustomerID", "Country", "city", "date")
    assert rows(found) == [
        ("1", 17850, "UK", "London", DAY),
        ("2", None, "UK", "Glasgow", DAY),
    ]


def test_silver_drops_returns_and_free_lines_and_keeps_totals(spark):
    found = bronze.sales(
        raw(
            spark,
            ("1", "A", "x", 2, MOMENT, 1.5, 5.0, "UK"),
            ("2", "B", "y", 1, MOMENT, 4.0, 10.0, "UK"),
            ("3", "A", "x", -2, MOMENT, 1.5, 5.0, "UK"),
            ("4", "A", "x", 2, MOMENT, 0.0, 5.0, "UK"),
            ("5", "A", "x", None, MOMENT, 1.0, 5.0, "UK"),
        )
    )
    lines = silver.product_grain(found)
    assert rows(lines) == [
        (DAY, "London", "A", "x", 2, 1.5, 3.0),
        (DAY, "London", "B", "y", 1, 4.0, 4.0),
    ]
    assert rows(silver.daily_sales(lines)) == [(DAY, "London", 7.0)]


@pytest.fixture(scope="module")
def small(spark):
    """Three city-days with weather, one without; product A has two descriptions."""
    d1, d2 = dt.date(2022, 1, 1), dt.date(2022, 1, 2)
    lines = lines_of(
        spark,
        (d1, "London", "A", "apple", 2, 250.0, 500.0),
        (d1, "London", "B", " pear ", 1, 10.0, 10.0),
        (d2, "London", "A", " APPLE", 4, 500.0, 2000.0),
        (d1, "Leeds", "C", "  ", 1, 5.0, 5.0),
        (d1, "Leeds", "A", "apple", 1, 100.0, 100.0),
        (d2, "Leeds", "D", None, 1, 7.0, 7.0),
    )
    weather = weather_of(
        spark,
        (d1, "London", 10.0, 1.0),
        (d2, "London", None, None),
        (d1, "Leeds", 25.0, 0.5),
        (d1, "Glasgow", 0.0, 0.0),
    )
    daily = silver.daily_sales(lines)
    table = gold.sales_weather(daily, weather)
    return {
        "lines": lines,
        "weather": weather,
        "daily": daily,
        "gold": table,
        "dim_date": dimensions.dim_date(table),
        "dim_location": dimensions.dim_location(table),
        "dim_product": dimensions.dim_product(lines),
    }


def fact_of(small, **options):
    return facts.sales_weather_product(
        small["lines"],
        small["weather"],
        small["dim_date"],
        small["dim_location"],
        small["dim_product"],
        **options,
    )


def test_gold_joins_and_sends_missing_readings_to_the_last_branch(small):
    found = small["gold"].withColumn("date", F.dayofmonth("date"))
    assert rows(found) == [
        (1, "Leeds", 105.0, 25.0, 0.5, 1, "Hot", "Low", 105.0),
        (1, "London", 510.0, 10.0, 1.0, 1, "Moderate", "Medium", 510.0),
        (2, "London", 2000.0, None, None, 0, "Hot", "High", 1255.0),
    ]


def test_duplicate_weather_doubles_sales_at_gold(small):
    twice = small["weather"].unionAll(small["weather"])
    assert gold.sales_weather(small["daily"], twice).count() == 6


def test_daily_total_equals_line_total(small):
    lines = small["lines"].agg(F.sum("total_price")).first()[0]
    assert small["daily"].agg(F.sum("total_sales")).first()[0] == lines


def test_dimensions(small):
    assert [tuple(r)[1:] for r in small["dim_date"].orderBy("date").collect()] == [
        (2022, 1, 1, 7, 52, "2022-01-01"),
        (2022, 1, 2, 1, 52, "2022-01-02"),
    ]
    assert {r.city for r in small["dim_location"].collect()} == {"London", "Leeds"}
    products = rows(small["dim_product"].select("stock_code", "product_description"))
    assert products == [("A", "APPLE"), ("A", "apple"), ("B", "pear")]
    ids = sorted(r.product_id for r in small["dim_product"].collect())
    assert ids == [0, 1, 2]


def test_daily_fact_has_one_row_per_gold_row(small):
    fact = facts.sales_weather(small["gold"], small["dim_date"], small["dim_location"])
    assert fact.count() == small["gold"].count()
    back = fact.join(small["dim_location"], "location_id").select("date_id", "city", "total_sales")
    assert ("2022-01-02", "London", 2000.0) in rows(back)


def test_product_match_by_code_repeats_lines_per_description(small):
    found = fact_of(small).groupBy("stock_code", "product_description").count()
    assert rows(found) == [
        ("A", " APPLE", 2), ("A", "apple", 4), ("B", " pear ", 1), ("C", "  ", 1),
    ]
    assert [r.product_id for r in fact_of(small).filter("stock_code = 'C'").collect()] == [None]


def test_product_match_by_code_and_description_keeps_lines(small):
    fact = fact_of(small, match="code_and_description")
    assert fact.count() == 5
    named = fact.join(
        small["dim_product"].withColumnRenamed("product_description", "name").drop("stock_code"),
        "product_id",
    )
    assert named.filter("trim(product_description) = name").count() == 4
    with pytest.raises(ValueError, match="product match"):
        fact_of(small, match="fuzzy")


def test_rainy_products_agree_on_both_paths(small):
    expected = [("apple", 1200.0, 6), (" pear ", 10.0, 1), ("  ", 5.0, 1)]
    from_fact = reports.rainy_products(fact_of(small))
    from_lines = reports.rainy_products_from_lines(
        small["lines"], small["weather"], small["dim_product"]
    )
    assert [tuple(r) for r in from_fact.collect()] == expected
    assert [tuple(r) for r in from_lines.collect()] == expected


def test_latest_uploads_keep_equal_lines_of_the_newest_batch(spark):
    batch = spark.createDataFrame(
        [
            (1, "a.csv", "t1"),
            (1, "a.csv", "t2"),
            (1, "a.csv", "t2"),
            (2, "b.csv", "t1"),
            (3, None, "t1"),
        ],
        "line int, _source_file string, _ingested_at string",
    )
    found = dedupe.latest_uploads(batch, dedupe.newest_batches(batch))
    assert rows(found) == [
        (1, "a.csv", "t2"), (1, "a.csv", "t2"), (2, "b.csv", "t1"), (3, None, "t1"),
    ]


def test_reports_on_known_rows(small):
    table = small["gold"]

    def listed(df):
        return [tuple(row) for row in df.collect()]

    assert listed(reports.temperature(table)) == [("Hot", 1052.5), ("Moderate", 510.0)]
    assert listed(reports.monthly(table)) == [(1, 2615.0)]
    assert listed(reports.city(table)) == [("London", 1255.0), ("Leeds", 105.0)]
    assert listed(reports.rain(table)) == [(0, 2000.0), (1, 307.5)]
    assert listed(reports.weekly(table)) == [(52, 871.67)]
    assert listed(reports.day_of_week(table)) == [("Sunday", 2000.0), ("Saturday", 307.5)]
    assert listed(reports.growth(table)) == [(2022, 1, 2615.0)]
    assert listed(reports.peak_conditions(table, 1)) == [("London", "Hot", 0, 2000.0)]
    assert listed(reports.top_days_label(table, 1))[0][3] == "2022-01-02 (London)"
    assert [r.total_sales for r in reports.top_days(table, 2).collect()] == [2000.0, 510.0]


def test_tables_answer_sql_by_name(spark, small):
    reports.register_views(small["gold"], fact_of(small))
    top = spark.sql("SELECT city FROM sales_weather ORDER BY total_sales DESC LIMIT 1;")
    assert top.first().city == "London"
    by_month = "SELECT MONTH(date) AS m, SUM(total_sales) AS s FROM sales_weather GROUP BY m"
    assert rows(spark.sql(by_month)) == [(1, 2615.0)]
    assert spark.sql("SELECT * FROM fact_sales_weather_product WHERE is_rainy = 1").count() == 6


def test_checks_on_known_rows(small):
    table = small["gold"]
    assert checks.row_count(table).first().row_count == 3
    assert tuple(checks.date_range(table).first()) == (dt.date(2022, 1, 1), dt.date(2022, 1, 2))
    assert rows(checks.cities(table)) == [("Leeds",), ("London",)]
    assert [tuple(r) for r in checks.average_sales(table, "city").collect()] == [
        ("London", 1255.0), ("Leeds", 105.0),
    ]
    assert checks.null_counts(table).first().asDict() == {
        name: int(name in ("avg_temp", "precipitation")) for name in table.columns
    }
    assert checks.sample(table, 2).count() == 2


def test_contract_breaks_are_named(spark):
    df = spark.createDataFrame([(1, 2)], "city int, extra int")
    with pytest.raises(ValueError, match="city: expected string, found int.*extra.*location_id"):
        check_contract(df, "dim_location")


def test_stored_keys_stay_when_members_are_added(spark, tmp_path):
    path = f"{tmp_path}/keys"

    def load(*members):
        df = spark.createDataFrame([(m, m and m.upper()) for m in members], "code string, name string")
        found = key_registry.assign_keys(df, path, ["code", "name"], "id")
        return {row.code: row.id for row in found.collect()}

    first = load("a", "b", "b", None, "c")
    assert sorted(first.values()) == [0, 1, 2, 3]
    assert load("c", "a") == {k: first[k] for k in "ca"}
    second = load("a", None, "d", "e")
    assert {k: second[k] for k in ("a", None)} == {k: first[k] for k in ("a", None)}
    assert sorted(second[k] for k in "de") == [4, 5]
    stored = spark.read.parquet(path)
    assert rows(stored.groupBy("version").count()) == [(0, 4), (1, 2)]
    assert load() == {}
