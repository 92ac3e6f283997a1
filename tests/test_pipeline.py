import dataclasses
import json
import shutil
from pathlib import Path

import pytest
from helpers import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from weathermart.operators import rules
from weathermart.plans import pipeline, reports
from weathermart.plans.mart import Mart, Options
from weathermart.schemas import CONTRACTS
from weathermart.sources import paths, tables, weather

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
LINES = [
    "1,A,apple,2,1/1/2010 8:26,250.0,5.0,UK",
    "2,B, pear ,1,1/1/2010 9:00,10.0,10.0,UK",
    "3,A, APPLE,4,1/2/2010 8:26,500.0,15.0,UK",
    "C4,A,apple,-1,1/1/2010 8:26,100.0,6.0,UK",
    "5,A,apple,1,1/1/2010 8:26,100.0,6.0,UK",
    "6,A,apple,1,1/1/2010 8:26,100.0,,UK",
]


def prepare(folder) -> pipeline.Lake:
    uploads, landing = folder / "uploads", folder / "landing"
    uploads.mkdir()
    (uploads / "sales.csv").write_text(HEADER + "".join(line + "\n" for line in LINES))
    for city in ("London", "Manchester"):
        (landing / f"city={city}").mkdir(parents=True)
        daily = {
            "time": ["2022-01-01", "2022-01-02"],
            "temperature_2m_max": [12.0, 8.0],
            "temperature_2m_min": [8.0, 2.0],
            "precipitation_sum": [1.0, 0.0],
        }
        (landing / f"city={city}" / "d.json").write_text(json.dumps({"daily": daily}))
    return pipeline.Lake(
        root=str(folder / "lake"),
        uploads=str(uploads),
        landing=str(landing),
        ingested_at="2025-01-01",
    )


@pytest.fixture
def lake(tmp_path):
    """Inputs only; nothing has run."""
    return prepare(tmp_path)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """A lake after one full run, and the counts it returned; tests only read it."""
    done = prepare(tmp_path_factory.mktemp("full"))
    return done, pipeline.run(spark, done)


@pytest.fixture
def copy(full, tmp_path):
    """A private copy of the written lake."""
    shutil.copytree(full[0].root, tmp_path / "lake")
    return dataclasses.replace(full[0], root=str(tmp_path / "lake"))


FULL = {
    "raw_weather": 2,
    "raw_sales": 6,
    "bronze_sales": 5,
    "bronze_weather": 4,
    "silver_product_grain": 4,
    "silver_sales_daily": 3,
    "silver_weather": 4,
    "gold_sales_weather": 3,
    "dim_date": 2,
    "dim_location": 2,
    "dim_product": 3,
    "fact_sales_weather": 3,
    "fact_sales_weather_product": 7,
}


def test_full_run_writes_every_table_with_its_contract(spark, full):
    lake, counts = full
    assert counts == FULL
    for table in CONTRACTS:
        found = lake.read(spark, table)
        kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
        expected = {f.name: f.dataType.simpleString() for f in CONTRACTS[table].fields}
        assert kinds == expected, table
    gold = lake.read(spark, "gold_sales_weather")
    cities = [tuple(r) for r in reports.city(gold).collect()]
    assert cities == [("London", 1255.0), ("Manchester", 100.0)]
    fact = lake.read(spark, "fact_sales_weather_product")
    assert [tuple(r) for r in reports.rainy_products(fact).collect()] == [
        ("apple", 1200.0, 6),
        (" pear ", 10.0, 1),
    ]


def test_numeric_city_names_stay_text(spark, copy):
    named = dataclasses.replace(copy, options=Options(cities=["007", "2"]))
    pipeline.run(spark, named, ["sales_bronze", "sales_silver"])
    cities = named.read(spark, "silver_sales_daily").select("city").distinct()
    assert rows(cities) == [("007",), ("2",)]


def test_layout_on_disk(full):
    root = Path(full[0].root)
    found = {str(p.parent.relative_to(root)) for p in root.glob("**/part-*.parquet")}
    assert {
        "raw/retail_sales/uci_online_retail/year=2010/month=01",
        "bronze/sales/online_retail/city=London",
        "bronze/weather/open_meteo/city=London",
        "silver/sales/online_retail/city=London",
        "silver/sales/product_grain/city=London",
        "silver/weather/open_meteo/city=London",
        "gold/sales_weather/city=London",
        "gold/dim_date",
        "gold/dim_location",
        "gold/dim_product",
        "gold/fact_sales_weather/location_id=0",
        "gold/fact_sales_weather_product/location_id=0",
    } <= found


def test_stages_run_alone_in_order_and_can_be_repeated(spark, copy):
    again = pipeline.run(spark, copy, ["gold", "sales_silver"])
    assert list(again) == ["silver_product_grain", "silver_sales_daily", "gold_sales_weather"]
    assert copy.read(spark, "gold_sales_weather").count() == 3
    with pytest.raises(ValueError, match="unknown stages: platinum"):
        pipeline.run(spark, copy, ["platinum"])


def test_second_ingestion_doubles_unless_latest_only(spark, copy):
    later = dataclasses.replace(copy, ingested_at="2025-02-01")
    stages = ["sales_bronze", "weather_bronze", "sales_silver", "weather_silver", "gold"]
    doubled = pipeline.run(spark, later, ["weather", "retail_sales", *stages])
    assert (doubled["bronze_sales"], doubled["bronze_weather"]) == (10, 8)
    assert doubled["gold_sales_weather"] == 6
    latest = dataclasses.replace(later, latest_only=True)
    once = pipeline.run(spark, latest, stages)
    assert once == {name: FULL[name] for name in once}


def test_rejected_payloads_are_counted_and_missing_uploads_reported(spark, lake, tmp_path, caplog):
    bad = tmp_path / "landing" / "city=Leeds"
    bad.mkdir()
    (bad / "d.json").write_text("[]")
    for file in (tmp_path / "uploads").iterdir():
        file.rename(file.with_suffix(".txt"))
    counts = pipeline.run(spark, lake, ["weather", "retail_sales"])
    assert counts == {"raw_weather": 2, "raw_sales": 0}
    assert "1 weather payloads failed validation" in caplog.text
    assert "no uploads in" in caplog.text


def test_options_reach_the_stages(spark, lake):
    options = Options(product_match="code_and_description", rolling_frame="days")
    counts = pipeline.run(spark, dataclasses.replace(lake, options=options, line_rebalance=True))
    assert counts["fact_sales_weather_product"] == 4
    unshifted = dataclasses.replace(lake, options=Options(shift_months=0))
    pipeline.run(spark, unshifted, ["sales_bronze"])
    years = lake.read(spark, "bronze_sales").select(F.year("date")).distinct()
    assert rows(years) == [(2010,)]


@pytest.mark.parametrize("store", [None, paths.materialize])
def test_the_lazy_mart_equals_the_written_pipeline(spark, lake, store):
    pipeline.run(spark, lake)
    raw = spark.read.parquet(lake.path("raw_sales"))
    days = lake.read(spark, "bronze_weather")
    mart = Mart(raw, days, store=store) if store else Mart(raw, days)
    for name, df in mart.tables().items():
        columns = df.columns
        assert rows(df) == rows(lake.read(spark, name).select(*columns)), name


def test_reader_and_writer_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "b", None)], "i int, p string, q string")
    with pytest.raises(ValueError, match="Unsupported format: orc"):
        tables.read(spark, str(tmp_path), "orc")
    for columns in (None, "p", ["p"], ["p", "q"]):
        path = str(tmp_path / f"t{columns}")
        tables.write(df, path, partition_cols=columns)
        tables.write(df, path, partition_cols=columns)
        assert rows(tables.read(spark, path).select("i", "p", "q")) == rows(df)
    with pytest.raises(Exception, match="(?i)delta"):
        tables.write(df, str(tmp_path / "delta"), "delta")


def test_one_json_document_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "i": 1\n}')
    (tmp_path / "b.json").write_text('{\n "i": 2\n}')
    assert rows(tables.read(spark, str(tmp_path), "json")) == [(1,), (2,)]


def test_columns_added_later_read_as_null(spark, tmp_path):
    path = str(tmp_path)
    tables.write(spark.range(1).select(F.lit(1).alias("a")), path, mode="append")
    later = spark.range(1).select(F.lit(2).alias("a"), F.lit("n").alias("b"))
    tables.write(later, path, mode="append")
    assert rows(tables.read(spark, path, merge_schema=True)) == [(1, None), (2, "n")]


def test_row_counts_come_with_the_write(spark, tmp_path):
    for rebalance in (False, True):
        seen = Observation()
        df = spark.range(1000).withColumn("p", F.col("id") % 3)
        path = f"{tmp_path}/{rebalance}"
        tables.write(df, path, partition_cols="p", rebalance=rebalance, observation=seen)
        assert seen.get["rows"] == 1000


class Session:
    """Stands for a session with the given options; the folder option is read-only later."""

    def __init__(self, **options):
        self.conf = {key.replace("__", "."): value for key, value in options.items()}


def test_scratch_is_a_fresh_path_in_the_shared_folder():
    session = Session(spark__checkpoint__dir="s3://bucket/shared/", spark__master="yarn")
    first, second = paths.scratch_dir(session), paths.scratch_dir(session)
    assert first != second and first.startswith("s3://bucket/shared/weathermart/")


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_scratch_goes_to_the_warehouse_where_no_folder_is_named(master):
    options = {"spark__master": master, "spark__app__id": "app-1"}
    session = Session(spark__sql__warehouse__dir="s3://bucket/warehouse", **options)
    roots = {paths.scratch_dir(session).rsplit("/", 1)[0] for _ in range(2)}
    assert roots == {"s3://bucket/warehouse/weathermart/app-1"}


def test_materialized_tables_are_read_back_whole(spark):
    kept = paths.materialize(spark.range(3).toDF("i"), "three")
    assert rows(kept) == [(0,), (1,), (2,)]
    assert "weathermart/" in kept.inputFiles()[0] and "/three/" in kept.inputFiles()[0]


def test_layer_paths():
    assert paths.layer_path("lake/", "raw", "weather", "open_meteo", city="Leeds") == (
        "lake/raw/weather/open_meteo/city=Leeds"
    )


def test_documents_append(spark, tmp_path):
    days = spark.createDataFrame(
        [("London", '{"latitude": 1.0}', ("t1",))],
        "city string, payload string, _meta struct<extracted_at: string>",
    )
    weather.write_documents(days, str(tmp_path))
    weather.write_documents(days, str(tmp_path))
    assert len(list(tmp_path.glob("city=London/*.txt"))) == 2


@pytest.mark.parametrize("what", ["warn", "quarantine", "fail"])
def test_gold_rows_that_break_a_rule(spark, lake, monkeypatch, caplog, what):
    pipeline.run(spark, lake, ["weather", "retail_sales", "sales_bronze", "weather_bronze", "sales_silver", "weather_silver"])
    lake = dataclasses.replace(lake, gold_check=what)
    assert pipeline.run(spark, lake, ["gold"])["gold_sales_weather"] == 3 and "rule" not in caplog.text
    monkeypatch.setattr(rules, "gold_rules", lambda cities: [rules.Rule("dry", "is_rainy = 0"), rules.Rule("any", "true")])
    if what == "fail":
        with pytest.raises(rules.RuleError, match="'dry': 2"):
            pipeline.run(spark, lake, ["gold"])
        assert lake.read(spark, "gold_sales_weather").count() == 3
        return
    counts = pipeline.run(spark, lake, ["gold"])
    assert counts == {"gold_sales_weather": 3 if what == "warn" else 1}
    assert "2 of 3 gold rows break the rule: dry" in caplog.text
    if what == "quarantine":
        aside = spark.read.parquet(lake.path("gold_quarantine"))
        assert rows(aside.select("city", "broken_rules")) == [("London", ["dry"]), ("Manchester", ["dry"])]


def test_rules_count_nulls_as_broken_and_find_repeated_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, -5)], "k int, v int")
    found = rules.summary(df, [rules.Rule("positive", "v > 0"), rules.Rule("key", F.col("k").isNotNull())])
    assert rows(found) == [("key", 3, 0), ("positive", 3, 2)]
    assert rows(rules.repeated_keys(df, ["k"])) == [(1, 2)]
    assert rows(rules.summary(df.limit(0), [rules.Rule("positive", "v > 0")])) == [("positive", 0, 0)]


def test_reports_from_one_pass_equal_their_own(spark, full):
    gold = full[0].read(spark, "gold_sales_weather")
    table = paths.materialize(reports.grouped(gold), "grouped")
    assert plan(reports.grouped(gold)).count("FileScan") == 1
    for name in reports._GROUPED:
        one, own = reports.from_grouped(table, name), reports.GOLD_REPORTS[name](gold)
        assert one.columns == own.columns and one.collect() == own.collect(), name
