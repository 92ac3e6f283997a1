import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from weathermart.functions.cities import City, city_table
from weathermart.operators import bronze, dedupe, silver
from weathermart.sources import weather

DAYS = {
    "time": ["2022-01-01", "2022-01-02"],
    "temperature_2m_max": [8.0, 9.5],
    "temperature_2m_min": [2.0, None],
    "precipitation_sum": [0.0, 1.5],
}


def payload(**daily):
    return {"latitude": 51.5, "longitude": -0.1, "timezone": "UTC", "daily": DAYS | daily}


def put(folder, city, content, name="doc.json"):
    path = folder / f"city={city}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))


def bronze_rows(spark, path):
    return rows(bronze.weather(weather.read_documents(spark, str(path))))


def test_reasons_for_rejection(spark, tmp_path):
    put(tmp_path, "Good", payload())
    put(tmp_path, "Extra", payload() | {"elevation": 25.0})
    put(tmp_path, "Broken", '{"daily": {"time": ["2022-01-01"')
    put(tmp_path, "List", [payload()])
    put(tmp_path, "Scalar", "42")
    put(tmp_path, "NoDaily", {"latitude": 1.0})
    put(tmp_path, "NullDaily", {"daily": None})
    put(tmp_path, "NoTime", {"daily": {"precipitation_sum": [1.0]}})
    put(tmp_path, "EmptyTime", payload(time=[]))
    put(tmp_path, "NullTime", payload(time=None))
    payloads = weather.read_payloads(spark, str(tmp_path))
    assert rows(weather.rejected_payloads(payloads).select("city", "reason")) == [
        ("Broken", "not a JSON object"),
        ("EmptyTime", "daily.time is empty"),
        ("List", "not a JSON object"),
        ("NoDaily", "daily is missing"),
        ("NoTime", "daily.time is empty"),
        ("NullDaily", "daily is missing"),
        ("NullTime", "daily.time is empty"),
        ("Scalar", "not a JSON object"),
    ]
    assert rows(weather.valid_payloads(payloads).select("city")) == [("Extra",), ("Good",)]
    assert rows(weather.rejected_payloads(payloads).filter("city = 'Scalar'"))[0][2] == "42"


def test_meta_comes_from_the_city_list_and_unknown_cities_stay(spark, tmp_path):
    put(tmp_path, "London", payload())
    put(tmp_path, "Atlantis", payload())
    valid = weather.valid_payloads(weather.read_payloads(spark, str(tmp_path)))
    found = weather.enrich_payloads(valid, extracted_at="t1").select("_meta.*")
    assert rows(found) == [
        ("Atlantis", None, None, None, "t1", "open_meteo_archive"),
        ("London", "GB", 51.5074, -0.1278, "t1", "open_meteo_archive"),
    ]


def test_landing_keeps_documents_and_city_names_with_spaces(spark, tmp_path):
    landing, lake = tmp_path / "in", tmp_path / "lake"
    put(landing, "New York", payload())
    put(landing, "London", payload())
    put(landing, "Leeds", "{")
    cities = [City("New York", "US", 40.7, -74.0), City("London", "GB", 51.5, -0.1)]
    path = weather.land_payloads(spark, str(landing), str(lake), cities=cities, extracted_at="t1")
    assert path == f"{lake}/raw/weather/open_meteo"
    files = list((lake / "raw").glob("**/*.txt")) + list((lake / "raw").glob("**/*.json"))
    assert len(files) == 2
    assert json.loads(files[0].read_text())["_meta"]["extracted_at"] == "t1"
    assert bronze_rows(spark, path) == [
        ("London", "2022-01-01", 8.0, 2.0, 0.0),
        ("London", "2022-01-02", 9.5, None, 1.5),
        ("New York", "2022-01-01", 8.0, 2.0, 0.0),
        ("New York", "2022-01-02", 9.5, None, 1.5),
    ]


def test_whole_documents_are_landed(spark, tmp_path):
    landing, lake = tmp_path / "in", tmp_path / "lake"
    whole = payload(sunshine_duration=[4, 5.5]) | {"elevation": 25, "generationtime_ms": 0.25}
    put(landing, "London", whole)
    weather.land_payloads(spark, str(landing), str(lake), extracted_at="t1")
    landed = json.loads(next((lake / "raw").glob("**/*.txt")).read_text())
    assert landed.pop("_meta")["extracted_at"] == "t1"
    assert landed == whole and isinstance(landed["daily"]["sunshine_duration"][0], int)


def test_a_bad_cell_is_null_alone(spark, tmp_path):
    landing, lake = tmp_path / "in", tmp_path / "lake"
    put(landing, "London", payload(temperature_2m_max=["n/a", 9.5], weathercode=[3.0, 61]))
    read = weather.valid_payloads(weather.read_payloads(spark, str(landing))).first()
    assert (read.daily.temperature_2m_max, read.daily.weathercode) == ([None, 9.5], [3, 61])
    path = weather.land_payloads(spark, str(landing), str(lake))
    assert bronze_rows(spark, path) == [
        ("London", "2022-01-01", None, 2.0, 0.0), ("London", "2022-01-02", 9.5, None, 1.5),
    ]


def test_unequal_arrays_pad_with_nulls(spark, tmp_path):
    put(tmp_path, "London", payload(precipitation_sum=[3.0]))
    assert bronze_rows(spark, tmp_path) == [
        ("London", "2022-01-01", 8.0, 2.0, 3.0),
        ("London", "2022-01-02", 9.5, None, None),
    ]


def test_documents_without_a_series_give_no_rows(spark, tmp_path):
    put(tmp_path, "London", payload(**dict.fromkeys(DAYS, [])))
    put(tmp_path, "Leeds", {"latitude": 1.0})
    assert bronze_rows(spark, tmp_path) == []


def test_repeated_runs_are_kept_unless_latest_is_asked_for(spark, tmp_path):
    landing, lake = tmp_path / "in", tmp_path / "lake"
    put(landing, "London", payload())
    path = weather.land_payloads(spark, str(landing), str(lake), extracted_at="2025-01-01")
    put(landing, "London", payload(temperature_2m_max=[10.0, None]))
    weather.land_payloads(spark, str(landing), str(lake), extracted_at="2025-02-01")
    documents = weather.read_documents(spark, path)
    assert bronze.weather(documents).count() == 4
    assert rows(dedupe.latest_weather(bronze.zip_days(documents))) == [
        ("London", "2022-01-01", 10.0, 2.0, 0.0),
        ("London", "2022-01-02", None, None, 1.5),
    ]


def test_silver_casts_dates_once_and_drops_unreadable_ones(spark):
    flat = spark.createDataFrame(
        [
            ("London", "2022-01-01", 8.0, 2.0, None),
            ("London", "2022-01-02", None, 2.0, 1.0),
            ("London", "soon", 8.0, 2.0, 1.0),
            ("London", None, 8.0, 2.0, 1.0),
        ],
        "city string, date string, temp_max double, temp_min double, precipitation double",
    )
    found = silver.weather(flat).withColumn("date", F.col("date").cast("string"))
    assert rows(found) == [
        ("2022-01-01", "London", 5.0, None),
        ("2022-01-02", "London", None, 1.0),
    ]


def test_city_list_is_a_local_relation_of_known_size(spark):
    optimized = city_table(spark)._jdf.queryExecution().optimizedPlan()
    assert optimized.stats().sizeInBytes() < 1000
    assert city_table(spark).count() == 5


def test_missing_landing_folder(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        weather.read_payloads(spark, str(tmp_path / "nowhere"))
