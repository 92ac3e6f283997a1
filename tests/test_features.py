import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from weathermart.functions.cities import assign_city
from weathermart.functions.keys import with_dense_id
from weathermart.functions.measures import (
    rain_flag,
    rolling_sales,
    round_half_up,
    sales_bucket,
    temperature_bucket,
)
from weathermart.functions.temporal import shift_date, weekday_name


def column(spark, kind, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_city_follows_the_signed_remainder(spark):
    df = column(spark, "int", 0, 1, 2, 3, 4, 17850, -7, -5, None)
    assert apply(df, assign_city("v")) == [
        "London", "Manchester", "Birmingham", "Leeds", "Glasgow", "London", "Glasgow", "London",
        "Glasgow",
    ]
    assert apply(df, assign_city("v", ["a", "b"]))[:5] == ["a", "b", "a", "b", "a"]
    assert apply(df, assign_city("v", ["only"])) == ["only"] * 9


def test_rain_flag(spark):
    df = column(spark, "double", 0.0, 0.1, -1.0, None)
    assert apply(df, rain_flag(F.col("v"))) == [0, 1, 0, 0]


def test_temperature_bounds(spark):
    df = column(spark, "double", 9.99, 10.0, 19.99, 20.0, None)
    assert apply(df, temperature_bucket(F.col("v"))) == [
        "Cold", "Moderate", "Moderate", "Hot", "Hot",
    ]


def test_sales_bounds(spark):
    df = column(spark, "double", 499.99, 500.0, 1999.99, 2000.0, None)
    assert apply(df, sales_bucket(F.col("v"))) == ["Low", "Medium", "Medium", "High", "High"]


def test_shift_drops_the_time_and_clamps_month_ends(spark):
    df = column(
        spark, "timestamp", dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2012, 2, 29, 23, 59), None
    )
    assert apply(df, shift_date(F.col("v"), 144)) == [
        dt.date(2022, 12, 1), dt.date(2024, 2, 29), None,
    ]
    assert apply(df, shift_date(F.col("v"), 12))[1] == dt.date(2013, 2, 28)


def test_twelve_years_move_the_weekday_by_one(spark):
    df = column(spark, "timestamp", dt.datetime(2010, 12, 1))
    assert apply(df, weekday_name(F.col("v").cast("date"))) == ["Wednesday"]
    assert apply(df, weekday_name(shift_date(F.col("v"), 144))) == ["Thursday"]


def test_weekday_names(spark):
    days = [dt.date(2024, 6, d) for d in range(2, 9)]
    assert apply(column(spark, "date", *days), weekday_name(F.col("v"))) == [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    ]


def test_rounding_is_half_up_in_decimal(spark):
    df = column(spark, "double", 1.005, 2.675, -1.005, 1e15 + 0.25, None)
    assert apply(df, round_half_up(F.col("v"))) == [1.01, 2.68, -1.01, 1e15 + 0.25, None]


@pytest.fixture(scope="module")
def gapped(spark):
    """Ten trading days with a gap of one month after the fifth."""
    days = [dt.date(2022, 1, d) for d in range(1, 6)] + [dt.date(2022, 2, d) for d in range(5, 10)]
    data = [(d, "London", float(i)) for i, d in enumerate(days, 1)] + [(days[0], "Leeds", 100.0)]
    return spark.createDataFrame(data, "date date, city string, total_sales double")


def rolled(df, frame):
    found = df.select("city", "date", rolling_sales(frame).alias("r"))
    return [row.r for row in found.filter("city = 'London'").orderBy("date").collect()]


def test_row_frame_spans_eight_rows_across_gaps(gapped):
    assert rolled(gapped, "rows") == pytest.approx([1, 1.5, 2, 2.5, 3, 3.5, 4, 4.5, 5.5, 6.5])


def test_day_frame_spans_seven_calendar_days(gapped):
    assert rolled(gapped, "days") == pytest.approx([1, 1.5, 2, 2.5, 3, 6, 6.5, 7, 7.5, 8])


def test_unknown_frame(gapped):
    with pytest.raises(ValueError, match="rolling frame"):
        rolling_sales("weeks")


def test_dense_ids_do_not_depend_on_partitioning(spark, conf):
    members = spark.range(5000).select(F.concat(F.lit("code "), F.col("id")).alias("k"))
    seen = []
    for shuffle, parts in (("3", 1), ("7", 5), ("11", 16)):
        conf(spark__sql__shuffle__partitions=shuffle)
        seen.append(rows(with_dense_id(members.repartition(parts), ["k"], "id")))
    assert seen[0] == seen[1] == seen[2]
    assert sorted(row[1] for row in seen[0]) == list(range(5000))


def test_dense_ids_of_nulls_and_of_nothing(spark):
    members = spark.createDataFrame([("a", None), ("a", "b"), (None, None)], "x string, y string")
    found = with_dense_id(members, ["x", "y"], "id")
    assert sorted(row.id for row in found.collect()) == [0, 1, 2]
    assert with_dense_id(members.limit(0), ["x", "y"], "id").count() == 0
