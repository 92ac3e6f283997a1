"""Explicit schemas of the raw inputs and column contracts of every table.

Raw text formats are read with these schemas, so there is no inference pass.
Contracts are compared with a frame's schema before it is written; that is a
metadata check and costs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, LONG = StringType(), IntegerType(), LongType()
DOUBLE, DATE = DoubleType(), DateType()


def columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# One retail upload file. CustomerID is a double because exports of a nullable
# integer column carry "17850.0"; InvoiceDate is text until the landing step.
RETAIL_UPLOAD = columns(
    InvoiceNo=STRING,
    StockCode=STRING,
    Description=STRING,
    Quantity=INT,
    InvoiceDate=STRING,
    UnitPrice=DOUBLE,
    CustomerID=DOUBLE,
    Country=STRING,
)

# Uploads in the raw layer. Files may hold more columns; these are always there.
RAW_SALES = StructType(
    [
        *(
            StructField("InvoiceDate", TimestampType()) if f.name == "InvoiceDate" else f
            for f in RETAIL_UPLOAD.fields
        ),
        *columns(_source_file=STRING, _entity=STRING, _ingested_at=STRING, year=INT, month=STRING),
    ]
)

# The series of a weather document, parallel arrays, one element per day.
_SERIES = {
    "time": STRING,
    "temperature_2m_max": DOUBLE,
    "temperature_2m_min": DOUBLE,
    "temperature_2m_mean": DOUBLE,
    "precipitation_sum": DOUBLE,
    "rain_sum": DOUBLE,
    "snowfall_sum": DOUBLE,
    "windspeed_10m_max": DOUBLE,
    "weathercode": LONG,
}

# A weather payload as it arrives: one JSON object, parallel arrays under `daily`.
WEATHER_PAYLOAD = columns(
    latitude=DOUBLE,
    longitude=DOUBLE,
    timezone=STRING,
    daily_units=columns(**dict.fromkeys(_SERIES, STRING)),
    daily=columns(**{name: ArrayType(kind) for name, kind in _SERIES.items()}),
)

# The same document in the raw layer, with provenance and its partition column.
WEATHER_DOCUMENT = StructType(
    [
        *WEATHER_PAYLOAD.fields,
        StructField(
            "_meta",
            columns(
                city=STRING,
                country=STRING,
                lat=DOUBLE,
                lon=DOUBLE,
                extracted_at=STRING,
                source=STRING,
            ),
        ),
        StructField("city", STRING),
    ]
)

# What the bronze layer takes of a raw weather document.
WEATHER_DAYS = StructType(
    [
        StructField(
            "daily",
            columns(
                time=ArrayType(STRING),
                temperature_2m_max=ArrayType(DOUBLE),
                temperature_2m_min=ArrayType(DOUBLE),
                precipitation_sum=ArrayType(DOUBLE),
            ),
        ),
        StructField("_meta", columns(extracted_at=STRING)),
        StructField("city", STRING),
    ]
)

CONTRACTS: dict[str, StructType] = {
    "bronze_sales": columns(
        InvoiceNo=STRING,
        StockCode=STRING,
        Description=STRING,
        Quantity=INT,
        UnitPrice=DOUBLE,
        CustomerID=INT,
        Country=STRING,
        city=STRING,
        date=DATE,
    ),
    "bronze_weather": columns(
        city=STRING, date=STRING, temp_max=DOUBLE, temp_min=DOUBLE, precipitation=DOUBLE
    ),
    "silver_sales_daily": columns(date=DATE, city=STRING, total_sales=DOUBLE),
    "silver_product_grain": columns(
        date=DATE,
        city=STRING,
        StockCode=STRING,
        Description=STRING,
        Quantity=INT,
        UnitPrice=DOUBLE,
        total_price=DOUBLE,
    ),
    "silver_weather": columns(date=DATE, city=STRING, avg_temp=DOUBLE, precipitation=DOUBLE),
    "gold_sales_weather": columns(
        date=DATE,
        city=STRING,
        total_sales=DOUBLE,
        avg_temp=DOUBLE,
        precipitation=DOUBLE,
        is_rainy=INT,
        temp_category=STRING,
        sales_category=STRING,
        rolling_7d_sales=DOUBLE,
    ),
    "dim_date": columns(
        date=DATE,
        year=INT,
        month=INT,
        day=INT,
        day_of_week=INT,
        week_of_year=INT,
        date_id=STRING,
    ),
    "dim_location": columns(city=STRING, location_id=LONG),
    "dim_product": columns(stock_code=STRING, product_description=STRING, product_id=LONG),
    "fact_sales_weather": columns(
        date_id=STRING,
        location_id=LONG,
        total_sales=DOUBLE,
        avg_temp=DOUBLE,
        precipitation=DOUBLE,
        is_rainy=INT,
        rolling_7d_sales=DOUBLE,
    ),
    "fact_sales_weather_product": columns(
        date_id=STRING,
        location_id=LONG,
        product_id=LONG,
        stock_code=STRING,
        product_description=STRING,
        Quantity=INT,
        UnitPrice=DOUBLE,
        total_price=DOUBLE,
        avg_temp=DOUBLE,
        precipitation=DOUBLE,
        is_rainy=INT,
        temp_category=STRING,
    ),
}


def check_contract(df: DataFrame, name: str) -> DataFrame:
    """Return ``df`` with the contract's columns in order, or raise ``ValueError``.

    Extra columns are an error too: a table must not change shape silently.
    """
    expected = {f.name: f.dataType.simpleString() for f in CONTRACTS[name].fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [
        f"{column}: expected {expected.get(column, 'no such column')}, "
        f"found {found.get(column, 'no such column')}"
        for column in sorted(expected.keys() | found.keys())
        if expected.get(column) != found.get(column)
    ]
    if problems:
        raise ValueError(f"{name} breaks its contract; " + "; ".join(problems))
    return df.select(*expected)
