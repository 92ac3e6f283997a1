"""Weather payloads: landing scan, validation, enrichment, raw sink and raw scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from weathermart.functions.cities import CITIES, City, city_table
from weathermart.schemas import WEATHER_DOCUMENT, WEATHER_PAYLOAD
from weathermart.sources.paths import layer_path

_CORRUPT = "_corrupt_record"
# Fixed value: the label of the weather service in `_meta`.
SOURCE_LABEL = "open_meteo_archive"


def _series_as_text(schema: StructType) -> StructType:
    """The schema with every series of ``daily`` as text, to be cast element by element."""
    text = ArrayType(StringType())
    return StructType(
        [
            StructField("daily", StructType([StructField(s.name, text) for s in f.dataType.fields]))
            if f.name == "daily"
            else f
            for f in schema.fields
        ]
    )


def _cast_each(series: Column, kind: DataType) -> Column:
    def cast(cell: Column) -> Column:
        whole = isinstance(kind, LongType)
        return (cell.try_cast("double") if whole else cell).try_cast(kind)

    return F.transform(series, cast)


def _typed_series(daily: Column, schema: StructType) -> Column:
    """``daily`` with the types of ``schema``; a cell of another type becomes null alone."""
    series = [
        _cast_each(daily[f.name], f.dataType.elementType).alias(f.name)
        for f in schema["daily"].dataType.fields
    ]
    return F.when(daily.isNotNull(), F.struct(*series))


def read_payloads(
    spark: SparkSession, landing: str, schema: StructType = WEATHER_PAYLOAD
) -> DataFrame:
    """Landed payload files below ``city=<name>/``, one row per file.

    Columns: the untouched text as ``payload``, ``city``, and ``doc``, the parsed
    document; a cell that has not the type of its series is null. Parsing from text rather than with the JSON source keeps broken
    files and top-level arrays as single rows that can be reported.
    """
    parsed = StructType([*_series_as_text(schema).fields, StructField(_CORRUPT, StringType())])
    return (
        spark.read.schema("payload string, city string")
        .text(landing, wholetext=True)
        .withColumn(
            "doc", F.from_json("payload", parsed, {"columnNameOfCorruptRecord": _CORRUPT})
        )
        .withColumn(
            "doc", F.col("doc").withField("daily", _typed_series(F.col("doc.daily"), schema))
        )
    )


def with_rejection(payloads: DataFrame) -> DataFrame:
    """Add ``reason``: null for a valid payload, else the first failed check."""
    daily = F.col("doc.daily")
    broken = (
        F.col("doc").isNull()
        | (F.col(f"doc.{_CORRUPT}").isNotNull() & daily.isNull())
        | ~F.col("payload").rlike(r"\}\s*$")
    )
    return payloads.withColumn(
        "reason",
        F.when(broken, "not a JSON object")
        .when(daily.isNull(), "daily is missing")
        .when(F.coalesce(F.size("doc.daily.time"), F.lit(0)) <= 0, "daily.time is empty"),
    )


def valid_payloads(payloads: DataFrame, observation: Observation | None = None) -> DataFrame:
    """The documents that pass every check: their fields, ``city`` and the whole ``payload``.

    ``observation`` counts ``documents`` and ``rejected`` while they are used.
    """
    fields = [f.name for f in payloads.schema["doc"].dataType.fields if f.name != _CORRUPT]
    checked = with_rejection(payloads)
    if observation is not None:
        checked = checked.observe(
            observation,
            F.count_if(F.col("reason").isNull()).alias("documents"),
            F.count("reason").alias("rejected"),
        )
    return checked.filter(F.col("reason").isNull()).select(
        "city", "payload", *(F.col(f"doc.{name}") for name in fields)
    )


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    """``city, reason, payload`` of everything ``valid_payloads`` leaves out."""
    return (
        with_rejection(payloads)
        .filter(F.col("reason").isNotNull())
        .select("city", "reason", "payload")
    )


def enrich_payloads(
    documents: DataFrame,
    cities: Sequence[City] = CITIES,
    extracted_at: str | None = None,
    source: str = SOURCE_LABEL,
) -> DataFrame:
    """Add ``_meta`` from the city list; a city that is not listed keeps null coordinates."""
    stamp = extracted_at or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    listed = city_table(documents.sparkSession, cities)
    return (
        documents.join(listed, documents["city"] == listed["name"], "left")
        .withColumn(
            "_meta",
            F.struct(
                F.col("city").alias("city"),
                "country",
                "lat",
                "lon",
                F.lit(stamp).alias("extracted_at"),
                F.lit(source).alias("source"),
            ),
        )
        .drop("name", "country", "lat", "lon")
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """Append whole documents with their ``_meta``, one per file, partitioned by ``city``.

    The landed text is kept as it is, with fields and series that no schema lists;
    ``_meta`` goes in as its last field.
    """
    meta = F.to_json("_meta", {"ignoreNullFields": "false"})
    text = F.concat(
        F.regexp_replace("payload", r"\s*\}\s*$", ""), F.lit(',\n  "_meta": '), meta, F.lit("\n}")
    )
    (
        documents.select(text.alias("value"), "city")
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .partitionBy("city")
        .text(path)
    )


def land_payloads(
    spark: SparkSession,
    landing: str,
    lake_root: str,
    source: str = "open_meteo",
    cities: Sequence[City] = CITIES,
    extracted_at: str | None = None,
    observation: Observation | None = None,
    schema: StructType = WEATHER_PAYLOAD,
) -> str:
    """Validate, enrich and append landed payloads to the raw layer; returns its path.

    Rejected payloads are skipped and counted in ``observation``; read them with
    ``rejected_payloads``. Accepted ones are written whole; ``schema`` only checks them.
    """
    documents = valid_payloads(read_payloads(spark, landing, schema), observation)
    path = layer_path(lake_root, "raw", "weather", source)
    write_documents(enrich_payloads(documents, cities, extracted_at), path)
    return path


def read_documents(
    spark: SparkSession, path: str, schema: StructType = WEATHER_DOCUMENT
) -> DataFrame:
    """Raw weather documents; ``city`` comes from the folder name.

    ``schema`` may list fewer fields: what it leaves out is not parsed.
    """
    documents = spark.read.schema(_series_as_text(schema)).option("multiLine", True).json(path)
    return documents.withColumn("daily", _typed_series(F.col("daily"), schema))
