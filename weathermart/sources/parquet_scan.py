"""Parquet uploads by the schemas in their footers.

A distributed pass reads each file's footer: its columns, their types and its row count, no
data. Files of one schema are one scan with that schema given, so nothing is inferred or
merged; columns are then cast to their declared type, or to one that all files share.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from weathermart.sources.csv_scan import (
    DATE_COLUMNS,
    DATE_MOMENT,
    DATE_NAME,
    DATE_TEXT,
    LINE,
    REASON,
    or_fail,
    typed,
)
from weathermart.sources.paths import literal_path, materialize, open_input, plain_path

_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_MOMENTS = (DateType, TimestampType, TimestampNTZType)


def spark_schema(file: pq.ParquetFile) -> StructType:
    """The schema that Spark reads a file with: its own record of it, or what the columns hold."""
    kept = (file.metadata.metadata or {}).get(_ROW_METADATA)
    if kept:
        return StructType.fromJson(json.loads(kept))
    found = from_arrow_schema(file.schema_arrow)
    physical = {c.path: c.physical_type for c in (file.schema.column(i) for i in range(len(file.schema)))}
    for field in found.fields:
        if physical.get(field.name) == "INT96":
            field.dataType = TimestampType()
    return found


def _footer(source: pa.NativeFile) -> bytes:
    """The footer's own bytes: sizes, places and statistics of every column chunk. It ends with
    its length and a mark of four bytes each."""
    size = source.size()
    source.seek(size - 8)
    length = int.from_bytes(source.read(4), "little")
    source.seek(size - 8 - length)
    return source.read(length)


def _read_footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schemas, rows, digests = [], [], []
        for path in batch.column("path").to_pylist():
            with open_input(path) as source:
                file = pq.ParquetFile(source)
                schemas.append(spark_schema(file).json())
                rows.append(file.metadata.num_rows)
                digests.append(hashlib.md5(_footer(source)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array(schemas, pa.string()), pa.array(rows, pa.int64()),
             pa.array(digests, pa.string())],
            ["path", "footer", "lines", "digest"],
        )


def footers(listed: DataFrame) -> DataFrame:
    """``path, footer, lines, digest`` of the listed Parquet files: schema (as JSON), row count and
    a digest of the content as the footer describes it."""
    paths = listed.filter(F.lower("path").endswith(".parquet")).select("path")
    return materialize(
        paths.repartition("path").mapInArrow(_read_footers, "path string, footer string, lines long, digest string"),
        "parquet_footers",
    )


def common_type(kinds: Sequence[DataType]) -> DataType:
    """One type for a column that files hold in several."""
    if len({k.simpleString() for k in kinds}) == 1:
        return kinds[0]
    if all(isinstance(k, _WHOLE) for k in kinds):
        return LongType()
    if all(isinstance(k, (*_WHOLE, FloatType, DoubleType, DecimalType)) for k in kinds):
        return DoubleType()
    if all(isinstance(k, _MOMENTS) for k in kinds):
        return TimestampType()
    return StringType()


def _scan(files: DataFrame, schema: StructType, types: dict[str, DataType], strict: bool) -> DataFrame:
    """Rows of the files of one schema, in the form of ``csv_scan.rows``."""
    name_of_file = plain_path(F.col("_metadata.file_name"))
    declared = {f.name.lower(): f.dataType for f in schema.fields if f.name not in DATE_COLUMNS}
    date = next((name for name in DATE_COLUMNS if name in files.columns), None)
    out, reasons = [], []
    for name in files.columns:
        column = F.col(f"`{name}`")
        if name == date:
            out.append(F.lit(None).cast("timestamp").alias(name))
        elif name.lower() in declared:
            is_number = not isinstance(files.schema[name].dataType, StringType)
            value, reason = typed(column, declared[name.lower()], name, is_number)
            out.append((or_fail(value, reason, name_of_file) if strict else value).alias(name))
            reasons += [] if strict else [reason]
        else:
            out.append(column.cast(types[name]).alias(name))
    text, moment = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    if date is not None:
        if isinstance(files.schema[date].dataType, _MOMENTS):
            moment = F.col(date).cast("timestamp")
        else:
            text = F.col(date).cast("string")
    return files.select(
        *out,
        F.struct("_metadata.file_path", name_of_file.alias("plain_name")).alias("_metadata"),
        F.coalesce(*reasons, F.lit(None).cast("string")).alias(REASON),
        F.to_json(F.struct(*(F.col(f"`{name}`") for name in files.columns))).alias(LINE),
        text.alias(DATE_TEXT),
        moment.alias(DATE_MOMENT),
        F.lit(date).cast("string").alias(DATE_NAME),
    )


def rows(
    spark: SparkSession,
    directory: str,
    file_name: str | None,
    found: DataFrame,
    schema: StructType,
    strict: bool = False,
) -> DataFrame | None:
    """All rows of the files in ``footers`` form, one scan per distinct schema; ``None`` if
    there is no file.

    Where all files share a schema the folder itself is scanned. Otherwise the reader needs the
    names of each schema's files, and those alone reach the driver.
    """
    kinds = [StructType.fromJson(json.loads(r.footer)) for r in found.select("footer").distinct().collect()]
    if not kinds:
        return None
    by_name: dict[str, list[DataType]] = {}
    for kind in kinds:
        for field in kind.fields:
            by_name.setdefault(field.name, []).append(field.dataType)
    types = {name: common_type(several) for name, several in by_name.items()}
    scans = []
    for kind in kinds:
        reader = spark.read.schema(kind).option("pathGlobFilter", "*.parquet")
        if len(kinds) == 1 and file_name is None:
            files = reader.parquet(directory)
        else:
            own = found.filter(F.col("footer") == kind.json()).select("path").collect()
            files = reader.parquet(*(literal_path(r.path) for r in own))
        scans.append(_scan(files, schema, types, strict))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
