"""Retail uploads: discovery, scan, provenance, validation and the raw sink."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    NullType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from weathermart.functions.temporal import UPLOAD_DATE_FORMATS, parse_timestamp
from weathermart.schemas import RETAIL_UPLOAD
from weathermart.sources import csv_scan, date_votes, ledger, parquet_scan
from weathermart.sources.csv_scan import (
    DATE_COLUMNS,
    DATE_MOMENT,
    DATE_NAME,
    DATE_TEXT,
    LINE,
    REASON,
    or_fail,
)
from weathermart.sources.paths import (
    layer_path,
    literal_path,
    materialize,
    plain_path,
    scratch_scope,
)
from weathermart.sources.tables import write

SOURCE_FILE, ENTITY, INGESTED_AT = "_source_file", "_entity", "_ingested_at"

_UNREADABLE = "__unreadable_date"
_SCANNED = (REASON, LINE, DATE_TEXT, DATE_MOMENT, DATE_NAME)


def list_uploads(spark: SparkSession, directory: str, file_name: str | None = None) -> DataFrame:
    """``path`` of one named file, or of every ``*.csv`` and ``*.parquet`` in a folder.

    Only the listing is read, never file contents. Zero-byte files are not listed.
    """
    reader = spark.read.format("binaryFile")
    if file_name is None:
        reader = reader.option("pathGlobFilter", "*.{csv,parquet}")
    target = _target(directory, file_name)
    try:
        return reader.load(target).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"uploads not found: {target}") from error
        raise


def _target(directory: str, file_name: str | None) -> str:
    return directory if file_name is None else f"{directory.rstrip('/')}/{literal_path(file_name)}"


def _any_parquet(spark: SparkSession, directory: str) -> bool:
    """Whether the folder's listing has a Parquet file; no job is needed for none."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return not names.load(directory).select("path").isEmpty()


def inspect_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, utf8, layout`` per CSV file: whether all of it is valid UTF-8, and a hash of its header."""
    files = csv_scan.stage(spark, [literal_path(path) for path in paths]).files
    return files.select("path", "utf8", F.xxhash64("names").alias("layout"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame of all columns; a column of several types becomes text."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            if not isinstance(f.dataType, NullType):
                kinds.setdefault(f.name.lower(), set()).add(f.dataType.simpleString())
    mixed = {name for name, several in kinds.items() if len(several) > 1 and name != "_metadata"}
    same = [
        df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns if c.lower() in mixed})
        for df in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


def _complete(df: DataFrame, schema: StructType) -> DataFrame:
    """Add the declared columns that the frame lacks, null; the date column as a timestamp."""
    present = {name.lower() for name in df.columns}
    return df.withColumns(
        {
            f.name: F.lit(None).cast("timestamp" if f.name in DATE_COLUMNS else f.dataType)
            for f in schema.fields
            if f.name.lower() not in present
        }
    )


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def add_provenance(df: DataFrame, entity: str, ingested_at: str | None = None) -> DataFrame:
    """Add ``_source_file``, ``_entity`` and ``_ingested_at`` (UTC, ISO text).

    The stamp is one constant per call, so a retried task writes the same value.
    """
    stamp = ingested_at or utc_now()
    scanned = "_metadata" in df.columns and "plain_name" in df.schema["_metadata"].dataType.names
    name = F.col("_metadata.plain_name") if scanned else plain_path(F.col("_metadata.file_name"))
    return df.withColumns(
        {
            SOURCE_FILE: name,
            ENTITY: F.lit(entity),
            INGESTED_AT: F.lit(stamp),
        }
    )


def date_column(columns: Sequence[str]) -> str | None:
    return next((name for name in DATE_COLUMNS if name in columns), None)


def parse_date_column(
    df: DataFrame, formats: Sequence[str] = UPLOAD_DATE_FORMATS, unreadable: str | None = None
) -> DataFrame:
    """Turn the detected date column into a timestamp; bad text becomes null.

    ``unreadable`` names a boolean column to add that marks text which no format reads.
    """
    name = date_column(df.columns)
    if name is None:
        return df if unreadable is None else df.withColumn(unreadable, F.lit(False))
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        dated = df.withColumn(name, F.col(name).cast("timestamp"))
        return dated if unreadable is None else dated.withColumn(unreadable, F.lit(False))
    parsed = parse_timestamp(F.col(name).cast("string"), formats)
    if unreadable is not None:
        df = df.withColumn(unreadable, F.col(name).isNotNull() & parsed.isNull())
    return df.withColumn(name, parsed)


def _dates_of(df: DataFrame) -> list[Column]:
    found = [F.col(f"`{n}`") for n in DATE_COLUMNS if n in df.columns and isinstance(df.schema[n].dataType, TimestampType)]
    return found or [F.lit(None).cast("timestamp")]


def with_year_month(df: DataFrame, moment: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Add ``year`` and zero-padded ``month`` of the date column, or of ``moment``.

    Returns the frame and its partition columns. Rows without a readable date, and
    frames without a date column, keep null parts and land in Hive's default
    partition, so that a table has one layout whatever arrives first.
    """
    if moment is None:
        name = date_column(df.columns)
        moment = F.lit(None).cast("timestamp") if name is None else F.col(name)
    parts = {"year": F.year(moment), "month": F.lpad(F.month(moment).cast("string"), 2, "0")}
    return df.withColumns(parts), list(parts)


def short(path: str | Column) -> Column:
    """One spelling of local paths: readers and listings write one slash or three."""
    path = F.col(path) if isinstance(path, str) else path
    return F.when(path.startswith("file:"), F.regexp_replace(path, "^file:/+", "file:/")).otherwise(path)


class Scan:
    """Uploads of a folder (or one named file) after their one pass: rows, votes and file facts.

    ``rows`` holds every line, with ``csv_scan.REASON`` where it cannot be taken; it is ``None``
    if there are no uploads. ``votes`` and ``files`` tell how dates are read, and the number of
    data lines, by file. ``only`` and ``facts_only`` come before these two are asked for.
    """

    def __init__(
        self,
        spark: SparkSession,
        directory: str,
        file_name: str | None = None,
        schema: StructType = RETAIL_UPLOAD,
        multiline: bool = False,
        encoding: str | None = None,
        formats: Sequence[str] = UPLOAD_DATE_FORMATS,
        on_error: str = "reject",
    ):
        if on_error not in ("fail", "reject"):
            raise ValueError(f"on_error must be fail or reject, not {on_error}")
        strict = self.strict = on_error == "fail"
        suffix = (file_name or "").rpartition(".")[2].lower()
        if file_name is not None and suffix not in ("csv", "parquet"):
            raise ValueError(f"Unsupported file type: {suffix}")
        self.listed = list_uploads(spark, directory, file_name)
        target = _target(directory, file_name)
        frames, facts = [], []
        if suffix in ("", "csv"):
            staged = csv_scan.stage(spark, target, multiline, encoding)
            frames.append(csv_scan.rows(staged, schema, encoding=encoding, strict=strict))
            facts.append(staged.files.select("path", "lines", "digest"))
        if suffix == "parquet" or not suffix and _any_parquet(spark, directory):
            found = parquet_scan.footers(self.listed)
            frames.append(parquet_scan.rows(spark, directory, file_name, found, schema, strict))
            facts.append(found.select("path", "lines", "digest"))
        frames = [df for df in frames if df is not None]
        self.files = reduce(DataFrame.unionByName, facts)
        self.formats = formats
        self.undated = _union(frames) if frames else None

    @cached_property
    def scanned(self) -> DataFrame | None:
        """The lines before their dates are read. Where lines may be refused, these are judged
        once, into scratch: votes, rows, report and refused lines all start from that table."""
        if self.undated is None or self.strict:
            return self.undated
        return materialize(self.undated, "upload_rows")

    @cached_property
    def votes(self) -> DataFrame | None:
        if self.scanned is None:
            return None
        uri = F.col("_metadata.file_path").alias("uri")
        return date_votes.vote(self.scanned.select(uri, F.col(DATE_TEXT).alias("text")), self.formats)

    @cached_property
    def rows(self) -> DataFrame | None:
        return None if self.scanned is None else self._dated(self.scanned)

    def _dated(self, rows: DataFrame) -> DataFrame:
        """Each file's date column as a timestamp, read as the file's own votes have it."""
        votes = self.votes.select(F.col("uri").alias("_uri"), "ranks", "best", "exceptions")
        read = rows.join(votes, F.col("_metadata.file_path") == F.col("_uri"), "left")
        moment = F.coalesce(F.col(DATE_MOMENT), date_votes.read_as_voted(F.col(DATE_TEXT), self.formats))
        dates = {
            name: F.when(F.col(DATE_NAME) == name, F.col("__moment"))
            for name in rows.columns
            if name in DATE_COLUMNS and isinstance(rows.schema[name].dataType, TimestampType)
        }
        return (
            read.withColumn("__moment", moment)
            .withColumns(dates)
            .withColumn(_UNREADABLE, F.col(DATE_TEXT).isNotNull() & F.col("__moment").isNull())
            .drop("_uri", "ranks", "best", "exceptions", "__moment")
        )

    def only(self, files: DataFrame) -> None:
        """Go on with the uploads whose ``path`` is among ``files``."""
        wanted = files.select(short("path").alias("_wanted"))
        path = short(plain_path(F.col("_metadata.file_path")))
        self.undated = self.undated.join(F.broadcast(wanted), path == F.col("_wanted"), "left_semi")
        self.listed = self.listed.join(wanted, short("path") == F.col("_wanted"), "left_semi")

    def facts_only(self) -> Scan:
        """Go on without the uploads' own columns, for a report."""
        if self.undated is not None:
            self.undated = self.undated.select("_metadata", *_SCANNED)
        return self

    def accepted(self) -> DataFrame:
        """Lines that can be taken. With ``on_error="fail"`` any other is an error."""
        reason = F.col(REASON)
        if not self.strict:
            return self.rows.filter(reason.isNull())
        place = F.concat(F.col("_metadata.plain_name"), F.lit(": "), F.col(LINE))
        return self.rows.filter(or_fail(F.lit(True), reason, place).cast("boolean"))

    def rejected(self) -> DataFrame:
        """``path, line, reason`` of the lines that cannot be taken."""
        return self.scanned.filter(F.col(REASON).isNotNull()).select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col(LINE).alias("line"),
            F.col(REASON).alias("reason"),
        )

    def report(self) -> DataFrame:
        """One row per listed upload: ``path, rows, rejected, accepted`` and how its dates are read.

        ``rows`` are the lines that can be taken; a file without one is not accepted. Lines were
        counted when the file was read; only refused ones are counted here, and after a scan
        that fails on them there are none.
        """

        listed = self.listed.select(short("path").alias("path"))
        files = self.files.select(short("path").alias("_path"), "lines", "digest")
        out = listed.join(files, F.col("path") == F.col("_path"), "left").drop("_path")
        dates = None
        if self.scanned is not None:
            dates = self.votes.select(
                short(plain_path(F.col("uri"))).alias("_path"), "layout", "exceptions", "ambiguous", "unreadable"
            )
        if self.scanned is None or self.strict:
            out = out.withColumn("rejected", F.lit(0).cast("long"))
        else:
            bad = self.rejected().groupBy(short("path").alias("_path")).agg(F.count(F.lit(1)).alias("bad"))
            out = out.join(bad, F.col("path") == F.col("_path"), "left").drop("_path")
            out = out.withColumn("rejected", F.coalesce("bad", F.lit(0))).drop("bad")
        rows = (F.coalesce("lines", F.lit(0)) - F.col("rejected")).alias("rows")
        out = out.select("path", "digest", rows, "rejected").withColumn("accepted", F.col("rows") > 0)
        if dates is None:
            none = F.lit(None).cast("long")
            return out.select("*", F.lit(None).cast("string").alias("date_layout"), none.alias("date_exceptions"),
                              none.alias("ambiguous_dates"), none.alias("unreadable_dates"))
        return out.join(dates, F.col("path") == F.col("_path"), "left").select(
            *out.columns,
            F.col("layout").alias("date_layout"),
            F.col("exceptions").alias("date_exceptions"),
            F.col("ambiguous").alias("ambiguous_dates"),
            F.col("unreadable").alias("unreadable_dates"),
        )


def read_uploads(
    spark: SparkSession,
    directory: str,
    file_name: str | None = None,
    schema: StructType = RETAIL_UPLOAD,
    multiline: bool = False,
    encoding: str | None = None,
    formats: Sequence[str] = UPLOAD_DATE_FORMATS,
    on_error: str = "fail",
) -> DataFrame | None:
    """Uploads as one frame with parsed dates; ``None`` if there are none.

    CSV files are UTF-8 where they are valid UTF-8, else Latin-1; columns are found by name, so
    files may order them differently or carry more of them. Declared columns get their
    declared type, others stay text. A named ``encoding`` holds for all files, which then must
    have the declared header. ``multiline`` allows quoted line breaks but makes a file
    unsplittable; without it such a line is refused. Files are read once, by this call, to
    shared scratch. Frames keep ``_metadata`` for ``add_provenance``.
    """
    scan = Scan(spark, directory, file_name, schema, multiline, encoding, formats, on_error)
    return None if scan.rows is None else scan.accepted().drop(*_SCANNED, _UNREADABLE)


def validate_uploads(
    spark: SparkSession,
    directory: str,
    schema: StructType = RETAIL_UPLOAD,
    multiline: bool = False,
    encoding: str | None = None,
) -> DataFrame:
    """The report that landing these uploads would give, without landing them; see ``Scan.report``."""
    return Scan(spark, directory, None, schema, multiline, encoding).facts_only().report()


def land_uploads(
    spark: SparkSession,
    directory: str,
    lake_root: str,
    entity: str = "retail_sales",
    source: str = "uci_online_retail",
    file_name: str | None = None,
    format: str = "parquet",
    ingested_at: str | None = None,
    schema: StructType = RETAIL_UPLOAD,
    multiline: bool = False,
    encoding: str | None = None,
    rebalance: bool = True,
    observation: Observation | None = None,
    formats: Sequence[str] = UPLOAD_DATE_FORMATS,
    dates: Observation | None = None,
    on_error: str = "fail",
    once: bool = False,
) -> str | None:
    """Append uploads to the raw layer by year and month; returns the table path.

    Appending twice keeps both batches, told apart by ``_ingested_at``. Returns
    ``None`` if the folder holds no uploads. Uploads whose lines are in date order
    touch few months per task and can do without the shuffle of ``rebalance``.
    ``observation`` collects ``rows``, ``dates`` the number of ``unreadable_dates``.
    Declared columns that an upload lacks are written as nulls of their type.

    A line that cannot be taken fails the landing, before anything is added. With
    ``on_error="reject"`` it goes to the table ``rejects`` instead. Either way the table
    ``landed`` gets the report of each upload (see ``report_path``).

    With ``once`` an upload whose content has been landed before, under whatever name, adds
    nothing, also where an earlier landing broke off before it could say so (see ``ledger``).
    """
    if format not in ("parquet", "csv"):
        raise ValueError(f"Unsupported output format: {format}")
    with scratch_scope(spark):
        scan = Scan(spark, directory, file_name, schema, multiline, encoding, formats, on_error)
        if scan.undated is None:
            return None
        stamp = ingested_at or utc_now()
        path = layer_path(lake_root, "raw", entity, source)
        stamped = F.lit(stamp).alias(INGESTED_AT)
        book = ledger.Ledger(spark, path, *(report_path(lake_root, t, entity, source) for t in ("started", "landed")))
        if once:
            book.settle(format)
            new = materialize(book.unknown(scan.files), "new_uploads")
            scan.only(new)
            book.start(new.select("*", stamped))
        rows = add_provenance(scan.accepted(), entity, stamp)
        landed, partition_cols = with_year_month(_complete(rows, schema), F.coalesce(*_dates_of(rows)))
        if dates is not None:
            landed = landed.observe(dates, F.count_if(_UNREADABLE).alias("unreadable_dates"))
        write(
            landed.drop(*_SCANNED, _UNREADABLE, "_metadata"),
            path,
            format,
            partition_cols,
            mode="append",
            rebalance=rebalance,
            observation=observation,
        )
        report = scan.report()
        if on_error == "reject":
            report = materialize(report, "upload_report")
        if on_error == "reject" and report.filter("rejected > 0").limit(1).count():
            refused = scan.rejected().select("*", stamped)
            write(refused, report_path(lake_root, "rejects", entity, source), mode="append")
        book.commit(report.select("*", stamped))
    return path


def report_path(lake_root: str, table: str, entity: str = "retail_sales", source: str = "uci_online_retail") -> str:
    """Where landing keeps its tables ``landed`` and ``started`` (a row per upload) and ``rejects``
    (a row per line)."""
    return layer_path(lake_root, "reports", f"{entity}_{table}", source)
