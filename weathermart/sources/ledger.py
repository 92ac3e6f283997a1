"""The landing ledger: which uploads the raw table holds, by the digest of their content.

A landing notes what it is about to add (``started``), appends the rows, and then commits its
report (``landed``). What was started and never committed is settled before the next landing:
if all its rows are there, the commit is made up for; otherwise the files it left, which hold
nothing else, are removed. So repeating a landing, or repeating it after a crash at any point,
adds no row twice. One landing at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weathermart.sources.paths import delete
from weathermart.sources.tables import write

STARTED = "path string, lines long, digest string, _ingested_at string"
LANDED = (
    "path string, digest string, rows long, rejected long, accepted boolean, date_layout string, "
    "date_exceptions long, ambiguous_dates long, unreadable_dates long, _ingested_at string"
)
STAMP = "_ingested_at"


def read_or_empty(spark: SparkSession, path: str, schema: str, format: str = "parquet") -> DataFrame:
    """A table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).format(format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Ledger:
    def __init__(self, spark: SparkSession, raw: str, started: str, landed: str):
        self.spark, self.raw, self.started_path, self.landed_path = spark, raw, started, landed

    def started(self) -> DataFrame:
        return read_or_empty(self.spark, self.started_path, STARTED)

    def landed(self) -> DataFrame:
        return read_or_empty(self.spark, self.landed_path, LANDED)

    def unknown(self, files: DataFrame) -> DataFrame:
        """``path, lines, digest`` of the files whose content has not been landed."""
        done = self.landed().select("digest").distinct()
        return files.select("path", "lines", "digest").join(done, "digest", "left_anti").select("path", "lines", "digest")

    def start(self, files: DataFrame) -> None:
        write(files.select("path", "lines", "digest", STAMP), self.started_path, mode="append")

    def commit(self, report: DataFrame) -> None:
        write(report, self.landed_path, mode="append")

    def settle(self, format: str = "parquet") -> None:
        """Finish or undo the landings that broke off."""
        done = self.landed().select(STAMP).distinct()
        broken = self.started().join(done, STAMP, "left_anti")
        # One row per landing that broke off; as a rule none.
        for batch in broken.groupBy(STAMP).agg(F.sum("lines").alias("lines")).collect():
            raw = read_or_empty(self.spark, self.raw, f"{STAMP} string", format)
            own = raw.filter(F.col(STAMP) == batch[STAMP])
            if own.count() == batch.lines:
                none = F.lit(None)
                self.commit(
                    broken.filter(F.col(STAMP) == batch[STAMP]).select(
                        "path", "digest", F.col("lines").alias("rows"), F.lit(0).cast("long").alias("rejected"),
                        (F.col("lines") > 0).alias("accepted"), none.cast("string").alias("date_layout"),
                        *(none.cast("long").alias(c) for c in ("date_exceptions", "ambiguous_dates", "unreadable_dates")),
                        STAMP,
                    )
                )
                continue
            # The files of that landing alone: their names are what the removal needs.
            for row in own.select(F.col("_metadata.file_path").alias("path")).distinct().collect():
                delete(self.spark, row.path)
            self._forget(batch[STAMP])

    def _forget(self, stamp: str) -> None:
        """Note that a landing was undone, by a report without uploads."""
        nothing = self.spark.range(1).select(
            *(F.lit(None).cast(kind).alias(name) for name, kind in (c.strip().split(" ") for c in LANDED.split(",")))
        )
        self.commit(nothing.withColumn(STAMP, F.lit(stamp)))


def newest_batches(landed: DataFrame) -> DataFrame:
    """The last ``_ingested_at`` of every source file that added rows, from the ledger alone."""
    return (
        landed.filter("rows > 0")
        .groupBy(F.substring_index("path", "/", -1).alias("_source_file"))
        .agg(F.max(STAMP).alias(STAMP))
    )
