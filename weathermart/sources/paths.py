"""Lake layout and the shared scratch folder."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def layer_path(root: str, layer: str, entity: str, source: str, **partition: object) -> str:
    """``<root>/<layer>/<entity>/<source>/k=v/...``; Spark creates it on write."""
    parts = [root.rstrip("/"), layer, entity, source]
    parts += [f"{key}={value}" for key, value in partition.items()]
    return "/".join(parts)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path in storage that the driver and all executors share.

    That is the folder named in ``spark.checkpoint.dir``, else the warehouse. Paths
    carry the application id, so ``drop_scratch`` (or a bucket rule) can remove a
    finished application's tables together. Inside ``scratch_scope`` they lie in its folder.
    """
    scope = getattr(_scopes, "path", None)
    return f"{scope or _scratch_root(spark)}/{uuid.uuid4().hex}"


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when it ends: for jobs that write their result.

    Frames that read those tables must not leave the scope. Scopes may be nested.
    """
    outer = getattr(_scopes, "path", None)
    path = scratch_dir(spark)
    _scopes.path = path
    try:
        yield
    finally:
        _scopes.path = outer
        delete(spark, path)


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/weathermart/{spark.conf.get('spark.app.id', 'unnamed')}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this application; frames that read them end with it."""
    delete(spark, _scratch_root(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it, in any storage that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Hadoop's names of storage that goes by another name elsewhere.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that Spark uses, and the path inside it, for use inside tasks.

    Local paths are taken literally, with spaces and whatever else they hold.
    """
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme in ("file", "dbfs"):
        place = "/" + rest.lstrip("/")
        return fs.LocalFileSystem(), f"/dbfs{place}" if scheme == "dbfs" else place
    host, _, key = rest.removeprefix("//").partition("/")
    found, base = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{host}/")
    return found, f"{base.rstrip('/')}/{key}"


def open_input(path: str) -> pa.NativeFile:
    """A file that Spark has listed, opened inside a task."""
    found, place = storage(path)
    return found.open_input_file(place)


def distilled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize`` of what ``make`` returns, without the scratch tables that it made on its way."""
    path = f"{scratch_dir(spark)}/{name}"
    with scratch_scope(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where one lineage feeds several consumers. The table survives lost
    executors, is not recomputed per consumer, and tells the planner its real
    size: below ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, above
    it a join falls back to sort-merge with adaptive skew handling.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_path(path: str) -> str:
    """``path`` for a reader that expands patterns, with its own ``* ? [ ] { }`` escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def plain_path(uri: Column) -> Column:
    """Undo the URI escapes of ``_metadata`` file names; a plus sign is literal there."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.instr(uri, "%") > 0, decoded).otherwise(uri)
