"""CSV uploads as one scan: files are read once, whatever encodings and headers they have.

Every line is cut into cells and written once to shared scratch (``stage``), as bytes that Latin-1
can hold. From that table each file's facts follow: whether it is valid UTF-8, and its header.
Lines then meet the facts of their file by a join on its path, and a column takes the cell at
the position that the file's own header gives it (``rows``). No path reaches the driver, and
the plan is the same for one header or a million; only distinct column names are collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from weathermart.sources.paths import materialize, plain_path

# CSV cells read as missing, the documented pandas.read_csv defaults.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column names that mark the invoice date, first match wins.
DATE_COLUMNS = ("InvoiceDate", "invoice_date", "date", "Date")

# Columns of a scan beside the uploads' own: why a line cannot be taken, its text, and the text
# (or, in Parquet, the moment) of the file's date column, with that column's name.
REASON, LINE = "__reason", "__line"
DATE_TEXT, DATE_MOMENT, DATE_NAME = "__date_text", "__date_moment", "__date_name"

# Cells a record may have under ``multiline``.
MAX_CELLS = 1000

_CELL = r',("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'
_QUOTED = r'^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


@dataclass(frozen=True)
class Staged:
    """``lines``: uri, name, at, cells, odd, open. ``files``: uri, name, path, utf8, head, names,
    date_name, width, lines (data lines), digest (of the content)."""

    lines: DataFrame
    files: DataFrame


def _latin(value: Column) -> Column:
    """The bytes of a text, one character each."""
    # Lengths alone do not tell: a stray byte of a longer character counts as one.
    ascii_only = F.is_valid_utf8(value) & (F.octet_length(value) == F.char_length(value))
    return F.when(ascii_only, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def _from_latin(cell: Column, charset: str) -> Column:
    return F.decode(F.encode(cell, "ISO-8859-1"), charset)


def _apart(value: Column, rare: Callable[[Column], Column]) -> Column:
    """``rare(value)``, for branches that few rows take.

    As a function over an array it is interpreted. So the step around it is no part of one long
    method, which the JVM would not compile, but of several short ones that it does compile.
    """
    return F.get(F.transform(F.array(value), rare), F.lit(0))


def _split(line: Column) -> Column:
    """Cells of a line; a quoted cell may hold commas and doubled quotes."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))
    quoted = F.transform(
        raw,
        lambda cell: F.when(
            cell.rlike(_QUOTED),
            F.replace(F.regexp_replace(cell, _QUOTED, "$1$2"), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )
    return F.when(F.instr(line, '"') == 0, F.split(line, ",", -1)).otherwise(quoted)


def _text_lines(spark: SparkSession, targets: str | Sequence[str]) -> DataFrame:
    line = _latin(F.col("value"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    opened = F.exists(
        F.regexp_extract_all(F.concat(F.lit(","), F.col("line")), F.lit(_CELL), F.lit(1)),
        lambda cell: cell.startswith('"') & ~cell.rlike(_QUOTED),
    )
    return (
        spark.read.option("pathGlobFilter", "*.csv")
        .text(targets)
        .filter(F.col("value") != "")
        .select(
            "_metadata.file_path",
            "_metadata.file_name",
            # Places in a file are compared in its first block only, where the header is.
            F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"),
            F.is_valid_utf8("value").alias("valid"),
            line.alias("line"),
        )
        .withColumns(
            {
                "cells": _split(F.col("line")),
                "odd": quotes % 2 == 1,
                "open": (quotes > 0) & opened,
            }
        )
    )


def _records(spark: SparkSession, targets: str | Sequence[str]) -> DataFrame:
    """Records that may hold quoted line breaks: one task per file, by the CSV reader."""
    names = [f"c{i}" for i in range(MAX_CELLS)]
    cells = F.array(*names)
    last = F.array_max(F.transform(cells, lambda cell, i: F.when(cell.isNotNull(), i + 1).otherwise(0)))
    whole = F.encode(F.concat_ws(",", "cells"), "ISO-8859-1").cast("string")
    return (
        spark.read.schema(", ".join(f"{name} string" for name in names))
        .options(pathGlobFilter="*.csv", multiLine=True, escape='"', encoding="ISO-8859-1", maxColumns=MAX_CELLS)
        .csv(targets)
        .select("_metadata.file_path", "_metadata.file_name", F.slice(cells, F.lit(1), last).alias("cells"))
        .filter(F.size("cells") > 0)
        .select(
            "*",
            F.monotonically_increasing_id().alias("at"),
            F.is_valid_utf8(whole).alias("valid"),
            F.lit(False).alias("odd"),
            F.lit(False).alias("open"),
        )
    )


def _unique(names: Column) -> Column:
    """Header cells as column names: unnamed ones by position, repeated ones numbered."""
    named = F.transform(
        names,
        lambda name, i: F.when(
            F.coalesce(name, F.lit("")) == "", F.concat(F.lit("_c"), i.cast("string"))
        ).otherwise(name),
    )

    def numbered(name: Column, i: Column) -> Column:
        before = F.filter(F.slice(named, F.lit(1), i), lambda other: F.lower(other) == F.lower(name))
        again = F.size(before)
        return F.when(again > 0, F.concat(name, F.lit("."), again.cast("string"))).otherwise(name)

    return F.transform(named, numbered)


def first_date_column(names: Column) -> Column:
    return F.coalesce(*(F.when(F.array_contains(names, name), name) for name in DATE_COLUMNS))


def stage(
    spark: SparkSession,
    targets: str | Sequence[str],
    multiline: bool = False,
    encoding: str | None = None,
) -> Staged:
    """Read all ``*.csv`` files of the targets once and write their cells and facts to scratch.

    ``encoding`` names the charset of all files; else each is UTF-8 if it is valid, or Latin-1.
    """
    read = _records(spark, targets) if multiline else _text_lines(spark, targets)
    lines = materialize(
        read.select(
            F.col("file_path").alias("uri"), F.col("file_name").alias("name"), "at", "valid", "cells", "odd", "open"
        ),
        "upload_lines",
    )
    utf8 = F.lit(encoding.upper() == "UTF-8") if encoding else F.bool_and("valid")
    charset = encoding or "UTF-8"
    decoded = F.transform("header", lambda cell: F.when(F.col("utf8"), _from_latin(cell, charset)).otherwise(cell))
    if encoding and encoding.upper() != "UTF-8":
        decoded = F.transform("header", lambda cell: _from_latin(cell, encoding))
    # Of all lines, in any order, so that every task adds up its own. Sums are of the hash's upper
    # and lower half, which longs hold.
    whole = F.xxhash64("cells")
    facts = materialize(
        lines.groupBy("uri", "name").agg(
            utf8.alias("utf8"),
            F.min("at").alias("head"),
            (F.count(F.lit(1)) - 1).alias("lines"),
            F.sum(F.shiftright(whole, 32)).alias("high"),
            F.sum(whole.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
            F.bit_xor(F.xxhash64(F.lit(1), "cells")).alias("xor"),
        ),
        "upload_facts",
    )
    # The header is fetched by its place; as an aggregate, cells would be sorted by file.
    heads = lines.filter(F.col("at").isNotNull()).select(
        F.col("uri").alias("_uri"), "at", F.col("cells").alias("header")
    )
    headed = facts.join(
        heads.join(F.broadcast(facts.select("uri", "head")), (F.col("_uri") == F.col("uri")) & (F.col("at") == F.col("head")))
        .select("_uri", "header"),
        F.col("uri") == F.col("_uri"),
        "left",
    )
    # Twice the width of a long, so decimals.
    total = F.col("high").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("low").cast("decimal(19,0)")
    files = materialize(
        headed.withColumn("names", _unique(decoded)).select(
            "uri", "name", plain_path(F.col("uri")).alias("path"), "utf8", "head", "names",
            first_date_column(F.col("names")).alias("date_name"), F.size("names").alias("width"), "lines",
            F.md5(F.concat_ws(":", "header", F.col("lines").cast("string"), total.cast("string"),
                              F.col("xor").cast("string")).cast("binary")).alias("digest"),
        ),
        "upload_files",
    )
    return Staged(lines, files)


def typed(text: Column, kind: DataType, name: str, is_number: bool = False) -> tuple[Column, Column]:
    """A cell (text, or ``is_number``) as its declared type, and why it cannot be (null if it can).

    Whole numbers may be written with a decimal point, as exports of nullable integer columns
    do; a real fraction is refused rather than cut off.
    """
    if isinstance(kind, StringType):
        return text.cast(kind), F.lit(None).cast("string")

    def because(shown: Column, problem: str) -> Column:
        return F.concat(F.lit(f"{name} {problem}: "), shown.cast("string"))

    def rest(shown: Column) -> Column:
        number = shown.try_cast("double")
        whole = number.try_cast(kind)
        return F.struct(
            F.when(number == F.floor(number), whole).alias("value"),
            F.when(number.isNull(), because(shown, "is not a number"))
            .when(number != F.floor(number), because(shown, "is not a whole number"))
            .when(whole.isNull(), because(shown, f"overflows {kind.simpleString()}"))
            .alias("reason"),
        )

    # The plain cast goes first: it is the common case, and the rest is for what it refuses.
    plain = text.try_cast(kind)
    if not isinstance(kind, (IntegerType, LongType)):
        of_kind = "a number" if isinstance(kind, (DoubleType, FloatType)) else f"of type {kind.simpleString()}"
        refused = _apart(text, lambda shown: because(shown, f"is not {of_kind}"))
        return plain, F.when(text.isNotNull() & plain.isNull(), refused)
    if is_number:
        number = text.try_cast("double")
        plain = F.when(number == F.floor(number), number.try_cast(kind))
    slow = _apart(text, rest)
    return F.coalesce(plain, slow["value"]), F.when(text.isNotNull() & plain.isNull(), slow["reason"])


def or_fail(value: Column, reason: Column, place: Column) -> Column:
    """``value``, or an error that tells the reason and the place."""
    error = F.raise_error(F.concat(reason, F.lit(" ["), place, F.lit("]")))
    return F.when(reason.isNotNull(), error).otherwise(value)


@dataclass(frozen=True)
class Named:
    """An output column: its name, the names it goes by in headers, and whether it is read where
    it is a file's date column, where it is not, or in both cases."""

    name: str
    spelling: str
    as_date: bool


def output_columns(found: Sequence[tuple[str, bool]], schema: StructType) -> list[Named]:
    """Output columns for header names, each with whether it is a file's date column.

    A name of several spellings takes the declared one, else the first. A further date column
    of a file stays text; where other files have that name as their date column, its text goes
    to ``<name>_text``.
    """
    spellings: dict[str, set[str]] = {}
    roles: dict[str, set[bool]] = {}
    for name, is_date in found:
        # Date columns are told apart by their exact names.
        key = name if name in DATE_COLUMNS else name.lower()
        spellings.setdefault(key, set()).add(name)
        roles.setdefault(key, set()).add(is_date)
    declared = {f.name if f.name in DATE_COLUMNS else f.name.lower(): f.name for f in schema.fields}
    order = [k for k in declared if k in spellings] + sorted(spellings.keys() - declared.keys())
    taken: set[str] = set()
    out = []
    for key in order:
        name = next(iter(spellings[key])) if len(spellings[key]) == 1 else declared.get(key, min(spellings[key]))
        for is_date in sorted(roles[key], reverse=True):
            shown = name if is_date or len(roles[key]) == 1 else f"{name}_text"
            while shown.lower() in taken:
                shown += "_"
            taken.add(shown.lower())
            out.append(Named(shown, key, is_date))
    return out


def rows(
    staged: Staged,
    schema: StructType,
    null_markers: Sequence[str] = NULL_MARKERS,
    encoding: str | None = None,
    strict: bool = False,
) -> DataFrame | None:
    """All data lines with their columns found by name, and ``__reason`` where a line cannot be
    taken as declared; ``None`` if no file has a line. If ``strict``, cells that cannot be read
    are errors, and only lines of a wrong form have a reason.

    Declared columns have their type, others are text. The date column of a file is null under
    its own name until ``DATE_TEXT`` is read.
    """
    # Distinct column names, not files.
    is_date = F.coalesce(F.col("name") == F.col("date_name"), F.lit(False)).alias("is_date")
    named = staged.files.select(F.explode("names").alias("name"), "date_name").select("name", is_date)
    pairs = named.agg(F.sort_array(F.collect_set(F.struct("name", "is_date"))).alias("pairs")).first().pairs
    if not pairs:
        return None
    columns = output_columns([(p.name, p.is_date) for p in pairs], schema)
    declared = {f.name.lower(): f.dataType for f in schema.fields if f.name not in DATE_COLUMNS}

    keys = F.transform(
        "names", lambda n: F.when(n.isin(*DATE_COLUMNS), n).otherwise(F.lower(n))
    )

    def slot(column: Named) -> Column:
        at = F.array_position(keys, column.spelling) - 1
        role = F.coalesce(F.col("date_name") == column.spelling, F.lit(False)) == column.as_date
        return F.when((at >= 0) & role, at).cast("int")

    files = staged.files.select(
        F.col("uri").alias("_uri"), "utf8", "head", "width", "date_name",
        plain_path(F.col("name")).alias("source"),
        *(slot(c).alias(f"slot_{i}") for i, c in enumerate(columns)),
        (F.array_position("names", F.col("date_name")) - 1).cast("int").alias("date_slot"),
        *([_expected_header(schema).alias("expected")] if encoding else []),
    )
    utf8 = F.col("utf8")

    def decoded(cell: Column) -> Column:
        foreign = F.octet_length(cell) != F.char_length(cell)
        if encoding and encoding.upper() not in ("UTF-8", "ISO-8859-1"):
            return F.when(foreign, _apart(cell, lambda c: _from_latin(c, encoding))).otherwise(cell)
        return F.when(utf8 & foreign, _apart(cell, lambda c: _from_latin(c, "UTF-8"))).otherwise(cell)

    def present(cell: Column) -> Column:
        return F.when(~cell.isin(*null_markers), cell)

    # Three steps, so that no step's code grows too long to be compiled: pick the cells, decode
    # the texts, type the numbers. Each uses the step before several times, which keeps the
    # optimizer from joining them. Cells are picked one by one: where only some columns are asked
    # for, the others are left.
    texts, values, reasons = {}, {}, []
    for i, column in enumerate(columns):
        kind = declared.get(column.name.lower(), StringType())
        cell = F.col(f"__picked_{i}")
        if column.as_date:
            values[column.name] = F.lit(None).cast("timestamp")
            continue
        if isinstance(kind, StringType):
            texts[f"__cell_{i}"] = decoded(cell)
            values[column.name] = F.col(f"__cell_{i}")
            continue
        texts[f"__cell_{i}"] = F.trim(cell)
        value, reason = typed(F.col(f"__cell_{i}"), kind, column.name)
        values[column.name] = or_fail(value, reason, F.col("source")) if strict else value
        reasons += [] if strict else [reason]
    n = F.size("cells")
    # The header is no data line; its cells must not be judged, in whichever order filters run.
    data = F.col("at").isNull() | (F.col("at") != F.col("head"))
    problem = F.coalesce(
        F.when(
            F.col("open") | F.col("odd") & (n != F.col("width")),
            F.lit("quoted line break, read with multiline=True"),
        ),
        F.when(n > F.col("width"), F.lit("too many cells")),
        *reasons,
    )
    checked = staged.lines.join(files, F.col("uri") == F.col("_uri")).filter(data)
    if encoding:
        checked = checked.filter("expected")
    picked = [present(F.get("cells", F.col(f"slot_{i}"))).alias(f"__picked_{i}") for i in range(len(columns))]
    date = present(F.get("cells", F.col("date_slot"))).alias("__picked_date")
    facts = ["uri", "source", "utf8", "width", "open", "odd", "cells", "date_name"]
    cells = checked.select(*facts, data.alias("data"), *picked, date).select(
        *facts,
        "data",
        *(cell.alias(name) for name, cell in texts.items()),
        decoded(F.col("__picked_date")).alias("__date_cell"),
    )
    refused = F.when(F.col("data"), problem)
    return cells.select(
        *(value.alias(name) for name, value in values.items()),
        F.struct(F.col("uri").alias("file_path"), F.col("source").alias("plain_name")).alias("_metadata"),
        refused.alias(REASON),
        # Shown for refused lines only.
        F.when(refused.isNotNull(), decoded(F.array_join("cells", ",", ""))).alias(LINE),
        F.col("__date_cell").alias(DATE_TEXT),
        F.lit(None).cast("timestamp").alias(DATE_MOMENT),
        F.col("date_name").alias(DATE_NAME),
    )


def _expected_header(schema: StructType) -> Column:
    """True, or an error for a header that is not the declared one."""
    wanted = [name.lower() for name in schema.names]
    found = F.transform("names", F.lower)
    problem = F.concat(F.lit("header is not the declared one: "), F.array_join("names", ","))
    return F.when(found == F.array(*map(F.lit, wanted)), True).otherwise(F.raise_error(problem).cast("boolean"))
