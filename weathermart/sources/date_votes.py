"""Date layouts by vote: each upload's own values decide how its dates are read.

A text like ``01/02/2011`` can be read in several layouts; the other values of the same file tell
which is meant. Values are counted per file with their clock times blanked, so a file adds about
one row per day. Layouts are ranked by the number of values they read (equal ones: as
listed), and a value is read by the first layout of its file that can read it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.functions.temporal import iso_timestamp
from weathermart.sources.paths import materialize

ISO = "ISO"


_NUMBERS, _NAME = r"[+\-\d]{1,40}", r"\D{1,40}"


def _shape(format: str) -> str | None:
    """A pattern that every text in a layout of plain date and time letters has; ``None`` for others."""
    out = []
    for part in re.findall(r"[A-Za-z]+|.", format, re.DOTALL):
        if part in ("[", "]"):
            out.append("(?:" if part == "[" else ")?")
        elif part == "a" or re.fullmatch("MMM+", part):
            out.append(_NAME)
        elif re.fullmatch("[yMdHhms]+", part):
            out.append(_NUMBERS)
        elif part.isalpha() or part in "'{}#":
            return None
        else:
            out.append(re.escape(part))
    return f"^{''.join(out)}$"


def _sifted(text: Column, formats: Sequence[str]) -> list[Column]:
    """``_readings``, with no parser tried on a text that lacks the layout's shape: a parser that
    fails costs some ten times what a match does, and of all layouts most fail."""
    tried = [
        reading if shape is None else F.when(text.rlike(shape), reading)
        for reading, shape in zip(_readings(text, formats)[1:], map(_shape, formats), strict=True)
    ]
    return [iso_timestamp(text), *tried]


def _readings(text: Column, formats: Sequence[str]) -> list[Column]:
    return [iso_timestamp(text), *(F.try_to_timestamp(text, F.lit(f)) for f in formats)]


def _without_clock(text: Column) -> Column:
    """The text with all digits of a clock time at its end as ones, so that days count, not minutes."""
    clock = F.substring_index(text, " ", -1)
    ones = F.translate(clock, "0123456789", "1" * 10)
    return F.when(F.instr(clock, ":") > 0, F.concat(F.substring(text, F.lit(1), F.length(text) - F.length(clock)), ones)).otherwise(text)


def vote(texts: DataFrame, formats: Sequence[str]) -> DataFrame:
    """Votes of ``(uri, text)`` rows, one row per file, written to scratch.

    ``ranks`` has the rank of ISO and of each format, null for those that read nothing;
    ``best`` is the winner's place and ``layout`` its text. ``dates`` counts texts, ``exceptions`` those that only another
    layout reads, ``unreadable`` those that none reads, and ``ambiguous`` those that a layout
    with as many votes reads as another day.
    """
    names = F.array(*map(F.lit, [ISO, *formats]))
    counted = (
        texts.filter(F.col("text").isNotNull())
        .groupBy("uri", _without_clock(F.col("text")).alias("text"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    read = materialize(
        counted.select("uri", "n", F.array(*_sifted(F.col("text"), formats)).alias("read")), "date_texts"
    )
    sums = [
        F.coalesce(F.sum(F.when(F.get("read", F.lit(i)).isNotNull(), F.col("n"))), F.lit(0))
        for i in range(len(formats) + 1)
    ]
    ranks = F.transform(
        "votes",
        lambda n, i: F.when(
            n > 0,
            F.size(
                F.filter(
                    F.transform("votes", lambda m, j: (m > n) | ((m == n) & (j < i))), lambda before: before
                )
            ),
        ),
    )
    ranked = read.groupBy("uri").agg(F.array(*sums).alias("votes")).withColumn("ranks", ranks)
    best = (F.array_position("ranks", F.lit(0)) - 1).cast("int")
    first = F.get("read", F.col("best"))
    equal = F.get("votes", F.col("best"))
    rival = F.exists(
        F.transform("read", lambda t, i: (F.get("votes", i) == equal) & (t != first)),
        lambda other: F.coalesce(other, F.lit(False)),
    )
    any_read = F.exists("read", lambda t: t.isNotNull())

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    report = (
        read.join(ranked.withColumn("best", F.when(F.size(F.array_compact("ranks")) > 0, best)), "uri")
        .groupBy("uri", "ranks", "best")
        .agg(
            F.sum("n").alias("dates"),
            total(first.isNull() & any_read).alias("exceptions"),
            total(rival).alias("ambiguous"),
            total(~any_read).alias("unreadable"),
        )
    )
    return materialize(report.withColumn("layout", F.get(names, F.col("best"))), "date_votes")


def read_as_voted(text: Column, formats: Sequence[str]) -> Column:
    """The moment that the best-ranked layout reads, by the ``ranks``, ``best`` and ``exceptions``
    of the text's file. Where the best one reads all that can be read, no other is tried.
    """
    readings = _readings(text, formats)
    alone = reduce(
        lambda case, i: case.when(F.col("best") == i, readings[i]),
        range(1, len(readings)),
        F.when(F.col("best") == 0, readings[0]),
    )
    rank = [F.get("ranks", F.lit(i)) for i in range(len(readings))]
    options = [
        F.struct(r.alias("rank"), F.when(r.isNotNull(), reading).alias("moment"))
        for r, reading in zip(rank, readings)
    ]
    found = F.array_min(F.filter(F.array(*options), lambda o: o["moment"].isNotNull()))
    return F.when(F.col("exceptions") > 0, found["moment"]).otherwise(alone)
