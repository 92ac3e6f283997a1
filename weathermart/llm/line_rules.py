"""Quality rules: cross-document line frequency, with the usual per-text counts.

Lines are normalised and hashed. For every host the distinct texts that hold a line
are counted; lines above the limit are boilerplate and are removed; documents of
which too little is left are rejected. Exact copies of a text count once, so being
copied does not turn the lines of a good document into boilerplate.

Everything is built-in expressions: per-text counts stay in the scan, and only line
hashes (never texts) are shuffled to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.llm.common import text_or_empty, unused, words
from weathermart.sources.paths import materialize


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate above ``min_texts`` texts and ``share`` of the host's texts."""

    min_texts: int = 10
    share: float = 0.01
    # A document is depleted if boilerplate held more than this share of its words.
    max_removed: float = 0.5
    min_words: int = 50
    max_repeated: int = 50  # per cent of words in repeated three-word windows


LIMITS = Limits()
WINDOW = 3


def lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def normalised(line: Column) -> Column:
    """Letter case, outer blanks and the digits of numbers do not tell lines apart."""
    return F.regexp_replace(F.lower(F.btrim(line, F.lit(" \t\n\x0b\f\r"))), "[0-9]+", "0")


def _word_count(line: Column) -> Column:
    return F.size(words(line))


def _with_counts(docs: DataFrame) -> DataFrame:
    """The per-text counts. Steps are separate columns so that none is computed twice."""
    w, g = F.col("_words"), F.col("_windows")
    out = docs.withColumn("_words", words(F.col("text"))).withColumn(
        "_lines", F.filter(lines(F.col("text")), has_word)
    )
    # Hash of each three-word window, by position.
    out = out.withColumn(
        "_windows",
        F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Sorted with their positions, but only where some window occurs twice.
    out = out.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct(g)) < F.size(g),
            F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("_sorted")
    out = out.withColumn(
        "_repeats",
        F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, k: F.coalesce(
                        (x["h"] == F.get(s, k + 1)["h"]) | ((k > 0) & (x["h"] == F.get(s, k - 1)["h"])),
                        (k > 0) & (x["h"] == F.get(s, F.greatest(k - 1, F.lit(0)))["h"]),
                    ),
                ),
                lambda x: x["i"],
            )
        ),
    )
    r = F.col("_repeats")
    # Windows of three words that start at these positions cover so many words.
    covered = F.aggregate(
        F.transform(
            r, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(r, k + 1), at + WINDOW) - at)
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(text_or_empty(F.col("text")), F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    )


def text_facts(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counts, rule outcome and hashed lines of every row; a small table beside the texts."""
    counted = _with_counts(docs.select("doc_id", "text", F.col("source").alias("host")))
    short = F.col("n_words") < limits.min_words
    repeated = 100 * F.col("n_repeat_words") > limits.max_repeated * F.col("n_words")
    return counted.select(
        "doc_id",
        "host",
        F.xxhash64(text_or_empty(F.col("text"))).alias("text_hash"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (short | repeated).alias("base_failed"),
        F.transform(
            "_lines",
            lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), _word_count(x).alias("n")),
        ).alias("lines"),
    )


def frequent_lines(facts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """host and line of boilerplate: lines in more texts of the host than the limit allows.

    Counts are added up inside each task before the shuffle, so a line that every
    document has, or a host with a third of all rows, is no burden to one task.
    """
    each = facts.select("host", "text_hash", F.explode("lines.line").alias("line")).distinct()
    texts = (
        facts.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    )
    counts = (
        each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > limits.min_texts)
    )
    t = texts.select(F.col("host").alias("_host"), "texts")
    return (
        counts.join(t, F.col("host").eqNullSafe(F.col("_host")))
        .where(F.col("n") > limits.share * F.col("texts"))
        .select("host", "line")
    )


def _removed_words(facts: DataFrame, frequent: DataFrame) -> DataFrame:
    """Words in boilerplate lines, for every (host, text) that has such a line."""
    f = frequent.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    each = (
        facts.select("host", "text_hash", "lines")
        .dropDuplicates(["host", "text_hash"])
        .select("host", "text_hash", F.inline("lines"))
    )
    return (
        each.join(f, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")))
        .groupBy("host", "text_hash")
        .agg(F.sum("n").alias("words_removed"), F.collect_set("line").alias("removed_lines"))
    )


def judge(facts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """``facts`` with words_removed, removed_lines (hashes) and the verdict ``kept``.

    ``facts`` should be a written table, since it is read several times.
    """
    removed = _removed_words(facts, frequent_lines(facts, limits)).select(
        F.col("host").alias("_host"), F.col("text_hash").alias("_hash"), "words_removed", "removed_lines"
    )
    joined = facts.join(
        removed,
        F.col("host").eqNullSafe(F.col("_host")) & (F.col("text_hash") == F.col("_hash")),
        "left",
    ).drop("_host", "_hash")
    gone = F.coalesce(F.col("words_removed"), F.lit(0))
    depleted = gone > limits.max_removed * F.col("n_words")
    return joined.withColumns(
        {"words_removed": gone.cast("long"), "kept": ~F.col("base_failed") & ~depleted}
    )


def line_rules(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counts and verdict for every row of ``docs`` (doc_id, text, source).

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, words_removed, host, text_hash, removed_lines. A null text has
    no words and fails the base rule. A null source is a host of its own. Repeated
    rows get the same verdict. An empty table gives no rows. Other columns of ``docs``
    are ignored, whatever their names.
    """
    return judge(materialize(text_facts(docs, limits), "facts"), limits)


def filter_documents(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, boilerplate lines removed from texts.

    Texts without a boilerplate line come back unchanged.
    """
    verdict = line_rules(docs, limits).where("kept")
    names = {k: unused(docs.columns, k) for k in ("_k_host", "_k_hash", "_k_lines", "_hash")}
    # One row per host and text: copies share their verdict, so none is multiplied.
    verdict = verdict.groupBy("host", "text_hash").agg(F.first("removed_lines").alias("lines"))
    verdict = verdict.toDF(names["_k_host"], names["_k_hash"], names["_k_lines"])
    gone = F.col(names["_k_lines"])
    cleaned = F.array_join(
        F.filter(
            lines(F.col("text")),
            lambda x: ~(has_word(x) & F.array_contains(gone, F.xxhash64(normalised(x)))),
        ),
        "\n",
    )
    return (
        docs.withColumn(names["_hash"], F.xxhash64(text_or_empty(F.col("text"))))
        .join(
            verdict,
            F.col("source").eqNullSafe(F.col(names["_k_host"]))
            & (F.col(names["_hash"]) == F.col(names["_k_hash"])),
        )
        .withColumn("text", F.when(gone.isNull(), F.col("text")).otherwise(cleaned))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
