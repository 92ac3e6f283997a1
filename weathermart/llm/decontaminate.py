"""Benchmark decontamination by spaced seeds.

Fixed masks select some of the token positions in a short span and ignore the rest.
The selected tokens are hashed at every position of documents and benchmark items;
equal hashes are hits, also where an ignored token was substituted. Around each hit
the two texts are laid side by side and a window with few enough substitutions is
asked for.

Document positions are not shuffled: a small filter of the benchmark's hashes (of
fixed size, whatever the benchmark's) rejects nearly all of them in the scan, and
only what passes is joined, with its surroundings, to the benchmark. The filter only
saves work: it has no false negatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.llm.common import key_filter, may_hold, text_or_empty, unused

# Token offsets that each mask selects. Together they hit every window of 13 tokens
# with at most two substitutions, of 16 with at most three, and of 10 with at most
# one (tests/llm count it).
MASKS = ((0, 3, 4, 5, 6, 7), (0, 1, 2, 3, 7, 9), (0, 1, 2, 4, 5, 6))
WINDOW = 13
# Scripts that write no spaces between words.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
MAX_SUBSTITUTIONS = 2
# Shorter items hold no seed; they are searched as whole token sequences. Those of fewer than
# MIN_PHRASE tokens can't be told from common phrases: they count where they are a whole line.
MIN_ITEM = max(m[-1] for m in MASKS) + 1
MIN_PHRASE = 5
_TOKENS_AROUND = WINDOW - 1


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; case and punctuation don't count.

    In scripts without spaces every character is a token.
    """
    plain = F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+", " ")
    # Few texts need this, and a text of two-byte characters at most can't.
    wide = F.octet_length(plain) > F.char_length(plain)
    plain = F.when(wide, F.regexp_replace(plain, f"([{UNSPACED}])", " $1 ")).otherwise(plain)
    return F.array_remove(F.split(plain, " "), "")


def _token_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _with_seeds(texts: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each position and mask: keys, _words, _at and seed.

    Masks are rows and not columns, and the seed comes out of a generator: one short
    expression, evaluated once, that the compiled stage can keep small.
    """
    n, k = F.size("_words"), len(MASKS)
    last = [m[-1] for m in MASKS]
    steps = F.when(n >= MIN_ITEM, F.sequence(F.lit(0), n * k - 1))
    mask, at = F.col("_step") % k, F.floor(F.col("_step") / k).cast("int")

    def offset(of: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, of)), mask)

    picked = [F.get("_hashes", at + offset([m[i] for m in MASKS])) for i in range(len(MASKS[0]))]
    reaches = at + offset(last) < n
    return (
        texts.withColumn("_hashes", _token_hashes(F.col("_words")))
        .select(*keys, "_words", "_hashes", F.explode(steps).alias("_step"))
        .select(
            *keys,
            "_words",
            at.alias("_at"),
            F.explode(F.array(F.when(reaches, F.xxhash64(mask, *picked)))).alias("seed"),
        )
    )


def _around(words: Column, at: Column) -> tuple[Column, Column]:
    """The tokens near a hit and the place of the first of them in the text."""
    first = F.greatest(F.lit(0), at - _TOKENS_AROUND)
    return F.slice(words, first + 1, at - first + MIN_ITEM + _TOKENS_AROUND), first


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """Seed hashes of the items, each with the tokens around it.

    The same surroundings in several items are kept once per item; items are few
    beside documents, and a hash that many share is settled by its surroundings.
    """
    near, first = _around(F.col("_words"), F.col("_at"))
    items = benchmark.select("item_id", tokens(F.col("text")).alias("_words")).distinct()
    return (
        _with_seeds(items, ["item_id"])
        .where(F.col("seed").isNotNull())
        .select(
            "item_id",
            near.alias("item_near"),
            (F.col("_at") - first).alias("item_hit"),
            F.size("_words").alias("item_size"),
            "seed",
        )
        .distinct()
    )


def seed_hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Positions of ``docs`` (keys, text) whose seeds the benchmark may have, with surroundings."""
    keys = [c for c in docs.columns if c != "text"]
    near, first = _around(F.col("_words"), F.col("_at"))
    texts = docs.select(*keys, tokens(F.col("text")).alias("_words"))
    return (
        _with_seeds(texts, keys)
        .where(may_hold(F.col("seed"), key_filter(seeds, "seed")))
        .select(*keys, "_at", near.alias("near"), (F.col("_at") - first).alias("hit"), "seed")
    )


def _best_window(near: Column, hit: Column, item_near: Column, item_hit: Column, size: Column) -> Column:
    """Most equal tokens in a window of the two texts laid side by side at a hit."""
    back = F.least(hit, item_hit)
    length = back + F.least(F.size(near) - hit, F.size(item_near) - item_hit)
    a, b = hit - back, item_hit - back
    width = F.least(F.lit(WINDOW), size)
    equal = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.when(F.get(near, a + i) == F.get(item_near, b + i), 1).otherwise(0),
    )
    sums = F.transform(
        F.sequence(F.lit(0), length - width),
        lambda i: F.aggregate(F.slice(equal, i + 1, width), F.lit(0), lambda t, x: t + x),
    )
    return F.when(length >= width, F.array_max(sums)).otherwise(0)


def short_items(benchmark: DataFrame) -> DataFrame:
    """Items without a seed: item_id, their tokens, number of tokens and hash of them all."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("item")).distinct()
    size = F.size("item")
    return items.where((size > 0) & (size < MIN_ITEM)).select(
        "item_id", "item", size.alias("item_size"), F.xxhash64("item").alias("seed")
    )


def short_overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Where whole short items stand in ``docs``: keys, item_id and token position, exactly.

    Token sequences of the lengths that items have are hashed at every position (lines, for the
    shortest items) and meet the items behind a filter of fixed size.
    """
    keys = [c for c in docs.columns if c != "text"]
    # At most MIN_ITEM - 1 lengths.
    lengths = sorted(r.item_size for r in items.select("item_size").distinct().collect())
    phrases = [n for n in lengths if n >= MIN_PHRASE]
    parts = []
    if phrases:
        words = docs.select(*keys, tokens(F.col("text")).alias("_words"))
        spots = words.select(*keys, "_words", F.explode(F.sequence(F.lit(0), F.size("_words") - min(phrases))).alias("_at")).where(
            F.size("_words") >= min(phrases)
        )
        parts.append(
            spots.select(
                *keys, "_at", "_words", F.explode(F.array(*map(F.lit, phrases))).alias("_n")
            )
            .where(F.col("_at") + F.col("_n") <= F.size("_words"))
            .select(*keys, "_at", F.slice("_words", F.col("_at") + 1, F.col("_n")).alias("_run"))
        )
    if len(phrases) < len(lengths):
        lines = docs.select(*keys, F.posexplode(F.split(text_or_empty(F.col("text")), "\n")).alias("_at", "_line"))
        parts.append(lines.select(*keys, "_at", tokens(F.col("_line")).alias("_run")).where(F.size("_run") < MIN_PHRASE))
    found = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    return (
        found.withColumn("seed", F.xxhash64("_run"))
        .where(may_hold(F.col("seed"), key_filter(items, "seed")))
        .join(items, "seed")
        .where(F.col("_run") == F.col("item"))
        .select(*keys, "item_id", "_at", F.col("item_size").alias("matched"))
    )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a passage of an item: one row for each document and item.

    ``docs`` has text and any key columns, which come first in the result; then
    item_id, start (token at which the first hit lies), hits (verified hits) and
    matched (most equal tokens in a window of 13, or of the whole item if that is
    shorter). A window may have two substitutions, an item of 10 to 12 tokens one, a shorter
    one none; an item of fewer than five tokens must be a line of its own (``start`` is the
    line's number then). Null texts and items have no hits. Repeated rows with the same key are
    one document. Empty tables give no rows.
    """
    keys = [c for c in docs.columns if c != "text"]
    seeds = benchmark_seeds(benchmark)
    found = seed_hits(docs, seeds).join(seeds, "seed")
    best = _best_window(
        F.col("near"), F.col("hit"), F.col("item_near"), F.col("item_hit"), F.col("item_size")
    )
    size = F.col("item_size")
    needed = F.when(size >= WINDOW, F.lit(WINDOW - MAX_SUBSTITUTIONS)).otherwise(size - 1)
    long = (
        found.select(*keys, "item_id", "_at", best.alias("matched"), needed.alias("_needed"))
        .where(F.col("matched") >= F.col("_needed"))
        .drop("_needed")
    )
    items = short_items(benchmark)
    every = long if items.isEmpty() else long.unionAll(short_overlaps(docs, items))
    return every.groupBy(*keys, "item_id").agg(
        F.min("_at").alias("start"),
        F.countDistinct("_at").alias("hits"),
        F.max("matched").alias("matched"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``overlaps`` of ``docs`` (doc_id, text) by doc_id; other columns are ignored."""
    return overlaps(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)


def filter_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns."""
    key = unused(docs.columns, "_text_hash")
    found = (
        overlaps(docs.select(F.xxhash64(text_or_empty(F.col("text"))).alias(key), "text"), benchmark)
        .select(key)
        .distinct()
    )
    return docs.withColumn(key, F.xxhash64(text_or_empty(F.col("text")))).join(found, key, "left_anti").drop(key)
