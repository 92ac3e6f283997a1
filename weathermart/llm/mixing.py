"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are added up by membership
pattern, so the flow network has one node per pattern and one per source, however
many documents there are. Flow runs from source quotas through patterns; each repeat
of a pattern costs more than the one before (convex), so the flow repeats as little
as the quotas allow. What a pattern has to give is then taken from its documents in
seeded order: whole passes first, the rest from the lowest draws.

Only pattern totals (at most ``max_patterns`` rows, checked) reach the driver.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weathermart.llm.common import text_or_empty, unused, utf8_crc32, words
from weathermart.sources.paths import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2
MAX_PATTERNS = 10_000
SEED = 20_240_601
# Draws are cut into this many ranges, twice: what is left to sort is a millionth of a pattern.
RANGES = 1024

Source = str | None


def source_order(source: Source) -> tuple[bool, str]:
    """By code point, null last (UTF-8 text sorts by code point in Python)."""
    return (source is None, source or "")


def targets(
    sizes: Mapping[Source, int],
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = MAX_REPEATS,
    total: int | None = None,
) -> dict[Source, float]:
    """Target of each source: by weight, at most ``cap`` times its size, excess reshared."""
    names = sorted(sizes, key=source_order)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal = share * (sum(sizes.values()) if total is None else total)
    out: dict[Source, float] = {}
    open_ = list(names)
    while open_:
        unit = (goal - sum(out.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > cap * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        out |= {s: float(cap * sizes[s]) for s in over}
        open_ = [s for s in open_ if s not in out]
    return out


def whole_quotas(wanted: Mapping[Source, float]) -> dict[Source, int]:
    """Targets as whole words with the same sum; the largest remainders are rounded up."""
    quota = {s: int(t) for s, t in wanted.items()}
    rest = round(sum(wanted.values())) - sum(quota.values())
    order = sorted(wanted, key=lambda s: (quota[s] - wanted[s], source_order(s)))
    for s in order[: max(0, rest)]:
        quota[s] += 1
    return quota


def route(
    patterns: Mapping[tuple, int], quota: Mapping[Source, int], max_repeats: int = MAX_REPEATS
) -> dict[tuple, int]:
    """Words to take from each pattern: a cheapest flow among those that meet most of the quotas.

    ``patterns`` gives the size of each tuple of sources. The k-th pass over a pattern
    costs k - 1 a word. Successive shortest paths over source -> pattern arcs; sources
    that share no document fall apart into components and need one step each.
    """
    taken = dict.fromkeys(patterns, 0)
    sent: dict[tuple[Source, tuple], int] = defaultdict(int)
    members: dict[Source, list[tuple]] = defaultdict(list)
    for p in patterns:
        for s in p:
            members[s].append(p)

    def step_cost(p: tuple) -> int | None:
        """Cost of one more word from ``p``; None if every pass is used up."""
        passes = taken[p] // patterns[p] if patterns[p] else max_repeats
        return passes if passes < max_repeats else None

    for start in sorted(quota, key=source_order):
        left = quota[start]
        while left > 0:
            # Cheapest way from this source to a pattern with room, also by handing
            # words that another source takes from a shared pattern back to it.
            cost: dict[Source, int] = {start: 0}
            came: dict[Source, tuple[Source, tuple]] = {}
            queue = deque([start])
            best: tuple | None = None
            while queue:
                s = queue.popleft()
                for p in members[s]:
                    price = step_cost(p)
                    if price is not None and (best is None or cost[s] + price < best[0]):
                        best = (cost[s] + price, s, p)
                    for other in p:
                        if other != s and sent[other, p] > 0 and other not in cost:
                            cost[other] = cost[s]
                            came[other] = (s, p)
                            queue.append(other)
            if best is None:
                break
            _, s, p = best
            amount = min(left, patterns[p] - taken[p] % patterns[p])
            way = []
            at = s
            while at != start:
                before, shared = came[at]
                way.append((before, at, shared))
                amount = min(amount, sent[at, shared])
                at = before
            taken[p] += amount
            sent[s, p] += amount
            for before, at, shared in way:
                sent[at, shared] -= amount
                sent[before, shared] += amount
            left -= amount
    return taken


def _add_up(rows: DataFrame, max_patterns: int) -> dict[str, int]:
    """Words of each pattern. More patterns than the network may have are an error."""
    found = (
        rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    )
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; raise max_patterns")
    return {r.pattern: r.size for r in found}


def _cut(rows: DataFrame, plan: DataFrame, low: Column, name: str) -> DataFrame:
    """For each pattern, the range of draws in which its remainder ends, and what is left there.

    A window over at most RANGES totals a pattern, never over documents.
    """
    so_far = Window.partitionBy("pattern").orderBy(name)
    before = F.coalesce(
        F.sum("range_size").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    totals = rows.groupBy("pattern", low.alias(name)).agg(F.sum("size").alias("range_size"))
    return (
        totals.withColumn("before", before)
        .join(F.broadcast(plan), "pattern")
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("range_size")))
        .select("pattern", name, (F.col("rest") - F.col("before")).alias("rest"))
    )


def mix(
    docs: DataFrame,
    sources: Column,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    max_patterns: int = MAX_PATTERNS,
) -> tuple[DataFrame, dict[Source, tuple[int, float]]]:
    """How many words the mix takes from every row of ``docs`` (doc_id, text).

    ``sources`` is the array of sources a row belongs to (null members are a source).
    Returns the rows (doc_id, text_crc32, size, pattern, taken) and, for each source,
    its size and target. Targets follow ``targets``. A row gives at most
    ``max_repeats`` times its size; only the row at a pattern's cut gives a part pass.

    Null and blank texts have size 0 and give nothing. A null or empty source array is
    the pattern of no source and gives nothing. Repeated rows are each a row of their
    own; which of them gives a part pass is not told apart. An empty table gives no
    rows. Other columns of ``docs`` are ignored, whatever their names.
    """
    text = F.col("text")
    drawn = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text_or_empty(text))
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            utf8_crc32(text).alias("text_crc32"),
            F.size(words(text)).cast("long").alias("size"),
            # Null fields survive in arrays, so a null source stays a member.
            F.to_json(F.array_sort(F.array_distinct(F.coalesce(sources, F.array())))).alias("pattern"),
            F.pmod(drawn, F.lit(RANGES)).cast("int").alias("coarse"),
            F.pmod(F.shiftright(drawn, 20), F.lit(RANGES)).cast("int").alias("fine"),
            drawn.alias("drawn"),
        ),
        "sizes",
    )
    spark = docs.sparkSession
    totals = _add_up(rows, max_patterns)
    names = {tuple(json.loads(p)): p for p in totals}
    found = {members: totals[p] for members, p in names.items()}
    sizes: dict[Source, int] = defaultdict(int)
    for p, n in found.items():
        for s in p:
            sizes[s] += n
    wanted = targets(sizes, weights, share, max_repeats, total=sum(found.values()))
    taken = route(found, whole_quotas(wanted), max_repeats)
    plan = spark.createDataFrame(
        [
            (names[p], taken[p] // n if n else 0, taken[p] % n if n else 0)
            for p, n in found.items()
        ],
        "pattern string, passes long, rest long",
    )
    coarse = materialize(_cut(rows, plan.select("pattern", "rest"), F.col("coarse"), "cut"), "coarse")
    edge = rows.join(F.broadcast(coarse.select("pattern", "cut")), "pattern").where("coarse = cut")
    fine = materialize(_cut(edge, coarse.select("pattern", "rest"), F.col("fine"), "cut_fine"), "fine")
    cuts = coarse.select("pattern", "cut").join(
        fine.select("pattern", "cut_fine", F.col("rest").alias("at_edge")), "pattern"
    )
    placed = rows.join(F.broadcast(plan.select("pattern", "passes")), "pattern").join(
        F.broadcast(cuts), "pattern", "left"
    )
    at_edge = (F.col("coarse") == F.col("cut")) & (F.col("fine") == F.col("cut_fine"))
    below = (F.col("coarse") < F.col("cut")) | (
        (F.col("coarse") == F.col("cut")) & (F.col("fine") < F.col("cut_fine"))
    )
    in_order = (
        Window.partitionBy("pattern")
        .orderBy("drawn", "doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = placed.where(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "part", F.when(F.coalesce(below, F.lit(False)), F.col("size")).otherwise(0)
    )
    edge_rows = placed.where(at_edge).withColumn(
        "part",
        F.greatest(
            F.lit(0),
            F.least(
                F.col("size"),
                F.col("at_edge") - F.coalesce(F.sum("size").over(in_order), F.lit(0)),
            ),
        ),
    )
    given = (F.col("passes") * F.col("size") + F.col("part")).cast("long")
    out = ["doc_id", "text_crc32", "size", "pattern", given.alias("taken")]
    facts = {s: (sizes[s], wanted[s]) for s in sizes}
    return inner.select(*out).unionAll(edge_rows.select(*out)), facts



def repeat_documents(docs: DataFrame, sources: Column, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    A part pass is rounded to none or one, so documents stay whole; that concerns one
    document of each pattern. Documents that the mix does not take are left out.
    """
    mixed, _ = mix(docs, sources, **options)
    names = {k: unused(docs.columns, k) for k in ("_id", "_crc", "_times", "_hash", "_one")}
    # Rows with equal id and text are interchangeable: each gets an equal share of what they give.
    times = (
        mixed.where("size > 0")
        .groupBy("doc_id", "text_crc32", "pattern")
        .agg((F.sum("taken") / F.sum("size")).alias("times"))
        .groupBy("doc_id", "text_crc32")
        .agg(F.max("times").alias("times"))
        .toDF(names["_id"], names["_crc"], names["_times"])
    )
    return (
        docs.withColumn(names["_hash"], utf8_crc32(F.col("text")))
        .join(
            times,
            F.col("doc_id").cast("long").eqNullSafe(F.col(names["_id"]))
            & (F.col(names["_hash"]) == F.col(names["_crc"])),
        )
        .withColumn(
            names["_one"], F.explode(F.sequence(F.lit(0), F.round(names["_times"]).cast("int")))
        )
        .where(F.col(names["_one"]) > 0)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
