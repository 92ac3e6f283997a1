"""Exact Jaccard join of documents on word shingles, by token-combination prefixes.

A document is the set of its five-word shingles ("tokens" here). Tokens are put in one
global order: rare classes first, frequent ones last. If two sets are similar, few
tokens of either are missing in the other, so a prefix of each is enough to meet in.
Rare tokens are indexed one by one. Frequent ones are dealt to groups, and within a
group combinations of two or three are indexed; since a group of g tokens can miss
k - 1 of them without sharing a combination of k, the prefix is extended until

    sum over groups of max(0, tokens in prefix - (k - 1)) >= tokens that may differ + 1.

Then some group shares at least k tokens, whatever the two sets. Order and classes may
be any function of the token, so they need not be exact for the result to be.

Sets that are equal are one node. Sets that share an index entry are compared with the
smallest of them first, then with leaders of the lists that these links do not join
yet, turn by turn; what still stays apart is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.llm.common import (
    WordHashes,
    as_long,
    key_filter,
    lower_words,
    may_hold,
    shingles,
    slices,
    stir,
    text_or_empty,
    unused,
)
from weathermart.llm.components import components
from weathermart.sources.paths import distilled, materialize

SHINGLE = 5
PERCENT = 80
# Slots of the class table that every task gets: 4 MB, fixed.
CLASS_SLOTS = 1 << 22
# From so many texts on a token counts as frequent; its combinations have two or three tokens.
FREQUENT, VERY_FREQUENT = 16, 4096
# Tokens of a partition whose counts are added up at once.
_COUNTED = 2_000_000


def token_set(data: bytes | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; the whole sequence as one if it is shorter."""
    return np.unique(shingles(words.of(lower_words(data)), SHINGLE))


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def bit_sketch(tokens: np.ndarray) -> bytes:
    """One bit per token in a table of about twice as many bits (a power of two)."""
    width = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


# Longs of the small sketch that candidate pairs are met with: 1,024 bits.
BIT_LONGS = 16


def small_sketch(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * BIT_LONGS, np.uint8)
    bits[(tokens % np.uint64(64 * BIT_LONGS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _folded(sketch: bytes, width: int) -> np.ndarray:
    bits = np.frombuffer(sketch, np.uint8)
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)


def needed_overlap(n: int, m: int, percent: int) -> int:
    """Least intersection with 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def may_be_similar(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """False only if too many tokens must differ: every bit that one side lacks is one."""
    width = min(len(a), len(b))
    x, y = _folded(a, width), _folded(b, width)
    only_x = int(np.bitwise_count(x & ~y).sum())
    only_y = int(np.bitwise_count(y & ~x).sum())
    return min(n - only_x, m - only_y) >= needed_overlap(n, m, percent)


# --- the index ----------------------------------------------------------------


def _scheme_groups(scheme: int) -> int:
    """Groups of frequent tokens for sets whose smaller one has 2**scheme tokens or more."""
    return max(1, (1 << scheme) // 16)


def entries(
    tokens: np.ndarray, classes: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set: rare tokens and combinations of frequent ones in its prefix.

    Beside each entry stands its reach: an upper bound of the intersection with a set for
    which it is the first common entry. For a token that is what stands from it on. A
    combination of frequent tokens comes first only if no rare token is common (all of
    them are in the prefix then), so it reaches over the frequent tokens.

    Groups depend on the size of the smaller set of a pair, so a set whose partners
    may be of a smaller magnitude has the combinations of both. Sets of fewer than
    eight tokens index every token alone.
    """
    n = len(tokens)
    least_size = -(-percent * n // 100)
    may_differ = n - least_size
    kinds = classes[(tokens & np.uint64(CLASS_SLOTS - 1)).astype(np.int64)]
    order = np.argsort(kinds, kind="stable")
    tokens, kinds = tokens[order], kinds[order]
    reach = n - np.arange(n)
    if kinds[may_differ] == 0:
        return tokens[: may_differ + 1], reach[: may_differ + 1]
    frequent = int((kinds > 0).sum())
    found, reaches = [], []
    for scheme in range(least_size.bit_length() - 1, n.bit_length()):
        if scheme < 3:
            found.append(tokens[: may_differ + 1])
            reaches.append(reach[: may_differ + 1])
            continue
        groups = _scheme_groups(scheme)
        dealt = ((tokens >> np.uint64(40)) % np.uint64(groups)).astype(np.int64)
        group = np.where(kinds == 0, 0, 1 + (kinds - 1) * groups + dealt)
        # How many tokens of a group are of no use before its combinations begin.
        nth = _nth_in_group(group)
        useful = np.cumsum(nth >= kinds)
        end = int(np.searchsorted(useful, may_differ + 1)) + 1
        head, kind, part = tokens[:end], kinds[:end], group[:end]
        found.append(head[kind == 0])
        reaches.append(reach[:end][kind == 0])
        salt = np.uint64(scheme)
        for g in np.unique(part[kind > 0]):
            own = np.sort(head[part == g])
            size = 2 if g <= groups else 3
            picked = np.array(list(combinations(range(len(own)), size)), np.int64).reshape(-1, size)
            mixed = np.full(len(picked), salt)
            for column in picked.T:
                mixed = stir(mixed + own[column])
            found.append(mixed)
            reaches.append(np.full(len(mixed), frequent))
    # Where schemes share an entry its position is the same.
    values, first = np.unique(np.concatenate(found), return_index=True)
    return values, np.concatenate(reaches)[first]


def _nth_in_group(group: np.ndarray) -> np.ndarray:
    """0 for the first of each group, 1 for the second, ..."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lengths = np.diff(np.r_[start, len(ordered)])
    out = np.empty(len(group), np.int64)
    out[order] = np.arange(len(group)) - np.repeat(start, lengths)
    return out


# --- passes over the texts -----------------------------------------------------


def row_key(doc_id: Column, text: Column) -> Column:
    """Rows with equal doc_id and text share it."""
    return F.xxhash64(doc_id.cast("long"), doc_id.isNull(), text_or_empty(text))


def _texts(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id"), F.col("text")
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        row_key(doc_id, text).alias("key"),
        text.cast("binary").alias("text"),
    )


def _sets_of(batch: pa.RecordBatch, words: WordHashes) -> Iterator[np.ndarray]:
    return (token_set(data, words) for data in batch.column("text").to_pylist())


_BITS = [f"bits{i}" for i in range(BIT_LONGS)]
_DIGEST = (
    "doc_id long, key long, set_id long, n long, sketch binary, token long, texts long, "
    + ", ".join(f"{b} long" for b in _BITS)
)


def _digest(docs: DataFrame) -> DataFrame:
    """Per row its set_id, size and sketch; beside them, tokens that several texts of a task have.

    A token that is frequent in the corpus is seen twice in some task; what no task
    sees twice counts as rare, which costs work at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, gathered, count = WordHashes(), set(), [], 0
        for batch in slices(batches, 500):
            ids, sizes, sketches, bits = [], [], [], []
            for tokens in _sets_of(batch, words):
                n = len(tokens)
                ids.append(set_id(tokens) if n else None)
                sizes.append(n)
                sketches.append(bit_sketch(tokens) if n else None)
                bits.append(small_sketch(tokens))
                if n and ids[-1] not in seen:
                    seen.add(ids[-1])
                    gathered.append(tokens)
                    count += n
            yield _digest_rows(batch, ids, sizes, sketches, bits)
            if count >= _COUNTED:
                yield _count_rows(gathered)
                gathered, count = [], 0
        yield _count_rows(gathered)

    return _texts(docs).mapInArrow(run, _DIGEST)


_DIGEST_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.int64()),
        ("set_id", pa.int64()),
        ("n", pa.int64()),
        ("sketch", pa.binary()),
        ("token", pa.int64()),
        ("texts", pa.int64()),
        *[(b, pa.int64()) for b in _BITS],
    ]
)


def _digest_rows(
    batch: pa.RecordBatch, ids: list, sizes: list, sketches: list, bits: list
) -> pa.RecordBatch:
    none = pa.nulls(len(ids), pa.int64())
    columns = [batch.column("doc_id"), batch.column("key")]
    columns += [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())]
    columns += [pa.array(sketches, pa.binary()), none, none]
    columns += [pa.array(b, pa.int64()) for b in np.array(bits, np.int64).reshape(-1, BIT_LONGS).T]
    return pa.RecordBatch.from_arrays(columns, schema=_DIGEST_SCHEMA)


def _count_rows(gathered: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(gathered) if gathered else np.empty(0, np.uint64)
    tokens, counts = np.unique(every, return_counts=True)
    often = counts > 1
    none = pa.nulls(int(often.sum()), pa.int64())
    columns = [none, none, none, none, pa.nulls(len(none), pa.binary())]
    columns += [pa.array(as_long(tokens[often])), pa.array(counts[often].astype(np.int64))]
    columns += [none] * BIT_LONGS
    return pa.RecordBatch.from_arrays(columns, schema=_DIGEST_SCHEMA)


def _classes(counts: DataFrame, total: int) -> np.ndarray:
    """The class of every slot of token hashes; at most CLASS_SLOTS rows reach the driver."""
    least = max(FREQUENT, total >> 24)
    often = (
        counts.groupBy("token").agg(F.sum("texts").alias("texts")).where(F.col("texts") >= least)
    )
    slot = F.col("token").bitwiseAND(F.lit(CLASS_SLOTS - 1)).cast("int")
    kind = F.when(F.col("texts") >= max(VERY_FREQUENT, 256 * least), 2).otherwise(1)
    rows = often.groupBy(slot.alias("slot")).agg(F.max(kind).alias("kind")).toArrow()
    out = np.zeros(CLASS_SLOTS, np.uint8)
    out[rows.column("slot").to_numpy()] = rows.column("kind").to_numpy()
    return out


def _index(docs: DataFrame, classes: np.ndarray, percent: int) -> DataFrame:
    """entry, set_id, n and reach, for every set once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, table = WordHashes(), set(), shared.value.astype(np.int64)
        for batch in slices(batches, 500):
            keys, reaches, ids, sizes = [], [], [], []
            for tokens in _sets_of(batch, words):
                if len(tokens) and (one := set_id(tokens)) not in seen:
                    seen.add(one)
                    values, reach = entries(tokens, table, percent)
                    keys.append(values)
                    reaches.append(reach)
                    ids.append(one)
                    sizes.append(len(tokens))
            if keys:
                times = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(np.concatenate(keys))),
                        pa.array(np.repeat(np.array(ids, np.int64), times)),
                        pa.array(np.repeat(np.array(sizes, np.int64), times)),
                        pa.array(np.concatenate(reaches).astype(np.int64)),
                    ],
                    ["entry", "set_id", "n", "reach"],
                )

    return _texts(docs).mapInArrow(run, "entry long, set_id long, n long, reach long")


def _token_table(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id and tokens of the wanted sets, read again from one text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(), set()
        for batch in slices(batches, 500):
            ids, data = [], []
            for tokens in _sets_of(batch, words):
                if len(tokens) and (one := set_id(tokens)) not in seen:
                    seen.add(one)
                    ids.append(one)
                    data.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(data, pa.binary())], ["set_id", "tokens"]
            )

    owners = sets.join(wanted, "set_id").select("doc_id")
    texts = _texts(docs)
    some = may_hold(F.xxhash64("doc_id"), key_filter(owners.select(F.xxhash64("doc_id").alias("k")), "k"))
    found = texts.where(some).mapInArrow(run, "set_id long, tokens binary")
    return found.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.first("tokens").alias("tokens"))


# --- candidates and links --------------------------------------------------------


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            columns = [batch.column(c).to_pylist() for c in ("n_a", "sketch_a", "n_b", "sketch_b")]
            keep = [may_be_similar(*row, percent) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs`` by their true intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            keep = []
            for x, y in zip(
                batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist(), strict=True
            ):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select(F.col("b").alias("set_id")))
    tokens = materialize(_token_table(docs, sets, ends.distinct()), "tokens")
    a = tokens.select(F.col("set_id").alias("a"), F.col("tokens").alias("tokens_a"))
    b = tokens.select(F.col("set_id").alias("b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _in_reach(a: str, b: str, percent: int) -> Column:
    """The reach of the entry that the two meet in does not rule a link out, if it is their first one."""
    reach = F.least(F.col(f"{a}.reach"), F.col(f"{b}.reach"))
    return (100 + percent) * reach >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _bits_fit(a: str, b: str, percent: int) -> Column:
    """Small sketches do not rule a link out."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return _bits_allow(a, b, n, n + m, percent) & _bits_allow(b, a, m, n + m, percent)


def _bits_allow(a: str, b: str, n: Column, both: Column, percent: int) -> Column:
    """Every bit that ``b`` lacks is a token of ``a`` that is not common."""
    lacking = sum(
        (F.bit_count(F.col(f"{a}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{b}.{c}")))) for c in _BITS),
        F.lit(0),
    )
    return (100 + percent) * (n - lacking) >= percent * both


# Members of a list that meet its other members in one task.
BLOCK = 1024
# Lists by which a pair that meets in many is told to have met before.
_FIRST_LISTS = 8
# A list with more members outside its largest component gets leaders before pairs are made.
_LED = 8


def _open_lists(placed: DataFrame) -> DataFrame:
    """Members of entries that links have not joined yet, once for each distinct list of members.

    Near copies share many entries; what counts is who meets whom, and the best reach.
    Lists are told apart by a hash; two that fall together are one longer list.
    """
    prints = [F.bit_xor(F.xxhash64("set_id", F.lit(seed))) for seed in (1, 2)]
    lists = (
        placed.groupBy("entry")
        .agg(
            F.xxhash64(*prints, F.count("*")).alias("list"),
            F.min("component").alias("x"),
            F.max("component").alias("y"),
        )
        .where("x < y")
        .select("entry", "list")
    )
    return (
        placed.join(lists, "entry")
        .groupBy("list", "set_id")
        .agg(*[F.max(c).alias(c) for c in ("n", "component", "reach")])
    )


def _with_largest(lists: DataFrame) -> DataFrame:
    """Lists of several components, with their size, their largest component and who is outside."""
    parts = lists.groupBy("list", "component").agg(F.count("*").alias("part"))
    known = parts.groupBy("list").agg(
        F.sum("part").alias("members"),
        F.max(F.struct("part", "component")).alias("most"),
    )
    known = known.select(
        "list", "members", F.col("most.component").alias("largest"), (F.col("members") - F.col("most.part")).alias("outside")
    )
    return lists.join(known.where("outside > 0"), "list")


def _ordered(a: str, b: str) -> list[Column]:
    x, y = F.col(f"{a}.set_id"), F.col(f"{b}.set_id")
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _led_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Two leaders of each list, one in its largest component and one outside, against other components.

    Leaders are drawn by a hash of the set, so lists with much the same members draw the
    same ones. There are at most two pairs for each row of ``lists``.
    """
    draw = F.xxhash64("set_id", F.lit(turn))
    leaders = lists.groupBy("list", (F.col("component") == F.col("largest")).alias("inside")).agg(
        F.min(F.struct(draw.alias("draw"), "set_id", "n", "component", "reach")).alias("leader")
    )
    leaders = leaders.select("list", "leader.*")
    return (
        lists.alias("a")
        .join(
            leaders.alias("b"),
            (F.col("a.list") == F.col("b.list"))
            & (F.col("a.component") != F.col("b.component"))
            & _sizes_fit("a", "b", percent)
            & _in_reach("a", "b", percent),
        )
        .select(*_ordered("a", "b"))
        .distinct()
    )


def _all_pairs(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that a list holds, each at about the first of its common lists.

    What lies outside a list's largest component meets the list, dealt to blocks of
    ``BLOCK`` members. A pair is left to an earlier list if both sets have that one among
    the first of theirs; so it may come twice, and never not at all. Reaches are of no use
    here: the earlier list need not be the one of the pair's first common entry.
    """
    least = lists.groupBy("set_id").agg(
        F.slice(F.sort_array(F.collect_set("list")), 1, _FIRST_LISTS).alias("first_lists")
    )
    known = lists.join(least.join(sets.select("set_id", *_BITS), "set_id"), "set_id")
    blocks = F.ceil(F.col("members") / BLOCK)
    dealt = known.withColumn("block", F.pmod(F.xxhash64("set_id"), blocks))
    outside = known.where("component <> largest").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    both_outside = F.col("b.component") != F.col("b.largest")
    met = F.array_min(F.array_intersect("a.first_lists", "b.first_lists"))
    return (
        outside.alias("a")
        .join(
            dealt.alias("b"),
            (F.col("a.list") == F.col("b.list"))
            & (F.col("a.block") == F.col("b.block"))
            & (F.col("a.component") != F.col("b.component"))
            & (~both_outside | (F.col("a.set_id") < F.col("b.set_id")))
            & _sizes_fit("a", "b", percent)
            & _bits_fit("a", "b", percent)
            & (F.coalesce(met, F.col("a.list")) >= F.col("a.list")),
        )
        .select(*_ordered("a", "b"))
        .distinct()
    )


def _component_edges(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``links`` between sets as edges (a, b), a < b, between the components they are in."""
    a = labels.select(F.col("set_id").alias("a"), F.col("component").alias("x"))
    b = labels.select(F.col("set_id").alias("b"), F.col("component").alias("y"))
    return (
        links.join(a, "a")
        .join(b, "b")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .where("a < b")
        .distinct()
    )


def _links(docs: DataFrame, sets: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) with a < b that join all sets that links of any kind join.

    Sets of one entry meet its least one first. While lists of several components are
    long, leaders meet them and components are merged, so that copies of copies are
    joined by work in proportion to the lists; what then stays apart is compared in pairs.
    """
    groups = index.groupBy("entry").agg(F.min("set_id").alias("least"), F.max("set_id").alias("most"))
    shared = materialize(groups.where("least < most").select("entry", "least"), "shared")
    members = materialize(
        index.where(may_hold(F.col("entry"), key_filter(shared, "entry")))
        .join(shared, "entry")
        .where("set_id <> least"),
        "members",
    )
    first = members.select(F.col("least").alias("a"), F.col("set_id").alias("b")).distinct()
    tried = materialize(_plausible(first, sets, percent), "first")
    links = materialize(_verified(tried, docs, sets, percent), "links")
    labels = materialize(components(links), "labels").withColumnRenamed("node", "set_id")
    placed = members.select("entry", "set_id", "n", "reach").join(labels, "set_id", "left")
    placed = materialize(
        placed.withColumn("component", F.coalesce("component", "set_id")), "placed"
    )
    edges = labels.where("component < set_id").select(F.col("component").alias("a"), F.col("set_id").alias("b"))
    lists = materialize(_open_lists(placed), "lists")

    def verified(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        new = materialize(_plausible(pairs.join(tried, ["a", "b"], "left_anti"), sets, percent), "tried")
        return new, materialize(_verified(new, docs, sets, percent), "links")

    before, turn = None, 0
    while True:
        lists = materialize(_with_largest(lists), "lists")
        led = lists.where(F.col("outside") > _LED)
        # Pairs that the long lists hold at most.
        left = led.agg(F.coalesce(F.sum("outside"), F.lit(0))).first()[0]
        if not left or (before is not None and 10 * left > 9 * before):
            break
        before, turn = left, turn + 1
        new, found = verified(_led_pairs(led, turn, percent))
        tried = tried.unionAll(new)
        now = lists.select("set_id", "component").distinct()
        joined = materialize(_component_edges(found, now), "joined")
        edges = edges.unionAll(joined)
        merged = materialize(components(joined), "merged").select(
            F.col("node").alias("component"), F.col("component").alias("into")
        )
        lists = (
            lists.select("list", "set_id", "n", "component", "reach")
            .join(merged, "component", "left")
            .withColumn("component", F.coalesce("into", "component"))
            .drop("into")
        )
    return edges.unionAll(verified(_all_pairs(lists, sets, percent))[1])


def similar_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id and component of every row of ``docs`` (doc_id, text).

    Words are runs without space or 0x09-0x0D, A-Z lower-cased. A document is the set
    of its five-word shingles, or its whole word sequence if it is shorter. Two are
    linked when 100 * intersection >= percent * union; component_id is the smallest
    doc_id that links reach. ``component`` is the group's own label (its least set_id), which tells
    groups apart where a doc_id repeats or is missing. Documents without words (null, empty, blank) are linked
    with nothing and keep their own doc_id; their set_id is null.

    Rows without doc_id take part; a component of such rows alone has a null id.
    Repeated rows are equal sets and come out alike. An empty table gives no rows.
    Other columns are ignored, whatever their names. Shingles and sets are told apart
    by 64-bit hashes.
    """
    table = materialize(_digest(docs), "digest")
    rows = table.where(F.col("n").isNotNull()).select("doc_id", "key", "set_id", "n")
    sets = materialize(
        table.where("n > 0")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), *[F.max(c).alias(c) for c in ("n", "sketch", *_BITS)]),
        "sets",
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    classes = _classes(table.where(F.col("token").isNotNull()).select("token", "texts"), total)
    index = materialize(_index(docs, classes, percent), "index")
    labels = components(_links(docs, sets, index, percent)).withColumnRenamed("node", "set_id")
    named = sets.join(labels, "set_id", "left").select(
        "set_id", "doc_id", F.coalesce("component", "set_id").alias("component")
    )
    named = materialize(named, "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = named.select("set_id", "component").join(least, "component")
    return rows.join(names, "set_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "set_id",
        "key",
        "component",
    )


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: the smallest doc_id's.

    Rows without doc_id stay only if no row of their component has one. Of several rows
    that may stay one does. Rows without words are linked with nothing and all stay.
    Components are told apart by their texts, so a doc_id may repeat.
    """

    def first_rows() -> DataFrame:
        rows = similar_documents(docs, percent).where("set_id is not null")
        return rows.groupBy("component").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
        )

    stays = distilled(docs.sparkSession, first_rows, "stays")
    key, kept = unused(docs.columns, "_key"), unused(docs.columns, "_kept")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    one = (
        keyed.where(worded)
        .join(stays.select(F.col("first.key").alias(kept)), F.col(key) == F.col(kept), "left_semi")
        .dropDuplicates([key])
    )
    return one.unionAll(keyed.where(~worded)).drop(key)
