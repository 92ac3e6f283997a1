"""Phrase collocation mining by double-array tries that every task walks over its texts.

Candidates are grown as in Apriori: a phrase can only be frequent if its parts are. The
frequent words become symbols; pairs of symbols, then chains of frequent pairs, propose
longer phrases, and a proposal whose counts over all tasks stay below the limit is left out.
What remains is a prefix-closed set of phrases, built into one double-array trie. Tasks
advance the states of all text positions at once, level by level, and count the states they
accept; the counts of all tasks are added up. Scores and pruning are plain DataFrame work.

The trie, the symbols and the proposals are the only things that pass the driver. None holds
documents; each is at most ``max_phrases`` long, and more is an error that names the limit,
never a cut. Text is read four times and never shuffled.

Defined results: a null group counts as ``und``; null and blank texts have no words; equal
rows count as often as they occur; an empty table gives no rows. Other columns are ignored,
whatever their names. Documents are processed in chunks of at most ``CHUNK_BYTES``; a longer
text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weathermart.sources.paths import materialize

# Bytes between words, and bytes that no phrase crosses.
BLANK_BYTES = b"\x20\x09"
BREAK_BYTES = b".,;:!?\x0a\x0b\x0c\x0d"

NO_GROUP = "und"
CHUNK_BYTES = 16 << 20

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANK_BYTES)] = 1
_KIND[list(BREAK_BYTES)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# A code of two states: the first one's slot lies above this many bits.
_SLOT_BITS = 31
# Counts travel as arrays of this many neighbouring slots, so that a task adds one row for each.
_PART = 4096


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z lower-cased, and the number of each word's piece."""
    texts = pc.fill_null(texts, "")
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    data = np.frombuffer(pc.binary_join(whole, "\n")[0].as_buffer(), np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    pieces = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = pa.py_buffer(_LOWER[data[inside]])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), letters]), pieces


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """``(group, texts)`` with at most ``CHUNK_BYTES`` of text, or one longer text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
            part, start = batch.slice(start, stop - start), stop
            for group in pc.unique(part.column(0)):
                yield group.as_py(), part.filter(pc.equal(part.column(0), group)).column(1)


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``grp, word, n`` per chunk; the null word stands for all words of the chunk."""
    for group, texts in _chunks(batches):
        words, _ = split_words(texts)
        counted = words.value_counts()
        found = pa.concat_arrays([counted.field("values"), pa.nulls(1, pa.binary())])
        n = pa.concat_arrays([counted.field("counts"), pa.array([len(words)], pa.int64())])
        groups = pa.array([group] * len(found), pa.string())
        yield pa.RecordBatch.from_arrays([groups, found.view(pa.string()), n], ["grp", "word", "n"])


class Symbols:
    """Numbers of the frequent words: dense over all groups, in the order they are given."""

    def __init__(self, groups: list[str], words: pa.Array):
        self.groups, self.words = np.array(groups, object), words
        names, first = np.unique(self.groups.astype(str), return_index=True) if groups else ([], [])
        stops = [*first[1:], len(groups)]
        self.ranges = {str(g): (int(a), int(b)) for g, a, b in zip(names, first, stops)}

    def __len__(self) -> int:
        return len(self.words)

    def of(self, group: str, words: pa.Array) -> np.ndarray:
        """The symbol of each word; -1 for the others."""
        start, stop = self.ranges.get(group, (0, 0))
        known = self.words.slice(start, stop - start)
        found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
        return np.where(found < 0, -1, found + start)


class DoubleArray:
    """A trie of symbol sequences in two arrays: child of ``s`` by ``d`` at ``base[s] + d``.

    A symbol is two digits of ``radix``, so that the children of a state span at most
    ``radix`` slots, however many there are. ``check`` holds the slot of the parent; slot 0
    is the root.
    """

    def __init__(self, n_symbols: int, phrases: list[np.ndarray]):
        """``phrases[k]`` has one row of ``k + 1`` symbols per phrase; all prefixes are there."""
        self.radix = 1 << max(1, -(-(max(n_symbols, 2) - 1).bit_length() // 2))
        parents, digits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.depth = len(phrases)
        nodes, known = 1, None
        for rows in phrases:
            prefix = np.zeros(len(rows), np.int64) if known is None else known(rows[:, :-1])
            high, low = rows[:, -1] // self.radix, rows[:, -1] % self.radix
            pairs, where = np.unique(prefix * self.radix + high, return_inverse=True)
            parents.append(pairs // self.radix)
            digits.append(pairs % self.radix)
            middle = nodes + where
            nodes += len(pairs)
            parents.append(middle)
            digits.append(low)
            known = _finder(rows, nodes + np.arange(len(rows)))
            nodes += len(rows)
        self._place(np.concatenate(parents), np.concatenate(digits), nodes)

    def _place(self, parents: np.ndarray, digits: np.ndarray, nodes: int) -> None:
        order = np.lexsort((digits, parents))
        children, owner = order + 1, parents[order]
        owners, first, sizes = np.unique(owner, return_index=True, return_counts=True)
        room = 2 * nodes + 4 * self.radix
        used, top = np.zeros(room + self.radix, bool), 1
        base = np.zeros(nodes, np.int64)
        used[0] = True
        draw = np.random.default_rng(7)
        several = np.flatnonzero(sizes > 1)
        for i in several[np.argsort(-sizes[several], kind="stable")]:
            d = digits[children[first[i] : first[i] + sizes[i]] - 1]
            low, span = int(d[0]), int(d[-1] - d[0])
            for start in draw.integers(1, max(2, min(top + 1, room - span)), 24):
                if not used[start - low + d].any():
                    break
            else:
                start = top
            if start + span >= len(used):
                used = np.concatenate([used, np.zeros(len(used) + span, bool)])
            base[owners[i]] = start - low
            used[start - low + d] = True
            top = max(top, start + span + 1)
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~used)
        if len(free) < len(single):
            free = np.concatenate([free, len(used) + np.arange(len(single))])
        base[owners[single]] = free[: len(single)] - digits[children[first[single]] - 1]
        slots = np.zeros(nodes, np.int64)
        # Parents come before their children, so slots need no order.
        slots[1:] = base[parents] + digits
        size = int(slots.max()) + self.radix + 1
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.base[slots] = base
        self.check[slots[1:]] = slots[parents]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Advance by one symbol each: which states have a successor, and these successors.

        A base may be negative, so that a slot below 0 means no child, like a foreign slot.
        """
        alive = np.arange(len(states))
        for digit in (symbols // self.radix, symbols % self.radix):
            goal = self.base[states] + digit[alive]
            good = (goal > 0) & (goal < len(self.check))
            good &= self.check[np.where(good, goal, 0)] == states
            alive, states = alive[good], goal[good]
        return alive, states

    def walk(self, symbols: np.ndarray, pieces: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per level: positions where a phrase of that length starts, and their states."""
        at = np.flatnonzero(symbols >= 0)
        states = np.zeros(len(at), np.int64)
        for k in range(self.depth):
            last = at + k
            if k:
                inside = last < len(symbols)
                at, states, last = at[inside], states[inside], last[inside]
                inside = (pieces[at] == pieces[last]) & (symbols[last] >= 0)
                at, states, last = at[inside], states[inside], last[inside]
            alive, states = self.step(states, symbols[last])
            at = at[alive]
            yield at, states

    def symbols_of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the phrases that end in these slots, right-aligned, and their lengths."""
        out = np.full((len(slots), self.depth), -1, np.int64)
        lengths = np.zeros(len(slots), np.int64)
        slots = slots.astype(np.int64)
        for k in range(self.depth - 1, -1, -1):
            alive = np.flatnonzero(slots > 0)
            low = slots[alive]
            middle = self.check[low].astype(np.int64)
            above = self.check[middle].astype(np.int64)
            out[alive, k] = (middle - self.base[above]) * self.radix + low - self.base[middle]
            lengths[alive] += 1
            slots[alive] = above
        return out, lengths


def _finder(rows: np.ndarray, nodes: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Node of each of the given phrases, which must be among ``rows``."""
    order = np.lexsort(rows.T[::-1])
    kept = np.ascontiguousarray(rows[order].astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()

    def find(wanted: np.ndarray) -> np.ndarray:
        keys = np.ascontiguousarray(wanted.astype(">u4")).view(kept.dtype).ravel()
        return nodes[order[np.searchsorted(kept, keys)]]

    return find


def _positions(
    batches: Iterable[pa.RecordBatch], symbols: Symbols
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for group, texts in _chunks(batches):
        words, pieces = split_words(texts)
        yield symbols.of(group, words), pieces


def _coded(codes: np.ndarray) -> pa.RecordBatch:
    found, n = np.unique(codes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["code", "n"])


def _propose_pairs(shared: Broadcast):
    def run(batches):
        symbols: Symbols = shared.value
        for found, pieces in _positions(batches, symbols):
            good = (found[:-1] >= 0) & (found[1:] >= 0) & (pieces[:-1] == pieces[1:])
            yield _coded((found[:-1] << _SLOT_BITS | found[1:])[good])

    return run


def _propose_chains(shared: Broadcast, max_words: int):
    """Codes of two overlapping or adjoining pairs: phrases of three and four words.

    Longer phrases follow level by level from the trie of the shorter ones.
    """

    def run(batches):
        symbols, trie = shared.value
        for found, pieces in _positions(batches, symbols):
            *_, (at, states) = trie.walk(found, pieces)
            pair = np.full(len(found) + 2, -1, np.int64)
            pair[at] = states
            a, b, c = pair[:-2], pair[1:-1], pair[2:]
            three = (a >= 0) & (b >= 0)
            codes = [(a << _SLOT_BITS | b)[three]]
            if max_words > 3:
                four = three & (c >= 0)
                # The sign bit is free: it tells four words from three.
                codes.append(~(a << _SLOT_BITS | c)[four])
            yield _coded(np.concatenate(codes))

    return run


def _count_states(shared: Broadcast):
    def run(batches):
        symbols, trie = shared.value
        counts = np.zeros(len(trie.check), np.int64)
        for found, pieces in _positions(batches, symbols):
            for _, states in trie.walk(found, pieces):
                counts += np.bincount(states, minlength=len(counts))
        parts = [(b, counts[b : b + _PART]) for b in range(0, len(counts), _PART)]
        for few in batched(((b, part.tobytes()) for b, part in parts if part.any()), 32):
            starts, packed = zip(*few)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(packed)], ["start", "counts"])

    return run


def _add_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by slot, from parts of all tasks that come sorted by their first slot."""
    rows = (row for b in batches for row in zip(b.column("start").to_pylist(), b.column("counts")))
    for start, parts in groupby(rows, key=lambda row: row[0]):
        total = sum(np.frombuffer(part.as_buffer(), np.int64) for _, part in parts)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots + start), pa.array(total[slots])], ["slot", "f"])


def _name_states(shared: Broadcast):
    def run(batches):
        symbols, trie = shared.value
        for batch in batches:
            parts, lengths = trie.symbols_of(batch.column("slot").to_numpy())
            words = [symbols.words.take(pa.array(part, mask=part < 0)) for part in parts.T]
            phrases = pc.binary_join_element_wise(*words, b" ", null_handling="skip")
            groups = pa.array(symbols.groups[parts[:, -1]], pa.string())
            yield pa.RecordBatch.from_arrays(
                [groups, phrases.view(pa.string()), pa.array(lengths), batch.column("f")],
                ["grp", "phrase", "size", "f"],
            )

    return run


def _bounded(table: DataFrame, name: str, limit: int) -> pa.Table:
    """A small written table on the driver; more rows than ``limit`` are an error."""
    stored = materialize(table, name)
    if (n := stored.count()) > limit:
        raise ValueError(f"{n} rows of {name} are over the limit of {limit}: raise min_count or max_phrases")
    return stored.toArrow()


def _frequent(proposed: DataFrame, min_count: int) -> DataFrame:
    return proposed.groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).select("code")


def phrase_counts(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    min_count: int = 30,
    max_words: int = 4,
    max_phrases: int = 16_000_000,
) -> DataFrame:
    """``grp, phrase, size, f``: every phrase of up to ``max_words`` words found ``min_count``
    times or more in its group. The phrase null holds the number of all words of the group.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("max_words must be 2, 3 or 4")
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("grp"),
        F.col(text).cast("string").alias("text"),
    )
    words = materialize(
        texts.mapInArrow(count_words, "grp string, word string, n long")
        .groupBy("grp", "word")
        .agg(F.sum("n").alias("f"))
        .filter(F.col("word").isNull() | (F.col("f") >= min_count)),
        "words",
    )
    totals = words.filter("word IS NULL").select("grp", F.lit(None).cast("string").alias("phrase"),
                                                 F.lit(0).cast("long").alias("size"), "f")
    kept = _bounded(words.filter("word IS NOT NULL").select("grp", "word"), "symbols", max_phrases)
    kept = kept.sort_by([("grp", "ascending"), ("word", "ascending")]).combine_chunks()
    if not len(kept):
        return totals
    symbols = Symbols(kept["grp"].to_pylist(), pa.concat_arrays(kept["word"].chunks).view(pa.binary()))
    phrases = [np.arange(len(symbols), dtype=np.int64)[:, None]]

    code = "code long, n long"
    pairs = texts.mapInArrow(_propose_pairs(spark.sparkContext.broadcast(symbols)), code)
    found = _bounded(_frequent(pairs, min_count), "pairs", max_phrases)["code"].to_numpy()
    phrases.append(np.stack([found >> _SLOT_BITS, found & (1 << _SLOT_BITS) - 1], axis=1))

    if max_words > 2 and len(found):
        trie = DoubleArray(len(symbols), phrases)
        shared = spark.sparkContext.broadcast((symbols, trie))
        chains = texts.mapInArrow(_propose_chains(shared, max_words), code)
        found = _bounded(_frequent(chains, min_count), "chains", max_phrases)["code"].to_numpy()
        for long, codes in enumerate((found[found >= 0], ~found[found < 0])):
            first, _ = trie.symbols_of(codes >> _SLOT_BITS)
            second, _ = trie.symbols_of(codes & (1 << _SLOT_BITS) - 1)
            if len(codes):
                phrases.append(np.concatenate([first[:, -2:], second[:, -2 if long else -1 :]], axis=1))

    trie = DoubleArray(len(symbols), phrases)
    shared = spark.sparkContext.broadcast((symbols, trie))
    counted = (
        texts.mapInArrow(_count_states(shared), "start long, counts binary")
        .repartition("start")
        .sortWithinPartitions("start")
        .mapInArrow(_add_parts, "slot long, f long")
        .mapInArrow(_name_states(shared), "grp string, phrase string, size long, f long")
    )
    return materialize(totals.unionByName(counted), "phrases")


def _exact(count: Column) -> Column:
    return count.cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    min_count: int = 30,
    max_words: int = 4,
    top: int = 2000,
    max_phrases: int = 16_000_000,
) -> DataFrame:
    """The best phrases of each group: ``grp, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase; cut in two parts, ``l`` and ``r`` count these, and the cut with the
    lowest ``score = floor(2000000 a / (l + r))`` stands (equal ones: the first). A phrase goes
    if a longer candidate that holds it has at least 80 % of its count. Products are decimals.
    """
    counted = phrase_counts(docs, text, group, min_count, max_words, max_phrases)
    totals = counted.filter("phrase IS NULL").select("grp", F.col("f").alias("n"))
    found = counted.filter("phrase IS NOT NULL")
    several = found.filter("size > 1").withColumn("words", F.split("phrase", " "))

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    size = F.col("size").cast("int")
    cut = F.col("cut")
    cuts = several.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "grp", "phrase", F.col("f").alias("a"), "cut",
        part(F.lit(1), cut).alias("left"), part(cut + 1, size - cut).alias("right"),
    )
    left = found.select("grp", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = found.select("grp", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr("cast(a AS decimal(20,0)) * 2000000 div (cast(l AS decimal(20,0)) + r)")
    scored = (
        cuts.join(left, ["grp", "left"])
        .join(right, ["grp", "right"])
        .groupBy("grp", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    )

    inner = F.filter(
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), size),
                lambda start: F.transform(
                    F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2))),
                    lambda length: F.when(
                        (length < size) & (start + length - 1 <= size), part(start, length)
                    ),
                ),
            )
        ),
        lambda x: x.isNotNull(),
    )
    covered = (
        several.filter("size > 2")
        .select("grp", F.explode(inner).alias("phrase"), "f")
        .groupBy("grp", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    hidden = _exact(F.coalesce("longer", F.lit(0))) * 100 >= _exact(F.col("a")) * 80
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return (
        scored.join(covered, ["grp", "phrase"], "left")
        .filter(~hidden)
        .select("grp", "phrase", "a", "best.l", "best.r", "best.score")
        .withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
        .join(totals, "grp")
        .select("grp", "rank", "phrase", "a", "l", "r", "n", "score")
    )
