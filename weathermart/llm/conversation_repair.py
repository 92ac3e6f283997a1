"""Repair of conversation structure: the cheapest edits that give ``(system? (user assistant)+)?``.

The cost of finishing from each automaton state, going backward from the end, is a vector of
four small numbers; less its minimum it is one of a few dozen vectors. So transitions of whole
blocks of four rows are looked up in a table of (vector, block) that is computed once per worker
(Four Russians). Rows are compact here: one byte per row, no text.

Conversations of any length are cut into segments of at most ``SEGMENT`` rows by a range
partitioning, so a very long conversation is spread over many tasks:

1. each segment is mapped, block by block, to its end-vector table (all vectors at once);
2. per conversation the tables of its segments are chained backward;
3. each segment's blocks are expanded backward from its end vector and traced forward, for each
   start state, with the least edit letter among the cheapest at every step;
4. per conversation the traces are chained forward.

Only ``repaired_rows`` and the digest meet texts again: rows and audit are merged in one sorted
stream per conversation, which holds the audit (a byte per edit, as the result does), never rows.

Defined results: a null role or text is one space; a null conv_id is a conversation of its own;
rows of one turn go by role, then digest of the text; null turns come first. Equal rows are
duplicates of one another. Conversations without rows are unknown here; see ``audits``. Columns
other than conv_id, turn, role and text are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weathermart.sources.paths import materialize

# Costs of the edits, the roles, and blanks that end a text.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
BLANK = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# Automaton states: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = "sua"
# Row symbols: 3 * initial (s, u, a, other) + fault; the last symbol is no row at all.
_SOUND, _CUT, _GONE = range(3)
_SYMBOLS = 13
_PAD = _SYMBOLS - 1
# The state that user or assistant, whichever may follow, leads to.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)

BLOCK = 4
SEGMENT = 4096


def _kept(state: int, initial: int) -> int | None:
    """The state after a row that stays as it is, or None where it may not follow."""
    if initial == 0:
        return _SYSTEM if state == _START else None
    if initial == 1:
        return _USER if state != _USER else None
    return _ASSISTANT if initial == 2 and state == _USER else None


def _edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """Edits that consume a row: letter, cost, next state; letters in ASCII order."""
    initial, fault = divmod(symbol, 3)
    found = [("D", DELETE, state)]
    if fault != _GONE:
        extra = TRUNCATED if fault == _CUT else 0
        if (after := _kept(state, initial)) is not None:
            found.append(("K", extra, after))
        found.append(("R", RELABEL + extra, _NEXT[state]))
    return found


def _inserting(costs: list[int]) -> tuple[int, ...]:
    """Costs to finish, where turns may also be inserted first."""
    for _ in range(4):
        costs = [min(c, INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """Reachable normalised cost vectors, their transitions by row and by block, and traces."""

    def __init__(self):
        far = 1000
        final = _inserting([0, far, far, 0])
        vectors, steps = {final: 0}, []
        for vector in (queue := [final]):
            row = []
            for symbol in range(_PAD):
                costs = _inserting(
                    [min(c + vector[after] for _, c, after in _edits(q, symbol)) for q in range(4)]
                )
                least = min(costs)
                goal = tuple(c - least for c in costs)
                if goal not in vectors:
                    vectors[goal] = len(vectors)
                    queue.append(goal)
                row.append((vectors[goal], least))
            steps.append([*row, (vectors[vector], 0)])
        self.vectors = queue
        one, offset = (np.array([[s[k] for s in row] for row in steps]) for k in (0, 1))
        self.one, self.offset = one, offset
        # A block's table applies its last symbol first.
        goal, cost = one, offset
        for _ in range(BLOCK - 1):
            n = goal.shape[1]
            # The new symbol goes before the block so far.
            cost = (cost[:, None, :] + offset[goal].transpose(0, 2, 1)).reshape(len(one), _SYMBOLS * n)
            goal = one[goal].transpose(0, 2, 1).reshape(len(one), _SYMBOLS * n)
        self.block, self.block_cost = goal.astype(np.int32), cost.astype(np.int32)

    @functools.cached_property
    def traces(self) -> dict[tuple[int, int, int], tuple[bytes, int]]:
        """(vector after the row, symbol, state) -> least cheapest letters, next state."""
        found = {}
        for v, vector in enumerate(self.vectors):
            for symbol, state in itertools.product(range(_PAD), range(4)):
                costs = [min(c + vector[after] for _, c, after in _edits(q, symbol)) for q in range(4)]
                best, letters, q = _inserting(costs), "", state
                while True:
                    options = [(letter, after) for letter, c, after in _edits(q, symbol) if c + vector[after] == best[q]]
                    if best[q] == INSERT + best[_NEXT[q]]:
                        options.append(("I", None))
                    letter, after = min(options, key=lambda o: o[0])
                    letters += letter
                    if after is not None:
                        break
                    q = _NEXT[q]
                found[v, symbol, state] = letters.encode(), after
        return found


@functools.cache
def tables() -> Tables:
    return Tables()


# Inserts that finish a conversation, by the last state.
_ENDING = (b"", b"II", b"I", b"")


def _blocks(symbols: np.ndarray) -> np.ndarray:
    """Codes of the blocks; the first one is filled up in front with no rows."""
    gap = -len(symbols) % BLOCK
    whole = np.concatenate([np.full(gap, _PAD), symbols]).reshape(-1, BLOCK)
    return whole @ (_SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def segment_table(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector at the segment's end: the vector at its start, and the cost between."""
    t = tables()
    goal = np.arange(len(t.vectors))
    cost = np.zeros(len(goal), np.int64)
    for code in _blocks(symbols)[::-1]:
        cost += t.block_cost[goal, code]
        goal = t.block[goal, code]
    return goal, cost


def trace_segment(symbols: np.ndarray, end: int) -> list[tuple[bytes, int]]:
    """For every start state: the least cheapest letters for these rows, and the last state."""
    t = tables()
    codes = _blocks(symbols)
    borders = [end]
    for code in codes[::-1]:
        borders.append(int(t.block[borders[-1], code]))
    after = np.zeros(len(symbols), np.int64)
    stop = len(symbols)
    for border in borders[:-1]:
        vector, start = border, max(0, stop - BLOCK)
        for i in range(stop - 1, start - 1, -1):
            after[i] = vector
            vector = t.one[vector, symbols[i]]
        stop = start
    rows = list(zip(after.tolist(), symbols.tolist()))
    found = []
    for state in range(4):
        letters = bytearray()
        for vector, symbol in rows:
            step, state = t.traces[vector, symbol, state]
            letters += step
        found.append((bytes(letters), state))
    return found


# --- rows ---------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Seeded faults by ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2
    removes its stops, 3 repeats it, 4 makes it a user's. Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.col("kind")
    text = F.coalesce("text", space)
    return (
        conversations.select(
            "conv_id", "turn", "role", "text", (F.crc32(F.encode(key, "UTF-8")) % 20).alias("kind")
        )
        .filter(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, USER).otherwise(F.coalesce("role", space)).alias("role"),
            F.when(kind == 1, "")
            .when(kind == 2, F.regexp_replace(text, f"[{STOPS}]", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _prepared(conversations: DataFrame) -> DataFrame:
    """The four columns without nulls in role and text, and ``digest`` of both."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    both = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.md5(F.encode(both, "UTF-8"))))


def classified(conversations: DataFrame) -> DataFrame:
    """One compact row per distinct (conv_id, turn, role, text) with its number of copies.

    ``initial`` is 0 to 3 for s, u, a and others; ``blank``, ``cut`` (truncated) and ``first``
    (role and text not seen earlier) are its faults. Copies after the first are duplicates.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(BLANK))
    letter = F.substring("role", 1, 1)
    initial = F.lit(3)
    for i, name in enumerate(_INITIALS):
        initial = F.when(letter == name, i).otherwise(initial)
    compact = (
        _prepared(conversations)
        .select(
            "conv_id", "turn", "role", "digest", initial.alias("initial"),
            (trimmed == "").alias("blank"),
            (~F.substring(trimmed, -1, 1).isin(*STOPS)).alias("cut"),
        )
        .groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "cut")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    compact = materialize(compact, "classified")
    # Messages of several turns only, so this side is short as a rule.
    seen = (
        compact.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"))
        .agg(
            F.count(F.lit(1)).alias("_turns"),
            F.bool_or(F.col("turn").isNull()).alias("_early"),
            F.min("turn").alias("_least"),
        )
        .filter(F.col("_turns") > 1)
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    here = F.when(F.col("_early"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("_least"))
    return compact.join(seen, same, "left").select(
        *compact.columns, F.when(F.col("_turns").isNull(), True).otherwise(here).alias("first")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Per conversation of ``classified`` rows: gaps in turns, and rows by their first fault."""
    copies = F.col("copies")
    sound = ~F.col("blank")

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("long")

    return rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        total(F.when(F.col("blank"), copies)).alias("blank"),
        total(F.when(sound, copies - F.col("first").cast("long"))).alias("duplicate"),
        total(F.when(sound & F.col("first") & F.col("cut"), 1)).alias("truncated"),
    )


# --- segments -----------------------------------------------------------------


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
    """(conv_id, symbols) of sorted compact rows, in pieces of at most ``SEGMENT`` symbols."""
    conv, piece = None, bytearray()
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, symbol, again, copies in zip(*columns):
            if piece and key != conv:
                yield conv, bytes(piece)
                piece.clear()
            conv = key
            piece.append(symbol)
            copies -= 1
            while True:
                taken = min(copies, SEGMENT - len(piece))
                piece += bytes([again]) * taken
                copies -= taken
                if len(piece) == SEGMENT:
                    yield conv, bytes(piece)
                    piece.clear()
                if not copies:
                    break
    if piece:
        yield conv, bytes(piece)


def _illegal(symbols: np.ndarray) -> int:
    """Neighbours whose initials are not su, ua or au."""
    a, b = symbols[:-1] // 3, symbols[1:] // 3
    return int(len(a) - np.count_nonzero((b == 1) & ((a == 0) | (a == 2)) | (a == 1) & (b == 2)))


def _make_segments(schema: pa.Schema):
    def run(batches):
        part = TaskContext.get().partitionId()
        for group in itertools.batched(enumerate(_runs(batches)), 2000):
            columns = [[] for _ in schema]
            for seq, (conv, piece) in group:
                symbols = np.frombuffer(piece, np.uint8).astype(np.int64)
                goal, cost = segment_table(symbols)
                row = (conv, part, seq, piece, goal.astype("<i2").tobytes(), cost.astype("<i8").tobytes(), _illegal(symbols))
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    for group in itertools.batched(rows, size):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*group), schema)], schema=schema
        )


_NONE = object()


def _chain_backward(schema: pa.Schema):
    """Segments from the last to the first of each conversation: their end vectors."""

    def rows(batches):
        conv, vector, spent = _NONE, 0, 0
        for key, part, seq, piece, goal, cost, illegal in _rows_of(batches):
            if key != conv:
                conv, vector, spent = key, 0, 0
            end = vector
            spent += int(np.frombuffer(cost, "<i8")[end])
            vector = int(np.frombuffer(goal, "<i2")[end])
            yield key, part, seq, piece, end, spent + tables().vectors[vector][_START], illegal

    return lambda batches: _batched(rows(batches), schema)


def _trace(schema: pa.Schema):
    def rows(batches):
        for key, part, seq, piece, end, cost, illegal in _rows_of(batches):
            symbols = np.frombuffer(piece, np.uint8).astype(np.int64)
            found = trace_segment(symbols, end)
            ends = piece[0] // 3, piece[-1] // 3
            yield key, part, seq, [f[0] for f in found], [f[1] for f in found], cost, illegal, *ends

    return lambda batches: _batched(rows(batches), schema, 200)


def _chain_forward(schema: pa.Schema):
    """Segments in order: one row per conversation with its audit."""

    def rows(batches):
        conv, state = _NONE, _START
        for key, part, seq, letters, states, cost, illegal, first, last in _rows_of(batches):
            if key != conv:
                if conv is not _NONE:
                    yield conv, (bytes(audit) + _ENDING[state]).decode(), total, wrong
                conv, state, audit, total, wrong = key, _START, bytearray(), cost, 0
            else:
                wrong += (before, first) not in ((0, 1), (1, 2), (2, 1))
            audit += letters[state]
            state, before = states[state], last
            wrong += illegal
        if conv is not _NONE:
            yield conv, (bytes(audit) + _ENDING[state]).decode(), total, wrong

    return lambda batches: _batched(rows(batches), schema, 100)


def _schemas(conv: T.DataType, **columns: str) -> tuple[T.StructType, pa.Schema]:
    rest = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
    kinds = T.StructType([T.StructField("conv_id", conv), *rest.fields])
    return kinds, to_arrow_schema(kinds)


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id, audit, cost, illegal`` of ``classified`` rows: the cheapest edits' letters
    (equal costs: ASCII-least) and the number of neighbours that may not follow each other."""
    conv = rows.schema["conv_id"].dataType
    base = F.col("initial") * 3
    fault = F.when(F.col("blank") | ~F.col("first"), _GONE).when(F.col("cut"), _CUT).otherwise(_SOUND)
    order = ["conv_id", "turn", "role", "digest"]
    kinds, schema = _schemas(conv, part="int", seq="int", symbols="binary", goal="binary", cost="binary", illegal="long")
    segments = (
        rows.select(
            *order, (base + fault).alias("symbol"), (base + _GONE).alias("again"), "copies"
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "symbol", "again", "copies")
        .mapInArrow(_make_segments(schema), kinds)
    )
    segments = materialize(segments, "segments")

    kinds, schema = _schemas(conv, part="int", seq="int", symbols="binary", goal="int", cost="long", illegal="long")
    ended = (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
        .mapInArrow(_chain_backward(schema), kinds)
    )
    kinds, schema = _schemas(
        conv, part="int", seq="int", letters="array<binary>", states="array<int>", cost="long",
        illegal="long", head="int", tail="int",
    )
    traced = ended.repartition("conv_id", "part", "seq").mapInArrow(_trace(schema), kinds)
    kinds, schema = _schemas(conv, audit="string", cost="long", illegal="long")
    return (
        traced.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "seq")
        .mapInArrow(_chain_forward(schema), kinds)
    )


# --- repaired conversations -----------------------------------------------------


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, str, str, str]]:
    """``conv_id, letter, role, text`` of every edit, from audits and rows in one sorted stream."""
    letters, state = iter(()), _START

    def inserted(conv):
        nonlocal state
        role = ASSISTANT if _NEXT[state] == _ASSISTANT else USER
        state = _NEXT[state]
        return conv, "I", role, ""

    last = None
    for conv, audit, role, text in _rows_of(batches):
        if audit is not None:
            yield from (inserted(last) for _ in letters)
            letters, state, last = iter(audit), _START, conv
            yield conv, "", None, None
            continue
        for letter in letters:
            if letter != "I":
                break
            yield inserted(conv)
        if letter == "R":
            role = ASSISTANT if _NEXT[state] == _ASSISTANT else USER
            state = _NEXT[state]
        elif letter == "K":
            state = _kept(state, (_INITIALS + role[:1]).index(role[:1]))
        yield conv, letter, role, text
    yield from (inserted(last) for _ in letters)


def _stream(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Audits and whole rows side by side: each conversation's audit, then its rows in order."""
    none = F.lit(None).cast("string")
    heads = audit.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                         none.alias("role"), F.lit(None).cast("binary").alias("digest"), "audit", none.alias("text"))
    whole = _prepared(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", none.alias("audit"), "text")
    return (
        heads.unionByName(whole)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
        .select("conv_id", "audit", "role", "text")
    )


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the repaired conversations, deleted rows left out."""
    kinds, schema = _schemas(
        conversations.schema["conv_id"].dataType, position="long", edit="string", role="string", text="string"
    )

    def run(batches):
        def rows():
            position = 0
            for conv, letter, role, text in _merged(batches):
                if not letter:
                    position = 0
                elif letter != "D":
                    yield conv, position, letter, role, text
                    position += 1

        return _batched(rows(), schema)

    return _stream(conversations, audits(classified(conversations))).mapInArrow(run, kinds)


def _digests(schema: pa.Schema):
    def run(batches):
        def rows():
            conv, digest, start = _NONE, None, True
            for key, letter, role, text in _merged(batches):
                if not letter:
                    if conv is not _NONE:
                        yield conv, digest.hexdigest()
                    conv, digest, start = key, hashlib.sha256(), True
                elif letter != "D":
                    digest.update(f"{role}:{text}".encode() if start else f"\n{role}:{text}".encode())
                    start = False
            if conv is not _NONE:
                yield conv, digest.hexdigest()

        return _batched(rows(), schema)

    return run


def reports(conversations: DataFrame, all_ids: DataFrame) -> DataFrame:
    """Per conversation of ``all_ids``: faults, cost and audit of the repair, and the digest of
    the repaired ``role:text`` lines. Conversations without rows have zeros and empty text."""
    conv = conversations.schema["conv_id"].dataType
    rows = materialize(classified(conversations), "flagged")
    audit = materialize(audits(rows), "audits")
    kinds, schema = _schemas(conv, repaired_sha256="string")
    digest = _stream(conversations, audit).mapInArrow(_digests(schema), kinds)
    out = all_ids.select("conv_id").distinct()
    for part in (faults(rows), audit, digest):
        renamed = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(renamed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id",
        *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
