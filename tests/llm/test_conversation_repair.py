"""Repairs against a plain search over all edits, on damaged, odd and very long conversations."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weathermart.llm import conversation_repair as c

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # Names that the operator uses inside, to clash with.
        *(T.StructField(n, T.StringType()) for n in ("digest", "copies", "part", "audit", "first")),
    ]
)
NEXT = {"q": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "c", "p", "a", "f") for r in rows], SCHEMA)


def damaged(rows):
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def least(*ways):
    return min(ways, key=lambda w: w[:2])


def expected(rows):
    convs = collections.defaultdict(list)
    for r in rows:
        convs[r[0]].append(r[1:])
    out = {}
    for conv, lines in convs.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        turns = {t for t, *_ in lines if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, symbols, faults = set(), [], collections.Counter()
        for _, role, text in lines:
            blank = not re.search(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if blank else "duplicate" if (role, text) in seen else None
            if not fault and text.strip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faults[fault] += 1
            symbols.append(fault)
        initials = [role[:1] for _, role, _ in lines]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        # Cost, letters, lines (as a linked list) to finish from each state.
        best = {"q": (0, "", None), "a": (0, "", None), "u": (3, "I", ("assistant:", None))}
        best["s"] = (6, "II", ("user:", best["u"][2]))
        for (_, role, text), fault, x in list(zip(lines, symbols, initials))[::-1]:
            ways = {}
            for q in "qsua":
                options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
                if fault not in ("blank", "duplicate"):
                    extra = 3 * (fault == "truncated")
                    if x == NEXT[q] or x == "s" and q == "q":
                        b = best[x]
                        options.append((b[0] + extra, "K" + b[1], (f"{role}:{text}", b[2])))
                    b = best[NEXT[q]]
                    options.append((b[0] + extra + 3, "R" + b[1], (f"{FULL[NEXT[q]]}:{text}", b[2])))
                ways[q] = least(*options)
            for _ in range(3):
                for q in "auqs":
                    b = ways[NEXT[q]]
                    ways[q] = least(ways[q], (b[0] + 3, "I" + b[1], (FULL[NEXT[q]] + ":", b[2])))
            best = ways
        cost, audit, chain = best["q"]
        whole = []
        while chain:
            whole.append(chain[0])
            chain = chain[1]
        sha = hashlib.sha256("\n".join(whole).encode()).hexdigest()
        counts = (faults["blank"], faults["duplicate"], faults["truncated"])
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def check(spark, rows, faulty=True):
    df = frame(spark, rows).repartition(5)
    got = c.reports(c.damage(df) if faulty else df, df).collect()
    want = expected(damaged(rows) if faulty else [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows])
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert len(got) == len({r[0] for r in rows})
    for row in got:
        assert tuple(row)[1:] == want.get(row.conv_id, none), row.conv_id


def conversations(seed, n, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut", "", " \n", "ok. ", "Ünï. ", "a.\xa0", None, "same.", "x\ny."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User", "student"]
    for conv in range(n):
        for turn in range(draw.randint(0, longest)):
            turn = draw.choice([turn, turn, turn, None, -turn])
            yield conv, turn, draw.choice(roles[: draw.choice([2, 5, 10])]), draw.choice(texts)


@pytest.mark.parametrize("faulty", [True, False])
def test_every_report_equals_the_plain_search(spark, faulty):
    rows = [*conversations(1, 300, 14), (None, None, None, None), (None, 3, "user", "Hi."), (-5, 0, "a", "x" * 200_000)]
    check(spark, rows + rows[:30], faulty)


def test_a_conversation_of_many_segments(spark):
    draw = random.Random(3)
    roles = ["user", "assistant"] * 3 + ["system", "tool"]
    rows = [(7, i, draw.choice(roles), f"{i}{draw.choice(['.', '', '!'])}") for i in range(3 * c.SEGMENT // 2)]
    check(spark, [*rows, *((8, None, "user", "again.") for _ in range(2 * c.SEGMENT)), (9, 1, "user", "a.")])


def test_rows_and_letters_fit_together(spark):
    df = frame(spark, list(conversations(5, 60, 9)))
    rows = c.repaired_rows(df).orderBy("conv_id", "position").collect()
    audits = {r.conv_id: r.audit for r in c.reports(df, df).collect()}
    for conv, audit in audits.items():
        own = [r for r in rows if r.conv_id == conv]
        assert "".join(r.edit for r in own) == audit.replace("D", "")
        assert [r.position for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in own))


def test_tables_without_rows(spark):
    df = frame(spark, [])
    assert c.reports(c.damage(df), df).count() == 0
    assert c.repaired_rows(df).count() == 0


def test_blocks_give_what_single_rows_give():
    t = c.tables()
    draw = random.Random(2)
    for _ in range(300):
        symbols, vector = draw.choices(range(13), k=c.BLOCK), draw.randrange(len(t.vectors))
        code, at, cost = 0, vector, 0
        for s in symbols:
            code = code * 13 + s
        for s in symbols[::-1]:
            cost += t.offset[at, s]
            at = t.one[at, s]
        assert (t.block[vector, code], t.block_cost[vector, code]) == (at, cost)


def test_ordering_needs_no_global_sort(spark):
    rows = c.classified(frame(spark, list(conversations(1, 20, 9))))
    assert set(rows.columns) >= {"conv_id", "turn", "digest", "copies", "first"}
    assert rows.filter(F.col("copies") < 1).count() == 0
