"""Secret scans over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams that
its matches must contain. Documents are indexed in segments of a few thousand rows,
each in the task that holds it: postings of the trigrams that the rules ask for are
intersected and united as the query says, and only the candidates are verified with
the expression itself. A rule without mandatory trigrams scans the whole segment.
Texts are not shuffled, and a segment's index is dropped with the segment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.llm.common import slices, text_or_empty

Query = str | tuple | None  # a trigram, ("and" | "or", queries), or None: everything


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``; where ``group`` is set it must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules are given, in this order; the others are published token formats.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
# A literal run is followed through at most so many spellings, then it is cut.
_MAX_SPELLINGS = 32


def _all_of(parts: list[Query]) -> Query:
    known = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not known else known[0] if len(known) == 1 else ("and", tuple(known))


def _any_of(parts: list[Query]) -> Query:
    if not parts or None in parts:
        return None
    distinct = tuple(dict.fromkeys(parts))
    return distinct[0] if len(distinct) == 1 else ("or", distinct)


def _of_spellings(run: set[str]) -> Query:
    """Any of the spellings, each with all its trigrams."""
    return _any_of([_all_of([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(run)])


def _spellings(op, arg) -> set[str] | None:
    """All strings that an element of the parsed expression can match, lower-cased, if few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if name == "SUBPATTERN":
        return _sequence_spellings(arg[-1])
    if name == "BRANCH":
        each = [_sequence_spellings(b) for b in arg[1]]
        return None if None in each else set().union(*each)
    if name == "MAX_REPEAT" and arg[1] == 1:
        inner = _sequence_spellings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _sequence_spellings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        more = _spellings(op, arg)
        if more is None or len(out) * len(more) > _MAX_SPELLINGS:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def _of_sequence(items) -> Query:
    found: list[Query] = []
    run = {""}
    for op, arg in items:
        more = _spellings(op, arg)
        if more is not None and len(run) * len(more) <= _MAX_SPELLINGS:
            run = {a + b for a, b in product(run, more)}
            continue
        found.append(_of_spellings(run))
        run = {""}
        name = str(op)
        if more is not None:
            run = more
        elif name == "SUBPATTERN":
            found.append(_of_sequence(arg[-1]))
        elif name == "BRANCH":
            found.append(_any_of([_of_sequence(b) for b in arg[1]]))
        elif name == "MAX_REPEAT" and arg[0] > 0:
            found.append(_of_sequence(arg[2]))
    return _all_of([*found, _of_spellings(run)])


def trigram_query(pattern: str) -> Query:
    """What every match must contain, in lower case; None if that can't be told."""
    return _of_sequence(re._parser.parse(pattern))


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def postings(texts: list[str], wanted: Iterable[str]) -> dict[str, set[int]]:
    """The inverted index of a segment: rows that contain each wanted trigram."""
    return {t: {i for i, text in enumerate(texts) if t in text} for t in wanted}


def candidates(query: Query, index: dict[str, set[int]]) -> set[int]:
    if isinstance(query, str):
        return index[query]
    each = [candidates(q, index) for q in query[1]]
    return set.intersection(*each) if query[0] == "and" else set.union(*each)


def rule_spans(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, then those that are long enough."""
    return [
        m.span()
        for m in compiled.finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def scan_segment(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple]]:
    """For each text its spans as (start, rule number, kind, end), in order."""
    # With ASCII, ignoring case concerns a-z only, so lower-casing the text suffices.
    compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
    queries = [trigram_query(r.pattern) for r in rules]
    lowered = [t.lower() for t in texts]
    index = postings(lowered, sorted(set().union(*map(trigrams, queries))))
    found: list[list[tuple]] = [[] for _ in texts]
    for number, (rule, expression, query) in enumerate(zip(rules, compiled, queries, strict=True)):
        rows = range(len(texts)) if query is None else sorted(candidates(query, index))
        for i in rows:
            found[i] += [(a, number, rule.kind, b) for a, b in rule_spans(rule, expression, texts[i])]
    return [sorted(f) for f in found]


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (array of kind, start, end; code points, end exclusive) of every row.

    Spans are in order of start, then of the rules. A null text is empty and has no
    spans. Repeated rows are scanned each on their own. An empty table gives no rows.
    Columns other than doc_id and text are ignored, whatever their names.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = scan_segment(batch.column("text").to_pylist(), rules)
            rows = [[{"kind": k, "start": a, "end": b} for a, _, k, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows, pa.list_(kind)),
                    pa.array([_joined(s) for s in spans], pa.string()),
                    pa.array(
                        [
                            hashlib.sha256(
                                _joined([x for x in s if x[1] < len(BASE_RULES)]).encode()
                            ).hexdigest()
                            for s in spans
                        ],
                        pa.string(),
                    ),
                ],
                ["doc_id", "found", "spans", "base_sha256"],
            )

    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text")
    ).mapInArrow(
        scan,
        "doc_id long, found array<struct<kind: string, start: long, end: long>>, spans string, base_sha256 string",
    )
