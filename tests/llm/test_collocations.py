"""Phrases against plain counting, and the double array against a dictionary."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from weathermart.llm import collocations as c

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text", "lang", "grp", "word", "f", "phrase", "n")]
)


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, "a", "b", "c", "d", "e") for t, lang in rows], SCHEMA)


def expected(rows, min_count, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    kept = {key: a for key, a in f.items() if a >= min_count and len(key[1]) > 1}
    hidden = {
        (lang, p[i : i + k])
        for (lang, p), a in kept.items()
        for k in range(2, len(p))
        for i in range(len(p) - k + 1)
        if 100 * a >= 80 * f[lang, p[i : i + k]]
    }
    found = collections.defaultdict(list)
    for (lang, p), a in kept.items():
        if (lang, p) not in hidden:
            cuts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return [
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang in sorted(found)
        for rank, (s, a, p, l, r) in enumerate(sorted(found[lang])[:top], 1)
    ]


def found(df):
    return [tuple(row) for row in df.orderBy("grp", "rank").collect()]


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = ["The", "the", "of", "é", "É", "東京", "a-b", "\x00z", "'s", "zz", *map(str, range(12))]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " \x0b"]
    for _ in range(n):
        words = draw.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=draw.randint(0, 60))
        yield "".join(w + draw.choice(joins) for w in words), draw.choice(["en", "de", None, ""])


def test_phrases_scores_and_ranks_equal_plain_counting(spark):
    rows = [*texts(1, 400), (None, "en"), ("", "de"), (" \n", None), ("a a a a a a " * 3000, "fr")]
    rows += rows[:20]
    df = frame(spark, rows).repartition(5)
    assert found(c.collocations(df, min_count=20)) == expected(rows, 20)
    assert found(c.collocations(df, min_count=3, top=7)) == expected(rows, 3, 7)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("alone", "en")], [("a b " * 5, "en")]])
def test_nothing_frequent_gives_no_rows(spark, rows):
    assert c.collocations(frame(spark, rows)).count() == 0


def test_a_table_over_the_limit_is_an_error(spark):
    with pytest.raises(ValueError, match="over the limit of 2"):
        c.collocations(frame(spark, [("a b c d " * 40, "en")]), max_phrases=2)


@pytest.mark.parametrize("seed, symbols", [(1, 1), (2, 5), (3, 300), (4, 70_000)])
def test_the_double_array_holds_exactly_its_phrases(seed, symbols):
    draw = random.Random(seed)
    known = {(s,) for s in range(symbols)}
    # A hot first word, as function words are.
    for _ in range(min(3 * symbols, 3000)):
        known.add((draw.choice([0, draw.randrange(symbols)]), draw.randrange(symbols)))
    pairs = sorted(p for p in known if len(p) == 2)
    known |= {p + (draw.randrange(symbols),) for p in pairs[::2]}
    levels = [np.array(sorted(p for p in known if len(p) == k + 1)).reshape(-1, k + 1) for k in range(3)]
    trie = c.DoubleArray(symbols, levels)
    text = np.array([draw.choice([-1, 0, *draw.choice(pairs), draw.randrange(symbols)]) for _ in range(4000)])
    pieces = np.arange(len(text)) // 50
    for k, (at, states) in enumerate(trie.walk(text, pieces), 1):
        hits = [i for i in range(len(text) - k + 1) if pieces[i] == pieces[i + k - 1] and tuple(text[i : i + k]) in known]
        assert at.tolist() == hits
        named, lengths = trie.symbols_of(states)
        assert set(lengths.tolist()) <= {k}
        assert [tuple(row[-k:]) for row in named.tolist()] == [tuple(text[i : i + k].tolist()) for i in hits]
