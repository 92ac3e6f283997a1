"""Registered queries of the operators, on whole tables, and their SQL where it exists."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weathermart.llm import (
    collocations,
    conversation_repair,
    decontaminate,
    jaccard,
    line_rules,
    mixing,
    passages,
    preferences,
    pseudonyms,
    secrets,
    sharding,
    token_records,
    wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]

# A key for tables of invented data; real keys come from a key store.
PSEUDONYM_KEY = b"key of the registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path(token_records.TOKENIZER)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_records.encode_documents(docs, tokenizer_path())


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "next_shard",
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed, facts = mixing.mix(docs, F.array("source"))
    # One row per source; their number is bounded by the operator's max_patterns.
    by_source = spark.createDataFrame(
        [(json.dumps(s) if s is None else s, s is None, n, t) for s, (n, t) in facts.items()],
        "source string, missing boolean, source_size long, target double",
    ).select(
        F.to_json(F.array(F.when(~F.col("missing"), F.col("source")))).alias("pattern"),
        "source_size",
        "target",
    )
    return mixed.join(F.broadcast(by_source), "pattern").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "words_removed",
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.BASE_RULES],
        "base_sha256",
        "spans",
    )


def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, conversations = preferences.swapped_pairs(table(spark, sf_dir, "conversations"))
    return preferences.format_pairs(pairs, conversations)


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("grp", "lang")


def op12_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.reports(conversation_repair.damage(conversations), conversations)


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_token_records,
            op2_virtual_slots,
            op3_source_mix,
            op4_decontamination,
            op5_line_frequency,
            op6_secret_scan,
            op7_preference_pairs,
            op8_pseudonyms,
            op9_repeated_passages,
            op10_jaccard_join,
            op11_collocations,
            op12_wrapper_induction,
            op13_conversation_repair,
        )
    }


# Limits are those of line_rules.LIMITS, written out so that the SQL stands alone.
OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS txt FROM documents),
split AS (
  SELECT DISTINCT host, txt,
         list_filter(string_split_regex(txt, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(txt, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs),
windows AS (
  SELECT txt, i, count(*) OVER (PARTITION BY txt, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT txt, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT DISTINCT txt, w FROM split))),
repeats AS (
  SELECT txt, CAST(sum(covered) AS BIGINT) AS n
  FROM (SELECT txt, least(3, coalesce(lead(i) OVER (PARTITION BY txt ORDER BY i) - i, 3)) AS covered
        FROM windows WHERE times > 1)
  GROUP BY txt),
facts AS (
  SELECT host, split.txt, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(split.txt, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats ON split.txt = repeats.txt),
lines AS (
  SELECT host, txt,
         regexp_replace(lower(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')),
                        '[0-9]+', '0', 'g') AS line,
         len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS n
  FROM (SELECT host, txt, unnest(l) AS x FROM facts)),
frequent AS (
  SELECT lines.host, line FROM lines
       JOIN (SELECT host, count(*) AS texts FROM facts GROUP BY host) h
         ON lines.host IS NOT DISTINCT FROM h.host
  GROUP BY lines.host, line, texts
  HAVING count(DISTINCT txt) > 10 AND count(DISTINCT txt) > 0.01 * texts),
removed AS (
  SELECT lines.host, txt, CAST(sum(n) AS BIGINT) AS words_removed
  FROM lines JOIN frequent f ON lines.host IS NOT DISTINCT FROM f.host AND lines.line = f.line
  GROUP BY lines.host, txt),
judged AS (
  SELECT f.*, coalesce(words_removed, 0) AS words_removed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM facts f LEFT JOIN removed r ON f.host IS NOT DISTINCT FROM r.host AND f.txt = r.txt)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT words_removed > 0.5 * n_words AS kept, words_removed
FROM docs JOIN judged j ON docs.host IS NOT DISTINCT FROM j.host AND docs.txt = j.txt"""


# Every pair that shares a shingle is counted here, so this is for small tables.
OP10_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM docs
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs d LEFT JOIN sizes s ON d.doc_id = s.doc_id
     JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON d.doc_id = r.a"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
phrases AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts GROUP BY 1, 2, 3 HAVING count(*) >= 30),
candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r,
         CAST(a AS HUGEINT) * 2000000 // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
       JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
       JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:c.k], ' ')),
best AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
spans AS (
  SELECT c.lang, a, array_to_string(w[s.i:s.i + s.size - 1], ' ') AS phrase
  FROM candidates c, (SELECT i, unnest([2, 3]) AS size FROM (SELECT unnest([1, 2, 3]) AS i)) s
  WHERE s.size < c.k AND s.i + s.size - 1 <= c.k),
covered AS (SELECT lang, phrase, max(a) AS longer FROM spans GROUP BY 1, 2)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN covered c ON b.lang = c.lang AND b.phrase = c.phrase
     JOIN totals t ON t.lang = b.lang
WHERE CAST(coalesce(longer, 0) AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
QUALIFY rank <= 2000"""


def _op13_sql() -> str:
    """Row by row from the end: cost, letters and repaired text of the best way from each state."""

    def option(letter: str, cost: str, line: str, goal: str, allowed: str = "true") -> str:
        return (
            f"{{'c': CASE WHEN {allowed} THEN {goal}.c + {cost} ELSE 1000000000 END, "
            f"'s': '{letter}' || {goal}.s, 't': {line} || {goal}.t}}"
        )

    def consumed(state: str, follows: str, role: str, keeps: list[tuple[str, str]]) -> str:
        kept = [option("K", "cut", "line", goal, f"NOT gone AND ini = '{x}'") for x, goal in keeps]
        relabelled = option("R", "3 + cut", f"chr(10) || '{role}:' || text", follows, "NOT gone")
        return f"list_min([{', '.join([option('D', '4', repr(''), state), *kept, relabelled])}])"

    def inserted(role: str, goal: str) -> str:
        return option("I", "3", f"chr(10) || '{role}:'", goal)

    crc_step = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda x: CAST(ord(x) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                    lambda x, i: {crc_step})), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
              ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
              md5(concat_ws(':', length(role), role, text)), copy) AS i,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS ini,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
  FROM damaged),
judged AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair,
         chr(10) || role || ':' || text AS line
  FROM placed),
lines AS (
  SELECT *, blank OR again AS gone,
         NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?]{blank}*$') AS truncated,
         CASE WHEN truncated THEN 3 ELSE 0 END AS cut
  FROM judged),
facts AS (
  SELECT conv_id, max(i) AS n,
         CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         CAST(count_if(blank) AS BIGINT) AS blank, CAST(count_if(again) AS BIGINT) AS duplicate,
         CAST(count_if(truncated) AS BIGINT) AS truncated,
         CAST(count_if(pair NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal
  FROM lines GROUP BY conv_id),
ways(conv_id, i, q, s, u, a) AS (
  SELECT conv_id, n + 1, {{'c': 0, 's': '', 't': ''}},
         {{'c': 6, 's': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}},
         {{'c': 3, 's': 'I', 't': chr(10) || 'assistant:'}}, {{'c': 0, 's': '', 't': ''}}
  FROM facts
  UNION ALL
  SELECT conv_id, i, list_min([q, {inserted("user", "u")}]), list_min([s, {inserted("user", "u")}]), u, a
  FROM (
    SELECT conv_id, i, q, s, list_min([u, {inserted("assistant", "a")}]) AS u,
           list_min([a, {inserted("user", "u")}]) AS a
    FROM (
      SELECT w.conv_id, l.i,
             {consumed("q", "u", "user", [("s", "s"), ("u", "u")])} AS q,
             {consumed("s", "u", "user", [("u", "u")])} AS s,
             {consumed("u", "a", "assistant", [("a", "a")])} AS u,
             {consumed("a", "u", "user", [("u", "u")])} AS a
      FROM (SELECT conv_id, i, q, s, u, a FROM ways) w
           JOIN lines l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.i = w.i - 1) x) y)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(w.q.c AS BIGINT), 0) AS cost,
       coalesce(w.q.s, '') AS audit, sha256(coalesce(substr(w.q.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
     LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_frequency": OP5_SQL,
        "op10_jaccard_join": OP10_SQL,
        "op11_collocations": OP11_SQL,
        "op13_conversation_repair": _op13_sql(),
    }
