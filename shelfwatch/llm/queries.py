"""One registered query per operator over its whole table, with checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import bpe, collocations, conversations, language_id, minhash, mixing, paragraph_sketch, quality_rules, secret_scan, sharding, simhash, toxicity, url_filter
from shelfwatch.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _url_sql() -> str:
    def longest(rules, fits):
        order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
        return " ".join(f"WHEN {fits(rules[i])} THEN '{rules[i].name}'" for i in order)

    base = longest(
        url_filter.BASE,
        lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')",
    )
    patterns = longest(url_filter.PATTERNS, lambda r: f"strpos(low, '{r.pattern}') > 0")
    allowed = ", ".join(f"'{r.name}'" for r in url_filter.BASE if r.verdict == "allow")
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rests AS (
  SELECT page_id, {lower.format("coalesce(url, '')")} AS low,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id, low, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM rests
),
fitted AS (SELECT *, CASE {base} END AS rule, CASE {patterns} END AS any_pattern FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({allowed}) THEN 'allow' WHEN rule IS NOT NULL OR any_pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN any_pattern END AS pattern
FROM fitted
"""


ORACLES["op2_url_filter"] = _url_sql()


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.rows_of(plan).selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken", "copies", "source")


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op5_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paragraph_sketch.fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(language_id.fold("doc_id", 5) == 0, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")

    def joined(which: str):
        return f"array_join(transform(filter(spans, s -> {which}), s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.expr(f"sha2({joined("s.kind != 'literal'")}, 256)").alias("base_sha256"),
        F.expr(joined("true")).alias("spans"),
    )


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), "v2")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (rows.fail_bits.bitwiseAND(quality_rules.mask("base")) != 0).alias("base_failed"), "kept", "fail_bits",
    )


def _quality_sql() -> str:
    gap = r"[\x20\x09-\x0D]"
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(quality_rules.RULES.values()))
    return rf"""
WITH base AS (
  SELECT rowid AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
),
spots AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM base WHERE len(w) >= 3
),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n FROM spots
),
repeated AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n > 1) GROUP BY r
),
measured AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    len(list_filter(l, lambda x: regexp_matches(x, '^{gap}*[-*•]'))) AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…){gap}*$'))) AS n_cut_lines
  FROM base LEFT JOIN repeated USING (r)
),
judged AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM judged
"""


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded")
    return rows.selectExpr(
        "doc_id", "cast(octet_length(ids) div 4 as bigint) as n_tokens", "sha2(ids, 256) as ids_sha256",
        "sha2(cast(decoded as binary), 256) as decoded_sha256",
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language_id.fold("doc_id", 3) == 1, F.lit(False))
    model = language_id.learn(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(conversations.repair(conversations.damage(rows)), rows)


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"), least=30, longest=4, covered=80, top=2000)


ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
lines AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM lines, range(1, 5) AS lengths(k) WHERE len(w) >= k)
),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT lang, k, phrase, f, c, array_to_string(w[:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)
),
scored AS (
  SELECT u.lang, u.phrase, u.f AS a, h.f AS l, t.f AS r, ((2000000::HUGEINT * u.f) // (h.f + t.f))::BIGINT AS score,
    row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY (2000000::HUGEINT * u.f) // (h.f + t.f), c) AS pick
  FROM cuts u JOIN counts h ON h.lang = u.lang AND h.phrase = u.head JOIN counts t ON t.lang = u.lang AND t.phrase = u.tail
),
inner_parts AS (
  SELECT lang, f AS longer, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS s FROM candidates, range(2, 4) AS sizes(m) WHERE m < k)
),
covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_parts i USING (lang, phrase) WHERE 100::HUGEINT * i.longer >= 80::HUGEINT * c.f
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM scored WHERE pick = 1 AND (lang, phrase) NOT IN (SELECT (lang, phrase) FROM covered)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

@query
def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=5, percent=85)


ORACLES["op13_minhash_near_dedup"] = r"""
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) END) AS s
  FROM rows_
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT x.r AS a, y.r AS b, count(*) AS i FROM shingles x JOIN shingles y ON x.s = y.s AND x.r < y.r GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * i >= 85 * (p.n + q.n - i)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM rows_ UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
least AS (SELECT reach.a AS r, min(rows_.doc_id) AS component_id FROM reach JOIN rows_ ON rows_.r = reach.b GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

ORACLES["op8_quality_rules"] = _quality_sql()
