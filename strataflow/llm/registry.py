"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import chat, exact_dedup, mixing, near_dedup, periodic, pii, quality, sharding, simhash, token_files, trie, url_filter
from .byte_bpe import BytePairEncoder
from .common import WORD, table, text_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op9_exact_dedup",
    r"""
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
placed AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM base)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM placed""",
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


@query("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"))


def _host_sql() -> str:
    """The verdict on hosts, rule by rule, over ``fails`` (host, n, k_<rule> summed by host)."""
    rules = list(quality.RULES)
    totals = ", ".join(f"sum(k_{r}) AS t_{r}, sum(CAST(k_{r} AS DOUBLE) * k_{r} / n) AS q_{r}" for r in rules)
    shared = ", ".join(
        f"(t_{r} + 0.5e0) / (t + 1) AS mean_{r}, "
        f"CASE WHEN t - CAST(nn AS DOUBLE) / t - (h - 1) > 0 THEN ((q_{r} - CAST(t_{r} AS DOUBLE) * t_{r} / t)"
        f" / ((t_{r} + 0.5e0) / (t + 1) * (1 - (t_{r} + 0.5e0) / (t + 1))) - (h - 1))"
        f" / (t - CAST(nn AS DOUBLE) / t - (h - 1)) ELSE 0 END AS shared_{r}"
        for r in rules
    )
    strength = ", ".join(f"mean_{r}, least(greatest(1 / greatest(shared_{r}, 1e-9) - 1, 1), 10000) AS s_{r}" for r in rules)
    rate = ", ".join(f"n + s_{r} AS w_{r}, (k_{r} + mean_{r} * s_{r}) / (n + s_{r}) AS rate_{r}" for r in rules)
    bad = " OR ".join(
        f"rate_{r} - {quality.DEVIATIONS} * sqrt(rate_{r} * (1 - rate_{r}) / (w_{r} + 1)) > {quality.LIMIT}" for r in rules
    )
    strict = ", ".join(
        f"rate_{r} - {quality.OUTSTANDING} * sqrt(rate_{r} * (1 - rate_{r}) / (w_{r} + 1)) > mean_{r} AS strict_{r}" for r in quality.STRICT
    )
    return f"""
totals AS (SELECT sum(n) AS t, sum(n * n) AS nn, count(*) AS h, {totals} FROM hosts),
shared AS (SELECT {shared} FROM totals),
priors AS (SELECT {strength} FROM shared),
rates AS (SELECT host, {rate}, {", ".join(f"mean_{r}" for r in rules)} FROM hosts, priors),
flags AS (SELECT host, ({bad}) AS rejected, {strict} FROM rates)"""


_QUALITY_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
measures AS (
  SELECT doc_id, host, CAST(len(ws) AS BIGINT) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
hosts AS (
  SELECT host, count(*) AS n, {", ".join(f"count(*) FILTER ({rule}) AS k_{r}" for r, rule in quality.RULES.items())}
  FROM measures WHERE host IS NOT NULL GROUP BY host),{_host_sql()},
verdicts AS (
  SELECT *, ({quality.RULES["few_words"]}) OR ({quality.RULES["repeated_words"]}) AS base_failed,
         coalesce(rejected{"".join(f" OR strict_{r} AND ({quality.RULES[r]})" for r in quality.STRICT)}, false) AS host_failed
  FROM measures LEFT JOIN flags USING (host))
SELECT doc_id, {", ".join(quality.MEASURES)}, base_failed, host_failed, NOT base_failed AND NOT host_failed AS kept
FROM verdicts"""


@query("op2_quality_rules", _QUALITY_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = BytePairEncoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", codec.encode(F.coalesce("text", F.lit(""))).alias("ids"))
    docs = docs.withColumn("decoded", codec.decode("ids"))
    return docs.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assigned(table(spark, sf_dir, "documents"))


@query("op6_token_orc")
def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = token_files.word_ids(spark, F.col("text"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = fresh_path(spark, "tokens")
    token_files.write_tokens(docs, path, int(spark.conf.get("spark.sql.shuffle.partitions")), ids)
    return token_files.catalogue(spark, path)


URL_RULES = {  # fixed values of the contract
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


@query(
    "op7_url_filter",
    r"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^?#]*') AS whole FROM rests),
urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(whole, length(raw) + 1) AS path FROM parts),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM urls LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best""",
)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def _mix_sql(mix: mixing.Mix) -> str:
    """Water-filling level by level, then the prefix of each leaf by one running sum."""
    levels = list(mix.tree)
    parts = [
        "rows AS (SELECT doc_id, "
        + ", ".join(f"{column} AS {level}" for level, column in mix.tree.items())
        + r", CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents)",
        f"leaves AS (SELECT {', '.join(levels)}, sum(n_tokens) AS tokens, sum(n_tokens) * {mix.epochs} AS cap FROM rows GROUP BY ALL)",
        f"level_0 AS (SELECT 0 AS root, coalesce(sum(tokens), 0) * {mix.percent} // 100 AS budget FROM leaves)",
    ]
    for i, level in enumerate(levels, 1):
        keys, known = ["root", *levels[:i]], ["root", *levels[: i - 1]]
        weights = "".join(f" WHEN n.{level} = '{v}' THEN {w}" for v, w in mix.weights.get(level, {}).items())
        match = " AND ".join(f"n.{key} IS NOT DISTINCT FROM p.{key}" for key in known)
        parts += [
            f"nodes_{i} AS (SELECT n.*, p.budget, {f'CASE{weights} ELSE 1 END' if weights else '1'} AS w FROM "
            f"(SELECT 0 AS root, {', '.join(levels[:i])}, sum(cap) AS cap FROM leaves GROUP BY ALL) n JOIN level_{i - 1} p ON {match})",
            f"sums_{i} AS (SELECT *, sum(w) OVER (PARTITION BY {', '.join(known)}) AS all_w, "
            f"coalesce(sum(w) OVER b, 0) AS w_before, coalesce(sum(cap) OVER b, 0) AS cap_before FROM nodes_{i} WINDOW b AS "
            f"(PARTITION BY {', '.join(known)} ORDER BY cap / w, {', '.join(keys)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
            f"out_{i} AS (SELECT *, cap * (all_w - w_before) <= w * (budget - cap_before) AS full_up FROM sums_{i})",
            f"level_{i} AS (SELECT {', '.join(keys)}, CASE WHEN full_up THEN cap ELSE ((budget - coalesce(sum(cap) FILTER (full_up) "
            f"OVER p, 0)) * w) // greatest(all_w - coalesce(sum(w) FILTER (full_up) OVER p, 0), 1) END AS budget "
            f"FROM out_{i} WINDOW p AS (PARTITION BY {', '.join(known)}))",
        ]
    same = " AND ".join(f"a.{level} IS NOT DISTINCT FROM b.{level}" for level in levels)
    parts += [
        "shares AS (SELECT a.*, CASE WHEN a.tokens = 0 THEN 1 ELSE b.budget // a.tokens END AS full_epochs, "
        f"CASE WHEN a.tokens = 0 THEN 0 ELSE b.budget % a.tokens END AS rest FROM leaves a JOIN level_{len(levels)} b ON {same})",
        f"ends AS (SELECT a.*, b.full_epochs, b.rest, sum(a.n_tokens) OVER (PARTITION BY {', '.join('a.' + c for c in levels)} "
        f"ORDER BY md5('{mix.seed}:' || b.full_epochs::BIGINT || ':' || a.doc_id), a.n_tokens ROWS UNBOUNDED PRECEDING) AS e "
        f"FROM rows a JOIN shares b ON {same})",
    ]
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, {", ".join(levels)}, n_tokens,
       CAST(unnest(range(CAST(full_epochs + CASE WHEN rest > 0 AND e <= rest THEN 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS epoch
FROM ends"""
    )


@query("op8_mixing", _mix_sql(mixing.DOCUMENTS))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.drawn(table(spark, sf_dir, "documents"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.found(docs, pii.train(docs))
    digest = F.sha2(F.col("base"), 256).alias("base_sha256")
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans")


@query(
    "op4_chat_format",
    r"""
WITH ask AS (SELECT conv_id, turn + 1 AS turn, min(text) AS question FROM conversations GROUP BY ALL),
turns AS (
  SELECT c.*, a.question, e.turn IS NOT NULL AS earlier, 'call_' || c.conv_id || '_' || c.turn AS call_id
  FROM conversations c LEFT JOIN ask a USING (conv_id, turn)
       LEFT JOIN (SELECT DISTINCT conv_id, turn + 2 AS turn FROM conversations WHERE role = 'assistant') e USING (conv_id, turn)
  WHERE role = 'assistant'),
lines AS (
  SELECT conv_id, turn, 0 AS depth, 'message' AS kind, role, NULL AS call_id, CAST(NULL AS BOOLEAN) AS linked,
         CAST(NULL AS BOOLEAN) AS valid, '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS line
  FROM conversations WHERE role <> 'assistant'
  UNION ALL
  SELECT conv_id, turn, 0, 'call', role, call_id, true, question IS NOT NULL,
         '{"role":"assistant","tool_calls":[{"arguments":{'
         || CASE WHEN earlier THEN '"after":{"$ref":"call_' || conv_id || '_' || (turn - 2) || '"},' ELSE '' END
         || '"limit":' || length(text) || CASE WHEN question IS NULL THEN '' ELSE ',"question":' || to_json(question) END
         || '},"id":"' || call_id || '","name":"answer"}]}'
  FROM turns
  UNION ALL
  SELECT conv_id, turn, 1, 'result', 'tool', call_id, true, NULL,
         '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"' || call_id || '"}'
  FROM turns)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, depth, kind, role) - 1 AS position,
       role, kind, call_id, linked, valid, line FROM lines""",
)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.with_calls(table(spark, sf_dir, "conversations")), chat.ANSWER)


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda x: CAST(ord(x) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0,1,2,3,4,5,6,7] AS BIGINT[])),
           lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""


@query(
    "op12_conversation_trie",
    f"""
WITH own AS (
  SELECT conv_id, g, points, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) - 1 AS place
  FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS g,
               length(coalesce(text, '')) AS points FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT conv_id, count(*) AS own, {_CRC32} % 6 AS h, conv_id - conv_id % 100 AS base FROM own GROUP BY conv_id),
members AS (
  SELECT s.conv_id, s.base, s.h, least(s.h, coalesce(b.own, 0)) AS lent, greatest(s.own - s.h, 0) AS rest
  FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base),
laid AS (
  SELECT m.conv_id, place + 1 AS depth, g, points FROM members m JOIN own o ON o.conv_id = m.base WHERE place < lent
  UNION ALL
  SELECT m.conv_id, place - h + lent + 1, g, points FROM members m JOIN own o ON o.conv_id = m.conv_id WHERE place >= h
  UNION ALL SELECT conv_id, 0, '', 0 FROM members),
known AS (SELECT conv_id, depth, points, string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM laid),
paths AS (SELECT conv_id, depth, points, min(conv_id) OVER p AS node, count(*) OVER p AS n FROM known WINDOW p AS (PARTITION BY depth, prefix)),
nodes AS (
  SELECT p.conv_id, p.depth, u.node AS parent, p.n, (p.n - 1) * p.points AS saved
  FROM paths p LEFT JOIN paths u ON u.conv_id = p.conv_id AND u.depth = p.depth - 1 WHERE p.node = p.conv_id),
children AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
leaves AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (conv_id, depth)),
sums AS (
  SELECT p.node AS conv_id, p.depth, count(*) FILTER (l.n_children = 0) AS n_leaves, sum(l.saved) AS saved_tokens
  FROM leaves l JOIN paths p ON p.conv_id = l.conv_id AND p.depth <= l.depth GROUP BY ALL),
over AS (
  SELECT p.node AS conv_id, p.depth, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
  FROM paths p JOIN members m ON m.conv_id = p.conv_id AND p.depth = m.lent + m.rest GROUP BY ALL)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM leaves JOIN sums USING (conv_id, depth) LEFT JOIN over USING (conv_id, depth)""",
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of every tenth hash of an id the text repeats its words from some word on, as the contract has it."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    docs = docs.withColumn("own", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("own"))
    docs = docs.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("CAST(g % greatest(n, 1) AS INT)"))
    docs = docs.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    repeated = F.expr("array_join(transform(own, (w, i) -> if(i < a, w, own[a + (i - a) % p])), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _made_periodic(table(spark, sf_dir, "documents"))
    text_batches(spark)
    found = docs.select("doc_id", periodic.found_in(F.col("text")).alias("f")).select("doc_id", "f.runs", "f.collapsed")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")]))
    lines = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    found = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    longest = {"start": -F.col("best.col2"), "length": F.col("best.length"), "period": -F.col("best.col3")}
    found = found.withColumns(longest).withColumn("exponent_milli", F.expr("1000 * length div period"))
    return found.select("doc_id", "n_runs", *longest, "exponent_milli", "runs_sha256", "collapsed_sha256")
