"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerwatch.llm import chat, decontaminate, html_text, jaccard_join, mixing, packing, quality, repair, runs, stand_ins, token_files, topk, toxicity, url_filter
from partnerwatch.llm.common import LOWER, UPPER, table

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled_vectors(table(spark, sf_dir, "embeddings"), scale=256)
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(table(spark, sf_dir, "documents"), tokenizer_path(), by_word=True)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components_of(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(planted)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(stand_ins.with_repeating_tails(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    placed = repair.placed_rows(stand_ins.damaged_turns(turns))
    found = repair.diagnoses(placed)
    parts = [repair.turn_gaps(placed), found, repair.digests(repair.repaired_turns(placed, found))]
    out = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in parts:
        part = part.withColumnRenamed("conv_id", "__conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_filter": op5_url_filter,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_chat_format": op10_chat_format,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

_OP1 = """
WITH v AS (
  SELECT vec_id, min([greatest(least(floor(256 * x::DOUBLE), 9223372036854774784.0), -9223372036854775808.0) FOR x IN embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum([q.v[i]::BIGINT * c.v[i]::BIGINT FOR i IN range(1, least(len(q.v), len(c.v)) + 1)]), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-2|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|'
                         || row_number() OVER (PARTITION BY doc_id, coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE / 281474976710656 AS coin
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), tight AS (
  SELECT *, sum(3 * source_size) OVER w - 3 * source_size AS cut, sum(weight) OVER (ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - sum(weight) OVER w + weight AS left_weight,
         sum(source_size) OVER (ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS total
  FROM sums WINDOW w AS (ORDER BY 3 * source_size::DOUBLE / weight, source ROWS UNBOUNDED PRECEDING)
), level AS (  -- the first source, by capacity over weight, that the sharing does not fill
  SELECT coalesce((SELECT arg_min((total - cut)::DOUBLE / left_weight::DOUBLE, 3 * source_size::DOUBLE / weight) FROM tight
                   WHERE 3 * source_size * left_weight > (total - cut) * weight), 0) AS lam
), targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, lam * weight) AS target FROM sums, level
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate FROM targets
)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + (coin < rate - floor(rate))::BIGINT) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""

_OP5 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest
), hosts AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, path FROM parts
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule
  FROM hosts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

_OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), told AS (
  SELECT *, length(text) + length(regexp_extract_all(text, '###|</turn>')) + length(role) + 15 AS piece FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(piece)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""



def _op13_sql() -> str:
    """The dynamic program row by row: an entry is an eight-digit cost and the audit."""

    def plus(entry: str, cost: str, letter: str) -> str:
        return f"CASE WHEN {entry} = '~' THEN '~' ELSE printf('%08d', substr({entry}, 1, 8)::INTEGER + {cost}) || substr({entry}, 9) || '{letter}' END"

    def step(end: str, letter: str | None, sources: tuple[str, ...]) -> str:
        ways = [plus(f"v.{end}", "3", "D")]
        for source in sources:
            if letter != "s":
                ways.append(f"CASE WHEN gone THEN '~' ELSE {plus(f'v.{source}', '2 + late', 'R')} END")
            ways.append(f"CASE WHEN gone OR letter <> '{letter}' THEN '~' ELSE {plus(f'v.{source}', 'late', 'K')} END")
        return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]

    return rf"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8
), fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295] || [ord(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
                         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS fate
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, range(2) copy(k) WHERE fate <> 0 AND (k = 0 OR fate = 3)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
), faulty AS (
  SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS letter,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN again THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE '-' END AS fault
  FROM ordered
), symbols AS (
  SELECT *, fault IN ('b', 'd') AS gone, (fault = 't')::INTEGER AS late,
         lag(letter) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM faulty
), best AS (
  SELECT conv_id, 0::BIGINT AS i, '00000000' AS z, '~' AS s, '00000002I' AS u, '00000004II' AS a FROM (SELECT DISTINCT conv_id FROM faulty)
  UNION ALL
  SELECT conv_id, i, z, s, u2, least(a, {plus('u2', '2', 'I')})
  FROM (
    SELECT *, least(u, {plus('z', '2', 'I')}, {plus('s', '2', 'I')}, {plus('a', '2', 'I')}) AS u2
    FROM (
      SELECT v.conv_id, r.i, {step('z', None, ())} AS z, {step('s', 's', ('z',))} AS s, {step('u', 'u', ('z', 's', 'a'))} AS u, {step('a', 'a', ('u',))} AS a
      FROM best v JOIN symbols r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i + 1
    )
  )
), solved AS (
  SELECT conv_id, substr(least(z, a), 1, 8)::BIGINT AS cost, substr(least(z, a), 9) AS audit
  FROM best QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM solved)
), edits AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS m
  FROM letters
), written AS (
  SELECT e.conv_id, p, m, edit, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, CASE WHEN edit = 'K' THEN role END AS role,
         max((m = 1 AND edit = 'K' AND letter = 's')::INTEGER) OVER (PARTITION BY e.conv_id) AS system
  FROM edits e LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE edit <> 'D'
), hashed AS (
  SELECT conv_id, sha256(string_agg(coalesce(role, CASE WHEN (m - system) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY p)) AS repaired_sha256
  FROM written GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND previous || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM symbols GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


ORACLES: dict[str, str] = {"op1_top_k": _OP1, "op3_mixing": _OP3, "op5_url_filter": _OP5, "op10_chat_format": _OP10, "op13_conversation_repair": _op13_sql()}
