"""Queries over chat rendering, tokens and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import chat, responses, text, tokens
from pairloom.plans.dialect import normal_sql, stripped
from pairloom.runtime import read_table, spread_table

MAX_TOKENS, OVERLAP = 200, 50


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = read_table(spark, sf_dir, "generated_examples")
    user = chat.user_content(F.col("natural_language"), F.col("schema"), F.col("difficulty"))
    return ex.select("example_id", user.alias("user"), chat.conversation(user, F.coalesce("sql", F.lit(""))).alias("turns"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("example_id", F.explode("turns").alias("t")).select("example_id", "t.role", "t.content")


def chat_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir).select("example_id", F.explode(chat.shared_turns(F.col("turns"))).alias("t"))
    return rows.select("example_id", F.col("t.from").alias("sender"), F.col("t.value").alias("value"))


def chat_prompt_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("example_id", chat.prompt_text(F.col("user")).alias("prompt"), F.col("turns")[2]["content"].alias("completion"))


def _rendered(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _turns(spark, sf_dir).select("example_id", chat.render(F.col("turns"), name).alias("text"))

    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(spark, sf_dir, "documents", ["doc_id", "text"])


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", F.size(tokens.word_tokens(docs)).alias("n"))


def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_stats(_counts(spark, sf_dir), F.col("n"))


def token_length_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_report(_counts(spark, sf_dir), F.col("n"), MAX_TOKENS)


def token_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).filter(F.col("n") > MAX_TOKENS)


def _cut(strategy: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = _documents(spark, sf_dir)
        rows = tokens.chunked(docs.select("doc_id", tokens.word_tokens(docs).alias("ids")), "ids", MAX_TOKENS, OVERLAP, strategy)
        return rows.select("doc_id", "chunk", F.size("ids").alias("n_tokens"), F.md5(F.array_join("ids", " ")).alias("digest"))

    return run


def normalized_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "generated_examples").select("example_id", text.normalize_sql(F.coalesce("sql", F.lit(""))).alias("sql"))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "generated_examples").select("example_id", text.fingerprint(["natural_language", "sql"]).alias("fingerprint"))


def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select("p_partkey", text.slug(F.concat_ws(" / ", "p_name", "p_brand", "p_type")).alias("slug"))


def benchmark_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "seeds").select("seed_id", text.benchmark_prompt(F.coalesce("natural_language", F.lit(""))).alias("prompt"))


def served_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.coalesce("sql", F.lit(""))
    return read_table(spark, sf_dir, "generated_examples").select("example_id", responses.served_sql(c).alias("served"), text.first_line(c).alias("first_line"), responses.extracted_sql(c).alias("extracted"))


def quality_scores_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.format_string('{"score": %s, "reason": "k"}', F.col("value").cast("string"))
    return read_table(spark, sf_dir, "events").select("event_id", responses.quality_score(F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), lines, F.lit("\n```"))).otherwise(lines)).alias("score"))


def few_shot_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = read_table(spark, sf_dir, "seeds").select("seed_id", F.array(F.struct(F.coalesce("natural_language", F.lit("")).alias("natural_language"), F.coalesce("sql", F.lit("")).alias("sql"), "difficulty")).alias("e"))
    return seeds.select("seed_id", chat.few_shot(F.col("e"), "numbered").alias("numbered"), chat.few_shot(F.col("e"), "labelled").alias("labelled"))


QUERIES = {
    f.__name__: f
    for f in (
        chat_messages, chat_shared, chat_prompt_completion, token_stats, token_length_report, token_oversize, normalized_sql, fingerprints, slugs,
        benchmark_prompts, served_sql, quality_scores_parsed, few_shot_block,
    )
}
QUERIES |= {f"chat_{n}": _rendered(n) for n in chat.RENDER} | {f"token_{s}": _cut(s) for s in ("truncate", "drop", "split")}

SYSTEM = "'" + chat.SYSTEM_PROMPT.replace("'", "''") + "'"
USER = """((CASE WHEN coalesce(schema, '') <> '' THEN 'Schema:' || chr(10) || schema || chr(10) || chr(10) ELSE '' END) || coalesce(natural_language, '')
  || (CASE WHEN difficulty IS NOT NULL THEN chr(10) || chr(10) || '[Difficulty: ' || difficulty || ']' ELSE '' END))"""
BASE = f"(SELECT example_id, {USER} AS u, coalesce(sql, '') AS a FROM generated_examples)"
TOKENS = r"(SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ids FROM documents)"
DIGEST = "len(part) AS n_tokens, md5(array_to_string(part, ' ')) AS digest"
RAW = "coalesce(sql, '')"
TRIMMED = stripped(RAW)

SQL = {
    "chat_messages": f"SELECT example_id, 'system' AS role, {SYSTEM} AS content FROM {BASE} UNION ALL SELECT example_id, 'user', u FROM {BASE} UNION ALL SELECT example_id, 'assistant', a FROM {BASE}",
    "chat_shared": f"SELECT example_id, 'system' AS sender, {SYSTEM} AS value FROM {BASE} UNION ALL SELECT example_id, 'human', u FROM {BASE} UNION ALL SELECT example_id, 'gpt', a FROM {BASE}",
    "chat_prompt_completion": f"SELECT example_id, {SYSTEM} || chr(10) || chr(10) || u AS prompt, a AS completion FROM {BASE}",
    "chat_llama": f"""SELECT example_id, '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || {SYSTEM} || '<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || u
      || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || a || '<|eot_id|>' AS text FROM {BASE}""",
    "chat_mistral": f"SELECT example_id, '<s>[INST] ' || {SYSTEM} || chr(10) || chr(10) || u || ' [/INST]' || a || '</s>' AS text FROM {BASE}",
    "chat_phi": f"""SELECT example_id, '<|system|>' || chr(10) || {SYSTEM} || '<|end|>' || chr(10) || '<|user|>' || chr(10) || u || '<|end|>' || chr(10) || '<|assistant|>' || chr(10) || a || '<|end|>' AS text FROM {BASE}""",
    "token_stats": f"""SELECT count(*) AS n, min(len(ids))::INT AS min_tokens, max(len(ids))::INT AS max_tokens, round(avg(len(ids)), 1) AS mean_tokens, round(quantile_cont(len(ids), 0.5), 1) AS median_tokens,
      round(quantile_cont(len(ids), 0.9), 1) AS p90, round(quantile_cont(len(ids), 0.95), 1) AS p95, round(quantile_cont(len(ids), 0.99), 1) AS p99 FROM {TOKENS}""",
    "token_length_report": f"SELECT count(*) AS n, count(*) FILTER (len(ids) <= {MAX_TOKENS}) AS n_within, count(*) FILTER (len(ids) > {MAX_TOKENS}) AS n_over, round(100.0 * count(*) FILTER (len(ids) > {MAX_TOKENS}) / count(*), 2)::DOUBLE AS pct_over FROM {TOKENS}",
    "token_oversize": f"SELECT doc_id, len(ids)::INT AS n FROM {TOKENS} WHERE len(ids) > {MAX_TOKENS}",
    "token_truncate": f"SELECT doc_id, 0 AS chunk, len(part)::INT AS n_tokens, md5(array_to_string(part, ' ')) AS digest FROM (SELECT doc_id, ids[1:{MAX_TOKENS}] AS part FROM {TOKENS})",
    "token_drop": f"SELECT doc_id, 0 AS chunk, len(ids)::INT AS n_tokens, md5(array_to_string(ids, ' ')) AS digest FROM {TOKENS} WHERE len(ids) <= {MAX_TOKENS}",
    "token_split": f"""SELECT doc_id, (s // {MAX_TOKENS - OVERLAP})::INT AS chunk, len(part)::INT AS n_tokens, md5(array_to_string(part, ' ')) AS digest FROM (SELECT doc_id, s, ids[s + 1:s + {MAX_TOKENS}] AS part
      FROM (SELECT doc_id, ids, unnest(CASE WHEN len(ids) <= {MAX_TOKENS} THEN [0] ELSE range(0, len(ids), {MAX_TOKENS - OVERLAP}) END) AS s FROM {TOKENS}))""",
    "normalized_sql": f"SELECT example_id, {normal_sql(RAW)} AS sql FROM generated_examples",
    "fingerprints": "SELECT example_id, sha256(coalesce(natural_language, '') || chr(0) || coalesce(sql, '')) AS fingerprint FROM generated_examples",
    "slugs": "SELECT p_partkey, regexp_replace(regexp_replace(lower(concat_ws(' / ', p_name, p_brand, p_type)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part",
    "benchmark_prompts": "SELECT seed_id, 'Convert the following natural language question into a SQL query.' || chr(10) || 'Output ONLY the SQL query, with no explanation or markdown formatting.' || chr(10) || chr(10) || 'Question: ' || coalesce(natural_language, '') || chr(10) || chr(10) || 'SQL:' AS prompt FROM seeds",
    "served_sql": rf"""SELECT example_id, CASE WHEN b <> '' AND NOT ends_with(b, ';') THEN b || ';' ELSE b END AS served, {stripped("split_part(t, chr(10), 1)")} AS first_line,
      {stripped(r"CASE WHEN regexp_matches(t, '(?is)```(?:sql)?\s*.*?\s*```') THEN regexp_extract(t, '(?is)```(?:sql)?\s*(.*?)\s*```', 1) ELSE regexp_replace(t, '(?i)^(?:sql|query)\s*[:\-]\s*', '') END")} AS extracted
      FROM (SELECT example_id, t, CASE WHEN starts_with(t, '```') THEN {stripped("array_to_string(list_filter(regexp_split_to_array(t, '\\r\\n|\\n|\\r'), lambda x: NOT starts_with(" + stripped("x") + ", '```')), chr(10))")} ELSE t END AS b
        FROM (SELECT example_id, {TRIMMED} AS t FROM generated_examples))""",
    "quality_scores_parsed": "SELECT event_id, CASE WHEN value IS NULL THEN 3.0 ELSE least(greatest(value, 1.0), 5.0) END AS score FROM events",
    "few_shot_block": """SELECT seed_id, 'Example 1:' || chr(10) || '  Question: ' || coalesce(natural_language, '') || chr(10) || '  SQL: ' || coalesce(sql, '') || CASE WHEN coalesce(difficulty, '') <> '' THEN chr(10) || '  Difficulty: ' || difficulty ELSE '' END AS numbered,
      'NL: ' || coalesce(natural_language, '') || chr(10) || 'SQL: ' || coalesce(sql, '') AS labelled FROM seeds""",
}
