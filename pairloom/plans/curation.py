"""Queries over deduplication, filters, balancing and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import value_key
from pairloom.operators import balance, dedup, filters, split
from pairloom.plans.dialect import stripped
from pairloom.runtime import read_table, spread_table

PAIR = ["natural_language", "sql"]
TARGETS = {"easy": 0.4, "medium": 0.4, "hard": 0.1, "expert": 0.1}
RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}
SEED = 42


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "generated_examples")


def curation_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup.exact_dedup(read_table(spark, sf_dir, "documents"), ["text"], "doc_id")
    kept = docs.filter(filters.length_within(["text"], 50, 10_000))
    return balance.distribution(kept, "lang")


def exact_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(_examples(spark, sf_dir), PAIR, "example_id").select("example_id", *PAIR)


def exact_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(_examples(spark, sf_dir), ["sql"], "example_id", keep="last").select("example_id", "sql")


def fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash_links(spread_table(spark, sf_dir, "generated_examples", ["example_id", "natural_language"]), "natural_language", "example_id")


def fuzzy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread_table(spark, sf_dir, "generated_examples", ["example_id", "natural_language"])
    return dedup.fuzzy_dedup(rows, "natural_language", "example_id").select("example_id", "natural_language")


def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).filter(filters.length_within(PAIR, 20, 400)).select("example_id")


def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).filter(filters.has_keywords()).select("example_id")


def score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).filter(filters.score_at_least()).select("example_id", F.when(F.isnan("score"), None).otherwise(F.col("score")).alias("score"))


def sql_valid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).filter(filters.sql_present()).select("example_id")


def filter_chain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.FilterChain(_examples(spark, sf_dir)).length(PAIR, 20, 400).sql_valid().keywords().score().counts()


def filter_by_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "seeds").filter((F.col("difficulty") == "easy") & (F.col("category") == "select")).select("seed_id", "difficulty", "category")


def unsafe_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).filter(filters.unsafe(F.col("sql"), allow_writes=False)).select("example_id")


def heuristic_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = filters.heuristic_issues(F.col("natural_language"), F.col("sql"))
    return spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR]).select("example_id", F.array_join(issues, " | ").alias("issues")).filter("issues <> ''")


def syntax_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir).select("example_id", filters.syntax_issue(F.col("sql")).alias("issue")).filter("issue is not null")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = filters.quality(F.col("natural_language"), F.col("sql"), F.when(~F.isnan("score"), F.col("score")))
    rows = spread_table(spark, sf_dir, "generated_examples", [*PAIR, "score", "category"]).select(value_key("category").alias("category"), q.alias("q"))
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.count_if("q.heuristic_ok").alias("n_heuristic"), F.count_if("q.syntax_ok").alias("n_syntax"), F.count_if("q.passed").alias("n_passed"))


def numeric_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.numeric_entries(_examples(spark, sf_dir), "example_id", "metadata").withColumnRenamed("id", "example_id")


def _balance(strategy: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return balance.target_counts(_examples(spark, sf_dir), "difficulty", TARGETS, strategy)

    return run


def _rebalanced(strategy: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = balance.rebalance(_examples(spark, sf_dir).select("example_id", "difficulty"), "difficulty", TARGETS, F.col("example_id"), strategy, SEED)
        return rows if strategy == "downsample" else rows.groupBy("difficulty").agg(F.count("*").alias("n"), F.countDistinct("example_id").alias("n_ids"))

    return run


def balance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.distribution(_examples(spark, sf_dir), "category")


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.value_counts(read_table(spark, sf_dir, "seeds"), "difficulty")


def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split(_examples(spark, sf_dir).select("example_id"), F.col("example_id"), RATIOS, seed=SEED)


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split(_examples(spark, sf_dir).select("example_id", "category"), F.col("example_id"), RATIOS, "category", SEED)


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_stats(split_stratified(spark, sf_dir), "split", "category")


def few_shot_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.few_shot(read_table(spark, sf_dir, "seeds"), 10, F.col("seed_id"), "difficulty", difficulty="hard", seed=SEED)
    return rows.select("seed_id", "difficulty")


def few_shot_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.few_shot(read_table(spark, sf_dir, "seeds"), 10, F.col("seed_id"), seed=SEED).select("seed_id")


def few_shot_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.few_shot(read_table(spark, sf_dir, "seeds"), 10, F.col("seed_id"), "category", category="join", seed=SEED).select("seed_id", "category")


def seed_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five seeds for the prompt of each job."""
    seeds, jobs = read_table(spark, sf_dir, "seeds").select("seed_id"), read_table(spark, sf_dir, "generation_jobs").select("job_id")
    return split.seed_subsets(seeds, jobs, "job_id", F.col("seed_id"), 5, SEED).select("request", "nth", "seed_id")


def first_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.first_rows(_examples(spark, sf_dir), "example_id", 20).select("example_id", "category")


def unknown_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.unknown_categories(_examples(spark, sf_dir), "difficulty", TARGETS)


def quality_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = filters.quality(F.col("natural_language"), F.col("sql"), F.when(~F.isnan("score"), F.col("score")))
    rows = spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR, "score"])
    return rows.select("example_id", q.alias("q")).select("example_id", filters.quality_summary(F.col("q")).alias("summary"))


QUERIES = {
    f.__name__: f
    for f in (
        curation_by_language, exact_dedup_first, exact_dedup_last, fuzzy_pairs, fuzzy_dedup, length_filter, keyword_filter, score_filter, sql_valid_filter,
        filter_chain_counts, filter_by_labels, unsafe_statements, heuristic_issues, syntax_issues, quality_counts, numeric_metadata, balance_report,
        value_counts, split_random, split_stratified, split_stats, few_shot_examples, few_shot_random, few_shot_category, seed_subsets, first_examples,
        unknown_categories, quality_summaries,
    )
}
QUERIES |= {f"balance_counts_{s}": _balance(s) for s in balance.STRATEGIES} | {f"rebalance_{s}": _rebalanced(s) for s in balance.STRATEGIES}

WANTED = "(VALUES ('easy', 0.4), ('medium', 0.4), ('hard', 0.1), ('expert', 0.1)) w(category, share)"
NL, Q = "coalesce(natural_language, '')", "coalesce(sql, '')"
PARENS = f"(length({Q}) - length(replace({Q}, '(', ''))) <> (length({Q}) - length(replace({Q}, ')', '')))"
ISSUES = f"""list_filter([
  CASE WHEN length({NL}) < 10 THEN 'NL too short (' || length({NL}) || ' < 10)' END,
  CASE WHEN length({NL}) > 500 THEN 'NL too long (' || length({NL}) || ' > 500)' END,
  CASE WHEN length({Q}) < 10 THEN 'SQL too short (' || length({Q}) || ' < 10)' END,
  CASE WHEN length({Q}) > 2000 THEN 'SQL too long (' || length({Q}) || ' > 2000)' END,
  CASE WHEN NOT regexp_matches({Q}, '(?i)select|insert|update|delete|create|alter|drop|with') THEN 'SQL missing standard keywords (SELECT/INSERT/UPDATE/DELETE/WITH)' END,
  CASE WHEN regexp_matches({stripped(NL)}, '^(?i)(select|insert|update|delete|with) ') THEN 'NL looks like raw SQL, not natural language' END,
  CASE WHEN regexp_matches({NL}, '(?i)\\{{\\{{|\\}}\\}}|<placeholder>') THEN 'NL contains template placeholders' END,
  CASE WHEN {PARENS} THEN 'SQL has unbalanced parentheses' END
], lambda x: x IS NOT NULL)"""
SYNTAX = f"""CASE WHEN {stripped(Q)} = '' THEN 'SQL holds no statement'
  WHEN (length({Q}) - length(replace({Q}, '''', ''))) % 2 <> 0 THEN 'SQL has unclosed string literal'
  WHEN regexp_matches({stripped(Q)}, ',[\\s\\p{{Z}}]*;*$') THEN 'SQL ends with a trailing comma' END"""
KEEP_SCORE = "(score IS NULL OR (score::VARCHAR <> 'nan' AND score >= 3.0))"
KEEP_LENGTH = f"(length({NL}) BETWEEN 20 AND 400 AND length({Q}) BETWEEN 20 AND 400)"
KEEP_VALID = f"(regexp_matches({stripped(Q)}, '^([\\p{{L}}_(;@\\[\"`''0-9*+./-]|--|/\\*)'))"
KEEP_WORDS = f"(contains(upper({Q}), 'SELECT') AND contains(upper({Q}), 'FROM'))"
SPLIT_CUT = "CASE WHEN r < round_even(0.8 * n, 0) THEN 'train' WHEN r < round_even(0.8 * n, 0) + round_even(0.1 * n, 0) THEN 'validation' ELSE 'test' END"
STRATIFIED = f"""SELECT example_id, category, {SPLIT_CUT} AS split FROM (SELECT example_id, category,
  row_number() OVER (PARTITION BY category ORDER BY md5('42:' || example_id), example_id) - 1 AS r, count(*) OVER (PARTITION BY category) AS n FROM generated_examples)"""


def _targets_sql(strategy: str) -> str:
    if strategy == "both":
        sized = "greatest(1, round_even(share * n_all, 0))"
    elif strategy == "downsample":
        sized = "least(current, greatest(1, round_even(share * min(CASE WHEN share > 0 THEN current / share END) OVER (), 0)))"
    else:
        sized = "greatest(current, greatest(1, round_even(share * max(CASE WHEN share > 0 THEN current / share END) OVER (), 0)))"
    return f"""SELECT category, current, CAST({sized} AS BIGINT) AS target FROM (SELECT coalesce(difficulty, '__unknown__') AS category,
      count(*) AS current, sum(count(*)) OVER () AS n_all FROM generated_examples GROUP BY 1) g JOIN {WANTED} USING (category)"""


SQL = {
    "curation_by_language": """WITH d AS (SELECT lang, text FROM documents QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1),
      k AS (SELECT coalesce(lang, '__unknown__') AS category, count(*) AS n FROM d WHERE length(coalesce(text, '')) BETWEEN 50 AND 10000 GROUP BY 1)
      SELECT category, n, round(n / sum(n) OVER (), 4) AS ratio FROM k""",
    "exact_dedup_first": "SELECT example_id, natural_language, sql FROM generated_examples QUALIFY row_number() OVER (PARTITION BY coalesce(natural_language, ''), coalesce(sql, '') ORDER BY example_id) = 1",
    "exact_dedup_last": "SELECT example_id, sql FROM generated_examples QUALIFY row_number() OVER (PARTITION BY coalesce(sql, '') ORDER BY example_id DESC) = 1",
    "length_filter": f"SELECT example_id FROM generated_examples WHERE {KEEP_LENGTH}",
    "keyword_filter": f"SELECT example_id FROM generated_examples WHERE {KEEP_WORDS}",
    "score_filter": f"SELECT example_id, score FROM generated_examples WHERE {KEEP_SCORE}",
    "sql_valid_filter": f"SELECT example_id FROM generated_examples WHERE {KEEP_VALID}",
    "filter_chain_counts": f"""WITH s AS (SELECT count(*) AS s0, count(*) FILTER ({KEEP_LENGTH}) AS s1, count(*) FILTER ({KEEP_LENGTH} AND {KEEP_VALID}) AS s2,
        count(*) FILTER ({KEEP_LENGTH} AND {KEEP_VALID} AND {KEEP_WORDS}) AS s3, count(*) FILTER ({KEEP_LENGTH} AND {KEEP_VALID} AND {KEEP_WORDS} AND {KEEP_SCORE}) AS s4 FROM generated_examples)
      SELECT 1 AS step, 'length' AS label, s0 - s1 AS removed, s1 AS remaining FROM s UNION ALL SELECT 2, 'sql_valid', s1 - s2, s2 FROM s
      UNION ALL SELECT 3, 'keywords', s2 - s3, s3 FROM s UNION ALL SELECT 4, 'score', s3 - s4, s4 FROM s""",
    "filter_by_labels": "SELECT seed_id, difficulty, category FROM seeds WHERE difficulty = 'easy' AND category = 'select'",
    "unsafe_statements": rf"""SELECT example_id FROM generated_examples WHERE len(list_intersect(regexp_split_to_array(upper({stripped(Q)}), '\s+'),
      ['DROP','ALTER','TRUNCATE','PRAGMA','ATTACH','DETACH','VACUUM','INSERT','UPDATE','DELETE'])) > 0""",
    "heuristic_issues": f"SELECT example_id, array_to_string({ISSUES}, ' | ') AS issues FROM generated_examples WHERE len({ISSUES}) > 0",
    "syntax_issues": f"SELECT example_id, {SYNTAX} AS issue FROM generated_examples WHERE {SYNTAX} IS NOT NULL",
    "quality_counts": f"""SELECT coalesce(category, '') AS category, count(*) AS n, count(*) FILTER (h) AS n_heuristic, count(*) FILTER (s) AS n_syntax,
        count(*) FILTER (h AND s AND (score IS NULL OR score::VARCHAR = 'nan' OR score >= 3)) AS n_passed
      FROM (SELECT category, score, len({ISSUES}) = 0 AS h, {SYNTAX} IS NULL AS s FROM generated_examples) GROUP BY 1""",
    "numeric_metadata": """SELECT example_id, key, value FROM (SELECT example_id, e.key AS key, try_cast(e.value AS DOUBLE) AS value
      FROM (SELECT example_id, unnest(map_entries(metadata)) AS e FROM generated_examples)) WHERE value IS NOT NULL AND isfinite(value)""",
    "balance_report": "SELECT coalesce(category, '__unknown__') AS category, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS ratio FROM generated_examples GROUP BY 1",
    "value_counts": "SELECT coalesce(difficulty, '__unknown__') AS category, count(*) AS n FROM seeds GROUP BY 1",
    "split_random": f"SELECT example_id, {SPLIT_CUT} AS split FROM (SELECT example_id, row_number() OVER (ORDER BY md5('42:' || example_id), example_id) - 1 AS r, count(*) OVER () AS n FROM generated_examples)",
    "split_stratified": STRATIFIED,
    "split_stats": f"""WITH s AS ({STRATIFIED}), c AS (SELECT split, coalesce(category, '__unknown__') AS category, count(*) AS n FROM s GROUP BY 1, 2), o AS (SELECT split, sum(n)::BIGINT AS n FROM c GROUP BY 1)
      SELECT split, category, n, round(n / sum(n) OVER (PARTITION BY split), 4) AS ratio FROM c UNION ALL SELECT split, NULL, n, round(n / sum(n) OVER (), 4) FROM o""",
    "few_shot_examples": """WITH k AS (SELECT seed_id, difficulty, md5('42:' || seed_id) AS k FROM seeds)
      SELECT seed_id, difficulty FROM (SELECT * FROM k WHERE difficulty = 'hard' ORDER BY k, seed_id LIMIT 7)
      UNION ALL SELECT seed_id, difficulty FROM (SELECT * FROM k WHERE difficulty IS DISTINCT FROM 'hard' ORDER BY k, seed_id LIMIT 3)""",
    "rebalance_downsample": f"""WITH t AS ({_targets_sql('downsample')}) SELECT example_id, difficulty FROM (SELECT example_id, difficulty,
      row_number() OVER (PARTITION BY difficulty ORDER BY md5('42:' || example_id), example_id) AS r FROM generated_examples) JOIN t ON difficulty = category WHERE r <= target""",
}
_A, _B = dedup.permutations(128, 42)
_BANDS, _ROWS = dedup.best_bands(0.85, 128)
_HASHES = r"""(SELECT example_id AS pos, list_sort(list_distinct(list_transform(list_distinct(regexp_extract_all(lower(coalesce(natural_language, '')), '[\p{L}\p{N}_]+')), lambda w: ('0x' || substr(md5(w), 1, 7))::BIGINT))) AS h FROM generated_examples)"""
SQL |= {
    # the signature's permutations and bands are parameters of the operator, as are their numbers here
    "fuzzy_pairs": f"""WITH t AS MATERIALIZED {_HASHES}, f AS MATERIALIZED (SELECT h, min(pos) AS p FROM t GROUP BY h),
      s AS MATERIALIZED (SELECT p, list_transform(range(1, 129), lambda i: list_min(list_transform(h, lambda x: (x * ({_A.tolist()})[i] + ({_B.tolist()})[i]) % {dedup.PRIME}))) AS g FROM f WHERE len(h) > 0),
      k AS MATERIALIZED (SELECT p, b, array_to_string(g[b * {_ROWS} + 1:(b + 1) * {_ROWS}], ',') AS v FROM s, range(0, {_BANDS}) r(b))
      SELECT DISTINCT x.p AS pos_a, y.p AS pos_b, false AS same_tokens FROM k x JOIN k y ON x.b = y.b AND x.v = y.v AND x.p < y.p
      UNION ALL SELECT f.p, t.pos, true FROM t JOIN f USING (h) WHERE t.pos > f.p""",
    "few_shot_random": "SELECT seed_id FROM seeds ORDER BY md5('42:' || seed_id), seed_id LIMIT 10",
    "few_shot_category": "SELECT seed_id, category FROM seeds WHERE category = 'join' ORDER BY md5('42:' || seed_id), seed_id LIMIT 10",
    "seed_subsets": """WITH s AS (SELECT seed_id, row_number() OVER (ORDER BY md5('42:' || seed_id), seed_id) - 1 AS r, count(*) OVER () AS n FROM seeds)
      SELECT j.job_id AS request, k::INT AS nth, s.seed_id FROM generation_jobs j, range(1, 6) t(k), s WHERE s.r = (('0x' || substr(md5('42:' || j.job_id), 1, 12))::BIGINT + k - 1) % s.n""",
    "first_examples": "SELECT example_id, category FROM generated_examples ORDER BY example_id LIMIT 20",
    "unknown_categories": "SELECT coalesce(difficulty, '__unknown__') AS category, count(*) AS n FROM generated_examples WHERE coalesce(difficulty, '__unknown__') NOT IN ('easy', 'medium', 'hard', 'expert') GROUP BY 1",
    "quality_summaries": f"""SELECT example_id, array_to_string(list_filter([CASE WHEN h AND y IS NULL AND (s IS NULL OR s >= 3) THEN '[PASS]' ELSE '[FAIL]' END, CASE WHEN NOT h THEN 'heuristic_fail' END, CASE WHEN y IS NOT NULL THEN 'syntax_fail' END,
        CASE WHEN h AND y IS NULL AND s IS NOT NULL THEN 'llm_score=' || printf('%.1f', s) END, CASE WHEN NOT h OR y IS NOT NULL THEN 'issues=[' || array_to_string(list_concat(i, CASE WHEN y IS NULL THEN [] ELSE [y] END), ', ') || ']' END], lambda x: x IS NOT NULL), ' ') AS summary
      FROM (SELECT example_id, CASE WHEN score::VARCHAR <> 'nan' THEN score END AS s, {ISSUES} AS i, len({ISSUES}) = 0 AS h, {SYNTAX} AS y FROM generated_examples)""",
}
SQL |= {f"balance_counts_{s}": _targets_sql(s) for s in balance.STRATEGIES}
for _s in ("upsample", "both"):
    SQL[f"rebalance_{_s}"] = f"SELECT category AS difficulty, target AS n, least(target, current) AS n_ids FROM ({_targets_sql(_s)})"
