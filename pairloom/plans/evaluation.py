"""Queries over metrics, the gate, reports and training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import metrics as M
from pairloom.operators import gate, report, runs
from pairloom.functions.text import shown_repair, shown_result
from pairloom.operators.filters import bus_class, disk_kind, quality
from pairloom.plans.curation import ISSUES, SYNTAX
from pairloom.plans.dialect import normal_sql, normal_text, stripped
from pairloom.runtime import read_table, spread_table
from pairloom.sources.records import parsed_seeds

# Names from which the rows of disk_classes are put together.
DEVICES, PARTS = ["sda", "nvme0n", "loop", "mmcblk", "vdb", "zram", "ram", "dm-"], ["", "p1", "p2"]
SYSTEMS, BUSES = ["ext4", "BTRFS", "tmpfs", "", "xfs", "fuseblk", "none"], ["sata", "NVMe", "usb", "", "mmc"]
NAMES = ["exact_match", "bleu", "rouge1", "rouge2", "rougeL"]
#: Pairs of (sql, target) for the gate, over the tables of the star schema.
CHECKS = [
    ("SELECT n_name FROM nation", "SELECT n_name FROM nation ORDER BY n_name"),
    ("SELECT r_name FROM region UNION ALL SELECT r_name FROM region", "SELECT r_name FROM region"),
    ("SELECT count(*) FROM customer", "SELECT count(*) FROM supplier"),
    ("SELECT n_name FROM nations", None),
    ("SELECT * FROM region WHERE r_regionkey < 0", None),
    ("DELETE FROM region", None),
    ("   ", None),
    ("SELECT c_nationkey, sum(c_acctbal) FROM customer GROUP BY c_nationkey", None),
]


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each example's answer against that of the smallest id with the same question and an answer, all rows."""
    ex = read_table(spark, sf_dir, "generated_examples").select("example_id", "natural_language", "sql", "category", "difficulty")
    first = ex.filter("natural_language is not null and sql is not null").groupBy("natural_language").agg(F.min_by("sql", "example_id").alias("target"))
    return ex.join(first, "natural_language", "left").select("example_id", "category", "difficulty", F.coalesce("sql", F.lit("")).alias("pred"), F.coalesce("target", "natural_language", F.lit("")).alias("target"))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each example's answer against its own question, all rows."""
    rows = spread_table(spark, sf_dir, "generated_examples", ["example_id", "category", "difficulty", "sql", "natural_language"])
    return rows.select("example_id", "category", "difficulty", F.coalesce("sql", F.lit("")).alias("pred"), F.coalesce("natural_language", F.lit("")).alias("target"))


def exact_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.evaluate(report.scored(_predictions(spark, sf_dir), "pred", "target", ["exact_match"]), ["exact_match"])


def text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rouge = M.rouge_scores(F.col("pred"), F.col("target"), stemmed=False)
    return _questions(spark, sf_dir).select("example_id", rouge.alias("r")).select("example_id", F.round("r.rouge1", 6).alias("rouge1"), F.round("r.rouge2", 6).alias("rouge2"))


def bleu_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _questions(spark, sf_dir).select("example_id", F.round(M.bleu_score(F.col("pred"), F.col("target")), 6).alias("bleu"))


def benchmark_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.evaluate(report.scored(_questions(spark, sf_dir), "pred", "target", NAMES), NAMES)


def _scores_by_teacher(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    ex = read_table(spark, sf_dir, "generated_examples").filter((F.col("strategy") == strategy) & F.col("score").isNotNull() & ~F.isnan("score"))
    return ex.groupBy(F.lower(F.col("difficulty")).alias("metric")).agg(F.avg("score").alias("score")).filter("metric is not null")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.compare(_scores_by_teacher(spark, sf_dir, "self_instruct"), _scores_by_teacher(spark, sf_dir, "evol_instruct"))


def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)


def compare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.comparison_summary(_compared(spark, sf_dir), "self_instruct", "evol_instruct")


def quality_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.parity(_compared(spark, sf_dir)).withColumn("verdict", report.parity_verdict(F.col("parity_pct")))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.when(F.isnan("score") | F.col("score").isNull(), 0).otherwise(F.floor("score")).cast("int")
    return read_table(spark, sf_dir, "generated_examples").select(s.alias("score"))


def judge_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.judge_mean(_judged(spark, sf_dir), "score")


def judge_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.judge_distribution(_judged(spark, sf_dir), "score")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.attempts_by_example(read_table(spark, sf_dir, "gate_results"))


def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gate_metrics(_attempts(spark, sf_dir))


def gate_failure_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.failure_types(_attempts(spark, sf_dir))


def gate_repair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.writer_and_fixer(_attempts(spark, sf_dir))


def gate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gate.Gate(spark, {t: read_table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier")}, timeout=60)
    results = g.check_batch(CHECKS)
    return spark.createDataFrame([(k, r.status, r.passed) for k, r in enumerate(results)], "check_no bigint, status string, passed boolean")


def gate_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gate_records(read_table(spark, sf_dir, "generated_examples"), "example_id").withColumnRenamed("id", "example_id")


def gate_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = read_table(spark, sf_dir, "generated_examples").select("example_id", "metadata", "sql").join(_attempts(spark, sf_dir), "example_id")
    made = gate.annotated(F.col("metadata"), F.col("last_status"), F.lit(None), F.col("attempts") > 0, F.col("attempts"), F.when(F.col("attempts") > 0, F.col("sql")))
    return ex.select("example_id", F.map_keys(made).alias("k"), made["gate_status"].alias("gate_status"), made["was_repaired"].alias("was_repaired"), made["repair_attempts"].alias("repair_attempts")).select("example_id", F.size("k").alias("n_entries"), "gate_status", "was_repaired", "repair_attempts")


def generation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality(F.col("natural_language"), F.col("sql"))["passed"]
    ex = read_table(spark, sf_dir, "generated_examples").select("example_id", q.alias("passed_quality"))
    joined = ex.join(_attempts(spark, sf_dir), "example_id", "left").fillna(False, ["first_passed", "last_passed"])
    return runs.generation_totals(joined)


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training loss of the last run by name."""
    h = read_table(spark, sf_dir, "metric_history")
    last = runs.latest(h.select("run_id").distinct(), "run_id").head()
    return runs.metric_history(h, last[0] if last else "", "train_loss").select("step", F.when(~F.isnan("value"), F.col("value")).alias("value"))


def overfitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.overfitting(read_table(spark, sf_dir, "metric_history"))


def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.training_summary(read_table(spark, sf_dir, "metric_history"))


def job_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.plan_jobs(spark, 1000, ["seed_expansion", "self_instruct", "evol_instruct"], {"easy": 0.3, "medium": 0.45, "hard": 0.25}, {"seed_expansion": 2.0, "evol_instruct": 0.5})


def model_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([("a", 8_030_000_000, 4.5), ("b", 7_240_000_000, 8.5), ("c", 3_800_000_000, 16.0), ("d", 0, 4.0)], "model string, params bigint, bits double")
    return runs.model_sizes(rows, "params", "bits")


def raw_line_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_seeds(read_table(spark, sf_dir, "raw_lines"), "line", ("line_id",)).select("line_id", "natural_language", "sql", "difficulty", "category")


def job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of planned and made counts per strategy."""
    planned = read_table(spark, sf_dir, "generation_jobs").groupBy(F.col("strategy_name").alias("strategy")).agg(F.sum("num_examples").alias("n")).withColumn("kind", F.lit("planned"))
    made = read_table(spark, sf_dir, "generated_examples").groupBy("strategy").agg(F.count("*").alias("n")).withColumn("kind", F.lit("made"))
    return planned.unionByName(made)


def disk_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices, file systems and buses put together from the numbers of parts."""
    nth = lambda names, by: F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(F.col("p_partkey") * by, F.lit(len(names))) + 1).cast("int"))
    device = F.concat(F.lit("/dev/"), nth(DEVICES, 1), F.col("p_size").cast("string"), nth(PARTS, 7))
    rows = read_table(spark, sf_dir, "part").select("p_partkey", disk_kind(device, nth(SYSTEMS, 3)).alias("kind"), bus_class(nth(BUSES, 5)).alias("b"))
    return rows.select("p_partkey", "kind", "b.builtin", "b.bus")


def _customer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query and its target for each nation: customers below one balance and below another."""
    ask = lambda top: F.concat(F.lit("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < "), top.cast("string"), F.lit(" AND c_nationkey = "), F.col("n_nationkey").cast("string"))
    low = F.lit(-1000) + F.pmod(F.col("n_nationkey"), F.lit(4)) * 15
    return read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), ask(low).alias("pred"), ask(low + F.pmod(F.col("n_nationkey"), F.lit(3)) * 10).alias("target"))


def _customers(spark: SparkSession, sf_dir: str) -> gate.Gate:
    return gate.Gate(spark, {"customer": read_table(spark, sf_dir, "customer")}, timeout=60)


def gate_customer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _customer_checks(spark, sf_dir).orderBy("id").collect()  # a row for each nation
    results = _customers(spark, sf_dir).check_batch([(r.pred, r.target) for r in rows])
    return spark.createDataFrame([(r.id, x.status) for r, x in zip(rows, results)], "n_nationkey bigint, status string")


def execution_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = report.scored(_customer_checks(spark, sf_dir), "pred", "target", ["exact_match", M.EXECUTION], _customers(spark, sf_dir), "id")
    return made.select(F.col("id").alias("n_nationkey"), "exact_match", M.EXECUTION)


def zipped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds beside generated examples, first with first, as far as the shorter table goes."""
    seeds, made = (read_table(spark, sf_dir, t).select(c, "category") for t, c in (("seeds", "seed_id"), ("generated_examples", "example_id")))
    return report.zipped(seeds, made, "seed_id", "example_id", strict=False)


def judge_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge that scores by length, and can't score every answer."""
    rows = spread_table(spark, sf_dir, "generated_examples", ["example_id", "sql"])
    return report.judged(rows, lambda sql: len(sql) % 8, ["sql"], "example_id").select(F.col("id").alias("example_id"), "score", F.col("error").isNotNull().alias("failed"))


def job_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generator that echoes the job, and fails for some."""
    jobs = read_table(spark, sf_dir, "generation_jobs")

    def generate(strategy: str, difficulty: str) -> str:
        if difficulty == "hard":
            raise RuntimeError("offline")
        return f"{strategy}/{difficulty}"

    return runs.run_jobs(jobs, ["strategy_name", "difficulty"], generate, "job_id").withColumnRenamed("id", "job_id")


def repair_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir).select("example_id", shown_repair(F.col("last_passed"), F.col("attempts"), F.col("last_status")).alias("summary"), shown_result(F.col("first_passed"), F.col("first_status"), F.lit(None).cast("string")).alias("first"))


def volume_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each strategy's mean tokens cost at some volumes, against an alternative; the rates are made up."""
    tokens = runs.estimated_tokens(F.col("natural_language")) + runs.estimated_tokens(F.col("sql"))
    per = read_table(spark, sf_dir, "generated_examples").groupBy("strategy").agg(F.sum(tokens).alias("n_tokens"), F.round(F.avg(tokens) / 1000, 6).alias("per_unit")).withColumn("fixed", F.lit(50.0))
    return runs.volume_costs(per, "per_unit", "fixed", [100, 1000, 100_000], 0.1)


QUERIES = {
    f.__name__: f
    for f in (
        exact_matches, text_metrics, bleu_scores, benchmark_scores, compare_models, compare_summary, quality_parity, judge_mean, judge_distribution, gate_metrics,
        gate_failure_types, gate_repair_metrics, gate_checks, gate_targets, gate_annotations, generation_totals, metric_history, overfitting, training_summary,
        job_plan, model_sizes, raw_line_seeds, job_totals, disk_classes, gate_customer_checks, execution_accuracy, zipped_rows, judge_batch, job_responses,
        repair_summaries, volume_costs,
    )
}

ATTEMPTS = """(SELECT example_id, min_by(st, k) AS first_status, min_by(ok, k) AS first_passed, max_by(st, k) AS last_status, max_by(ok, k) AS last_passed, max(attempt) - min(attempt) AS attempts
  FROM (SELECT example_id, attempt, coalesce(status, 'unknown') AS st, coalesce(coalesce(passed, status = 'passed'), false) AS ok,
    lpad(attempt::VARCHAR, 6, '0') || coalesce(status, 'unknown') || coalesce(coalesce(passed, status = 'passed'), false)::INT AS k FROM gate_results WHERE example_id IS NOT NULL) GROUP BY 1)"""
COMPARED = """(SELECT metric, round(a, 4) AS model_a, round(b, 4) AS model_b, round(b - a, 4) AS delta, b - a > 0 AS improved FROM (SELECT metric, coalesce(x.s, 0.0) AS a, coalesce(y.s, 0.0) AS b
  FROM (SELECT lower(difficulty) AS metric, avg(score) AS s FROM generated_examples WHERE strategy = 'self_instruct' AND score IS NOT NULL AND score::VARCHAR <> 'nan' AND difficulty IS NOT NULL GROUP BY 1) x
  FULL JOIN (SELECT lower(difficulty) AS metric, avg(score) AS s FROM generated_examples WHERE strategy = 'evol_instruct' AND score IS NOT NULL AND score::VARCHAR <> 'nan' AND difficulty IS NOT NULL GROUP BY 1) y USING (metric)))"""
JUDGED = "(SELECT CASE WHEN score IS NULL OR score::VARCHAR = 'nan' THEN 0 ELSE floor(score)::INT END AS score FROM generated_examples)"
HISTORY = "(SELECT DISTINCT run_id, metric, step, value FROM metric_history WHERE run_id IS NOT NULL AND metric IS NOT NULL AND step IS NOT NULL AND value IS NOT NULL AND value::VARCHAR <> 'nan')"
OVERFIT = f"""(SELECT run_id, step, e AS eval_value, t AS train_value, round(e - t, 6) AS gap, coalesce(e - t > 0.1, false) AS flagged FROM (SELECT run_id, step, e, last_value(t IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS t
  FROM (SELECT run_id, step, max(value) FILTER (metric = 'train_loss') AS t, max(value) FILTER (metric = 'eval_loss') AS e FROM {HISTORY} WHERE metric IN ('train_loss', 'eval_loss') GROUP BY 1, 2)) WHERE e IS NOT NULL)"""
_CHECKED = """(SELECT n_nationkey, low, high, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < low) AS n, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < high) AS m
  FROM (SELECT n_nationkey, -1000 + n_nationkey % 4 * 15 AS low, -1000 + n_nationkey % 4 * 15 + n_nationkey % 3 * 10 AS high FROM nation))"""
PREDICTED = """(SELECT e.category, e.difficulty, coalesce(e.sql, '') AS pred, coalesce(f.target, e.natural_language, '') AS target FROM generated_examples e
  LEFT JOIN (SELECT natural_language, min_by(sql, example_id) AS target FROM generated_examples WHERE natural_language IS NOT NULL AND sql IS NOT NULL GROUP BY 1) f USING (natural_language))"""


def _grams(tokens: str, n: int) -> str:
    return f"list_transform(range(1, greatest(len({tokens}) - {n} + 2, 1)), lambda i: array_to_string({tokens}[i:i + {n - 1}], chr(1)))"


def _gram_hits(n: int) -> str:
    """Per seed: clipped matches of n-grams and their numbers on both sides."""
    return f"""(SELECT example_id, coalesce(sum(least(cp, ct)), 0) AS hit, coalesce(sum(cp), 0) AS np, coalesce(sum(ct), 0) AS nt FROM
      (SELECT example_id, g, count(*) FILTER (s = 0) AS cp, count(*) FILTER (s = 1) AS ct FROM
        (SELECT example_id, 0 AS s, unnest({_grams('p', n)}) AS g FROM toks UNION ALL SELECT example_id, 1, unnest({_grams('t', n)}) FROM toks) GROUP BY 1, 2) GROUP BY 1)"""


ROUGE_TOKENS = "list_filter(regexp_split_to_array({0}, '[^a-z0-9]+'), lambda x: x <> '')"
SEED_TOKENS = "WITH toks AS (SELECT example_id, {p} AS p, {t} AS t FROM generated_examples)"
_PLAIN = {"p": normal_text("coalesce(sql, '')"), "t": normal_text("coalesce(natural_language, '')")}
_F1 = "CASE WHEN coalesce({0}.hit, 0) > 0 THEN round(2.0 * {0}.hit / ({0}.np + {0}.nt), 6) ELSE 0.0 END::DOUBLE"
_BLEU_TOKENS = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\s\p{{Z}}\p{{L}}\p{{N}}_]')"
_LOG = "ln((CASE WHEN coalesce(g{0}.hit, 0) > 0 THEN g{0}.hit ELSE 0.1 END) / greatest(1, coalesce(g{0}.np, 0))) / 4"

SQL = {
    "text_metrics": f"""{SEED_TOKENS.format(p=ROUGE_TOKENS.format(_PLAIN['p']), t=ROUGE_TOKENS.format(_PLAIN['t']))}
      SELECT example_id, {_F1.format('a')} AS rouge1, {_F1.format('b')} AS rouge2 FROM toks LEFT JOIN {_gram_hits(1)} a USING (example_id) LEFT JOIN {_gram_hits(2)} b USING (example_id)""",
    "compare_models": f"SELECT * FROM {COMPARED}",
    "compare_summary": f"""SELECT wins_b, wins_a, n_metrics, CASE WHEN wins_b > wins_a THEN 'evol_instruct is better on ' || wins_b || '/' || n_metrics || ' metrics' WHEN wins_a > wins_b THEN 'self_instruct is better on ' || wins_a || '/' || n_metrics || ' metrics' ELSE 'Models are tied across metrics' END AS summary
      FROM (SELECT count(*) FILTER (improved) AS wins_b, count(*) FILTER (NOT improved AND delta < 0) AS wins_a, count(*) AS n_metrics FROM {COMPARED})""",
    "quality_parity": f"""SELECT *, CASE WHEN parity_pct >= 90 THEN 'EXCELLENT' WHEN parity_pct >= 75 THEN 'GOOD' WHEN parity_pct >= 60 THEN 'ACCEPTABLE' WHEN parity_pct IS NOT NULL THEN 'NEEDS WORK' END AS verdict
      FROM (SELECT round(avg(model_b / model_a * 100), 4) AS parity_pct, count(*) AS n_metrics FROM {COMPARED} WHERE model_a > 0)""",
    "judge_mean": f"SELECT round(coalesce(avg(score) FILTER (score > 0), 0.0), 3) AS mean_score, count(*) FILTER (score > 0) AS num_judged, count(*) FILTER (score <= 0) AS num_errors FROM {JUDGED}",
    "judge_distribution": f"SELECT r::INT AS score, (SELECT count(*) FROM {JUDGED} j WHERE j.score = r) AS n FROM range(1, 6) t(r)",
    "gate_metrics": f"""SELECT *, round(passed_first_try / total, 6) AS pass_rate_first_try, round(final_passed / total, 6) AS pass_rate_final, coalesce(round(repair_success / nullif(repair_attempts, 0), 6), 0.0) AS repair_success_rate FROM
      (SELECT count(*) AS total, count(*) FILTER (first_passed) AS passed_first_try, count(*) FILTER (NOT first_passed) AS failed_first_try, coalesce(sum(attempts), 0)::BIGINT AS repair_attempts, count(*) FILTER (attempts > 0) AS repaired_rows,
        count(*) FILTER (NOT first_passed AND last_passed) AS repair_success, count(*) FILTER (last_passed) AS final_passed, count(*) FILTER (NOT last_passed) AS final_failed FROM {ATTEMPTS})""",
    "gate_failure_types": f"SELECT first_status AS status, count(*) AS n FROM {ATTEMPTS} GROUP BY 1",
    "gate_repair_metrics": f"""SELECT total, attempts, success, coalesce(round(success / nullif(attempts, 0), 6), 0.0) AS success_rate, coalesce(round((ok + success) / nullif(total, 0), 6), 0.0) AS pass_rate FROM
      (SELECT count(*) AS total, count(*) FILTER (NOT first_passed) AS attempts, count(*) FILTER (NOT first_passed AND last_passed) AS success, count(*) FILTER (first_passed) AS ok FROM {ATTEMPTS})""",
    "gate_checks": "SELECT * FROM (VALUES (0::BIGINT, 'passed', true), (1, 'passed', true), (2, 'wrong_result', false), (3, 'execution_error', false), (4, 'empty_result', false), (5, 'unsafe', false), (6, 'syntax_error', false), (7, 'passed', true)) t(check_no, status, passed)",
    "gate_targets": "SELECT example_id, natural_language, sql, nullif(metadata['target_sql'], '') AS target_sql FROM generated_examples",
    "gate_annotations": f"""SELECT example_id, (len(list_filter(coalesce(map_keys(metadata), []), lambda x: x NOT IN ('gate_status', 'was_repaired', 'repair_attempts', 'original_sql'))) + 3 + (CASE WHEN attempts > 0 AND sql IS NOT NULL THEN 1 ELSE 0 END))::INT AS n_entries,
      last_status AS gate_status, (attempts > 0)::VARCHAR AS was_repaired, attempts::VARCHAR AS repair_attempts FROM generated_examples JOIN {ATTEMPTS} USING (example_id)""",
    "metric_history": "SELECT step, CASE WHEN value::VARCHAR <> 'nan' THEN value END AS value FROM metric_history WHERE run_id = (SELECT max(run_id) FROM metric_history) AND metric = 'train_loss'",
    "overfitting": f"SELECT *, bool_or(flagged) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS ever_flagged FROM {OVERFIT}",
    "training_summary": f"""SELECT run_id, count(*) FILTER (metric = 'train_loss') AS n_train, count(*) FILTER (metric = 'eval_loss') AS n_eval, arg_max(value, step) FILTER (metric = 'train_loss') AS final_train_loss,
      arg_max(value, step) FILTER (metric = 'eval_loss') AS final_eval_loss, coalesce((SELECT bool_or(flagged) FROM {OVERFIT} o WHERE o.run_id = h.run_id), false) AS ever_overfit FROM {HISTORY} h GROUP BY run_id""",
    "job_plan": """SELECT s AS strategy_name, d AS difficulty, greatest(1, floor(greatest(1, floor(1000 * w / 3.5)) * k))::BIGINT AS num_examples FROM (VALUES ('seed_expansion', 2.0::DOUBLE), ('self_instruct', 1.0), ('evol_instruct', 0.5)) a(s, w),
      (VALUES ('easy', 0.3::DOUBLE), ('medium', 0.45), ('hard', 0.25)) b(d, k)""",
    "model_sizes": """SELECT model, params, bits, CASE WHEN params > 0 THEN round(params * bits / 8 / 1073741824, 2) END AS size_gb, CASE WHEN params > 0 THEN round(params * bits / 8 / 1048576, 1) END AS size_mb
      FROM (VALUES ('a', 8030000000, 4.5::DOUBLE), ('b', 7240000000, 8.5), ('c', 3800000000, 16.0), ('d', 0, 4.0)) t(model, params, bits)""",
    "raw_line_seeds": f"""SELECT line_id, natural_language, sql, difficulty, category FROM (SELECT line_id, {stripped("line ->> '$.natural_language'")} AS natural_language, {stripped("line ->> '$.sql'")} AS sql,
      coalesce(line ->> '$.difficulty', 'medium') AS difficulty, coalesce(line ->> '$.category', '') AS category FROM raw_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT') WHERE coalesce(natural_language, '') <> '' AND coalesce(sql, '') <> ''""",
    "job_totals": "SELECT strategy_name AS strategy, sum(num_examples)::BIGINT AS n, 'planned' AS kind FROM generation_jobs GROUP BY 1 UNION ALL SELECT strategy, count(*), 'made' FROM generated_examples GROUP BY 1",
    "disk_classes": f"""SELECT p_partkey, CASE WHEN s IN ('tmpfs', '', 'fuseblk', 'none') OR d IN ('loop', 'zram', 'ram') THEN 'skip' WHEN d IN ('nvme0n', 'mmcblk') THEN d || p_size WHEN d = 'dm-' THEN 'dm' ELSE d END AS kind,
      b IN ('sata', 'NVMe') AS builtin, CASE WHEN b = '' THEN 'Unknown' ELSE upper(b) END AS bus
      FROM (SELECT p_partkey, p_size, ({DEVICES})[p_partkey % {len(DEVICES)} + 1] AS d, ({SYSTEMS})[p_partkey * 3 % {len(SYSTEMS)} + 1] AS s, ({BUSES})[p_partkey * 5 % {len(BUSES)} + 1] AS b FROM part)""",
    "gate_customer_checks": f"SELECT n_nationkey::BIGINT AS n_nationkey, CASE WHEN n = 0 THEN 'empty_result' WHEN n = m THEN 'passed' ELSE 'wrong_result' END AS status FROM {_CHECKED}",
    "execution_accuracy": f"SELECT n_nationkey::BIGINT AS n_nationkey, CASE WHEN low = high THEN 1.0 ELSE 0.0 END::DOUBLE AS exact_match, CASE WHEN n = m THEN 1.0 ELSE 0.0 END::DOUBLE AS exec_accuracy FROM {_CHECKED}",
    "zipped_rows": """SELECT seed_id, s.category AS category, example_id, e.category AS right_category FROM (SELECT seed_id, category, row_number() OVER (ORDER BY seed_id) AS k FROM seeds) s
      JOIN (SELECT example_id, category, row_number() OVER (ORDER BY example_id) AS k FROM generated_examples) e USING (k)""",
    "judge_batch": "SELECT example_id, CASE WHEN n BETWEEN 1 AND 5 THEN n ELSE 0 END::INT AS score, coalesce(n NOT BETWEEN 1 AND 5, true) AS failed FROM (SELECT example_id, length(sql) % 8 AS n FROM generated_examples)",
    "job_responses": "SELECT job_id, CASE WHEN difficulty IS DISTINCT FROM 'hard' THEN coalesce(strategy_name, 'None') || '/' || coalesce(difficulty, 'None') END AS response, CASE WHEN difficulty = 'hard' THEN 'offline' END AS error FROM generation_jobs",
    "repair_summaries": f"""SELECT example_id, CASE WHEN last_passed AND attempts = 0 THEN '[PASS: no repair needed]' WHEN last_passed THEN '[REPAIRED after ' || attempts || ' attempt(s)]' ELSE '[FAIL after ' || attempts || ' attempt(s): ' || last_status || ']' END AS summary,
      CASE WHEN first_passed THEN '[PASS]' ELSE '[FAIL:' || first_status || ']' END AS first FROM {ATTEMPTS}""",
    "volume_costs": """SELECT strategy, n_tokens, per_unit, 50.0::DOUBLE AS fixed, volume, round(50 + per_unit * volume, 6) AS own_cost, round(0.1::DOUBLE * volume, 6) AS other_cost, round(0.1::DOUBLE * volume - (50 + per_unit * volume), 6) AS saved,
      CASE WHEN per_unit < 0.1::DOUBLE THEN floor(50 / (0.1::DOUBLE - per_unit))::BIGINT END AS break_even FROM (SELECT strategy, sum(t)::BIGINT AS n_tokens, round(avg(t) / 1000, 6) AS per_unit
      FROM (SELECT strategy, length(coalesce(natural_language, '')) // 4 + length(coalesce(sql, '')) // 4 AS t FROM generated_examples) GROUP BY 1), (VALUES (100::BIGINT), (1000), (100000)) v(volume)""",
    "generation_totals": f"""SELECT count(*) AS generated, count(*) FILTER (ok) AS passed_quality, count(*) FILTER (ok AND z) AS passed_gate, count(*) FILTER (ok AND z AND NOT a) AS repaired, count(*) FILTER (NOT (ok AND z)) AS rejected
      FROM (SELECT len({ISSUES}) = 0 AND {SYNTAX} IS NULL AS ok, coalesce(g.first_passed, false) AS a, coalesce(g.last_passed, false) AS z FROM generated_examples e LEFT JOIN {ATTEMPTS} g USING (example_id))""",
    "bleu_scores": f"""{SEED_TOKENS.format(p=_BLEU_TOKENS.format(_PLAIN['p']), t=_BLEU_TOKENS.format(_PLAIN['t']))}
      SELECT example_id, CASE WHEN len(t) = 0 THEN (CASE WHEN len(p) = 0 THEN 1.0 ELSE 0.0 END) WHEN coalesce(g1.hit, 0) = 0 THEN 0.0
        ELSE round((CASE WHEN len(p) > len(t) THEN 1.0 ELSE exp(1 - len(t) / len(p)) END) * exp({_LOG.format(1)} + {_LOG.format(2)} + {_LOG.format(3)} + {_LOG.format(4)}), 6) END::DOUBLE AS bleu
      FROM toks LEFT JOIN {_gram_hits(1)} g1 USING (example_id) LEFT JOIN {_gram_hits(2)} g2 USING (example_id) LEFT JOIN {_gram_hits(3)} g3 USING (example_id) LEFT JOIN {_gram_hits(4)} g4 USING (example_id)""",
    "exact_matches": f"""WITH m AS (SELECT coalesce(category, 'unknown') AS category, coalesce(difficulty, 'unknown') AS difficulty, CASE WHEN {normal_sql('pred')} = {normal_sql('target')} THEN 1.0 ELSE 0.0 END AS x FROM {PREDICTED})
      SELECT 'overall' AS group_kind, '' AS group_value, count(*) AS n, round(avg(x), 6) AS exact_match FROM m UNION ALL SELECT 'category', category, count(*), round(avg(x), 6) FROM m GROUP BY category
      UNION ALL SELECT 'difficulty', difficulty, count(*), round(avg(x), 6) FROM m GROUP BY difficulty""",
}
