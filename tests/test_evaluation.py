import time

import pytest
from pyspark.sql import functions as F

from pairloom.operators import gate, report, runs


@pytest.fixture(scope="module")
def users(spark):
    u = spark.createDataFrame([(1, "Ann", 30), (2, "Bo", 25), (3, "Cy", 41)], "id int, name string, age int")
    o = spark.createDataFrame([(1, 1, 9.5), (2, 1, 3.0), (3, 2, 7.0)], "id int, user_id int, amount double")
    return gate.Gate(spark, {"users": u, "orders": o}, timeout=60)


@pytest.mark.parametrize(
    ("sql", "target", "status"),
    [
        ("SELECT name FROM users", None, "passed"),
        ("SELECT name FROM users;", "SELECT name FROM users ORDER BY age DESC;", "passed"),
        ("SELECT id FROM users", "SELECT id FROM users WHERE id < 3", "wrong_result"),
        ("SELECT nope FROM users", None, "execution_error"),
        ("SELECT id FROM users WHERE id > 9", None, "empty_result"),
        ("DROP TABLE users", None, "unsafe"),
        ("CREATE TABLE x (a int)", None, "unsafe"),
        ("", None, "syntax_error"),
        (None, None, "syntax_error"),
        ("SELECT id FROM users", "SELECT broken FROM users", "execution_error"),
        ("SELECT id FROM users", "DELETE FROM users", "unsafe"),
        ("SELECT 1/0 FROM users", None, "execution_error"),
    ],
)
def test_gate_statuses(users, sql, target, status):
    assert users.check(sql, target).status == status


def test_gate_batch_keeps_order(users):
    got = users.check_batch([("SELECT 1", None), ("SELEC", None), ("SELECT id FROM users", "SELECT id FROM users")])
    assert [r.status for r in got] == ["passed", "unsafe", "passed"]


def test_gate_timeout(spark):
    g = gate.Gate(spark, timeout=1.0)
    spark.range(200_000).createOrReplaceTempView("many")
    assert g.check("SELECT count(*) FROM many a JOIN many b ON a.id < b.id + b.id % 7").status == "timeout"


def test_same_rows_ignores_repeats_and_number_types(spark):
    q = spark.sql
    assert gate.same_rows(q("SELECT 1 UNION ALL SELECT 1"), q("SELECT 1.0"))
    assert not gate.same_rows(q("SELECT 1"), q("SELECT '1'"))
    assert gate.same_rows(q("SELECT null"), q("SELECT null"))
    assert gate.same_rows(q("SELECT 1 WHERE false"), q("SELECT 1, 2 WHERE false"))
    assert not gate.same_rows(q("SELECT 1"), q("SELECT 1, 2"))


def test_repair_stops_early_and_reports_errors(users):
    fixed = gate.repair(users, "SELECT nope FROM users", None, lambda sql, r: "SELECT name FROM users")
    assert fixed.result.passed and fixed.attempts == 1 and len(fixed.history) == 2
    never = gate.repair(users, "SELECT nope FROM users", None, lambda sql, r: sql, 2)
    assert not never.result.passed and never.attempts == 2 and len(never.history) == 3

    def broken(sql, r):
        raise RuntimeError("offline")

    failed = gate.repair(users, "SELECT nope FROM users", None, broken)
    assert failed.attempts == 3 and failed.history[-1]["error_message"] == "offline"


def test_gate_metrics(spark):
    rows = [(1, 1, "passed", True), (1, 1, "passed", True), (2, 1, "wrong_result", False), (2, 2, "passed", None), (3, 1, "unsafe", False), (4, 1, "wrong_result", None)]
    checked = gate.attempts_by_example(spark.createDataFrame(rows, "example_id bigint, attempt int, status string, passed boolean"))
    m = gate.gate_metrics(checked).head()
    assert (m.total, m.passed_first_try, m.failed_first_try, m.repair_attempts, m.repair_success, m.final_passed) == (4, 1, 3, 1, 1, 2)
    assert m.pass_rate_final == 0.5
    assert {r.status: r.n for r in gate.failure_types(checked).collect()} == {"passed": 1, "wrong_result": 2, "unsafe": 1}
    none = gate.gate_metrics(checked.limit(0)).head()
    assert none.total == 0 and none.pass_rate_final is None and none.repair_success_rate == 0.0
    w = gate.writer_and_fixer(checked).head()
    assert (w.attempts, w.success, w.pass_rate) == (3, 1, 0.5)


def test_annotations(spark):
    df = spark.createDataFrame([({"a": "1", "gate_status": "old"},), (None,)], "m map<string,string>")
    made = df.select(gate.annotated(F.col("m"), F.lit("passed"), F.lit(None), F.lit(True), F.lit(2), F.lit("SELECT 1")).alias("x")).collect()
    assert made[0].x == {"a": "1", "gate_status": "passed", "was_repaired": "true", "repair_attempts": "2", "original_sql": "SELECT 1"}
    assert "a" not in made[1].x and made[1].x["gate_status"] == "passed"


def test_evaluate_groups(spark):
    df = spark.createDataFrame([("SELECT 1", "select 1", "a", "easy"), ("x", "y", "a", None), ("x", "x", None, "easy")], "p string, t string, category string, difficulty string")
    scored = report.scored(df, "p", "t", ["exact_match", "rouge1"])
    got = {(r.group_kind, r.group_value): (r.n, r.exact_match) for r in report.evaluate(scored, ["exact_match", "rouge1"]).collect()}
    assert got[("overall", "")] == (3, 0.666667)
    assert got[("category", "a")] == (2, 0.5) and got[("category", "unknown")] == (1, 1.0)
    assert got[("difficulty", "easy")] == (2, 1.0)
    assert report.evaluate(scored.limit(0), ["exact_match", "rouge1"]).collect() == []


def test_compare(spark):
    a = spark.createDataFrame([("x", 0.5), ("y", 0.2)], "metric string, score double")
    b = spark.createDataFrame([("x", 0.75), ("z", 0.1)], "metric string, score double")
    got = {r.metric: (r.model_a, r.model_b, r.delta, r.improved) for r in report.compare(a, b).collect()}
    assert got == {"x": (0.5, 0.75, 0.25, True), "y": (0.2, 0.0, -0.2, False), "z": (0.0, 0.1, 0.1, True)}
    assert report.comparison_summary(report.compare(a, b), "A", "B").head().summary == "B is better on 2/3 metrics"
    assert report.comparison_summary(report.compare(a, a), "A", "B").head().summary == "Models are tied across metrics"


def test_judge(spark):
    df = spark.createDataFrame([(5,), (0,), (3,), (None,)], "score int")
    assert tuple(report.judge_mean(df, "score").head()) == (4.0, 2, 2)
    assert {r.score: r.n for r in report.judge_distribution(df, "score").collect()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 1}
    assert report.judge_mean(df.limit(0), "score").head().mean_score == 0.0


def test_overfitting_uses_the_latest_training_loss(spark):
    rows = [("r", "train_loss", 1, 1.0), ("r", "train_loss", 1, 1.0), ("r", "eval_loss", 2, 1.05), ("r", "train_loss", 3, 0.5), ("r", "eval_loss", 3, 0.7), ("r", "eval_loss", 4, float("nan")), ("q", "eval_loss", 1, 2.0)]
    df = spark.createDataFrame(rows, "run_id string, metric string, step bigint, value double")
    got = {(r.run_id, r.step): (r.gap, r.flagged, r.ever_flagged) for r in runs.overfitting(df).collect()}
    assert got == {("r", 2): (0.05, False, False), ("r", 3): (0.2, True, True), ("q", 1): (None, False, False)}
    s = {r.run_id: r for r in runs.training_summary(df).collect()}
    assert (s["r"].n_train, s["r"].n_eval, s["r"].final_train_loss, s["r"].ever_overfit) == (2, 2, 0.5, True)


def test_plans_sizes_and_totals(spark):
    plan = {(r.strategy_name, r.difficulty): r.num_examples for r in runs.plan_jobs(spark, 11, ["a", "b"], {"x": 0.5, "y": 0.01}).collect()}
    assert plan == {("a", "x"): 3, ("a", "y"): 1, ("b", "x"): 2, ("b", "y"): 1}
    sizes = runs.model_sizes(spark.createDataFrame([(8_000_000_000, 4.5), (0, 4.0)], "p bigint, b double"), "p", "b").collect()
    assert sizes[0].size_gb == 4.19 and sizes[1].size_gb is None
    assert runs.token_rate(spark.createDataFrame([(100, 2.0), (50, 1.0)], "t int, s double"), "t", "s").head()[0] == 50.0
    long = runs.wide_to_long(spark.createDataFrame([("r", 1, 0.5, None)], "run_id string, step int, a double, b double"), ["run_id", "step"], ["a", "b"])
    assert [tuple(r) for r in long.collect()] == [("r", 1, "a", 0.5)]
    assert runs.runs_table(spark, [("r", "done", 1_700_000_000_000, {"a": "b"}, {"m": 1.0})]).head().start_time.year == 2023


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM users", "SELECT `java_method`('a', 'b') FROM users", "SELECT * FROM csv.`/etc/passwd`", "SELECT * FROM users WHERE id IN (SELECT value FROM text.`/tmp/x`)",
        "WITH a AS (SELECT * FROM parquet.`/tmp/y`) SELECT * FROM a", "SET x = 1", "INSERT INTO users SELECT 1, 'a', 2", "CREATE VIEW v AS SELECT 1", "SELECT * FROM other_catalog.users", "SHOW TABLES",
    ],
)
def test_gate_reads_nothing_but_its_tables(users, sql):
    assert users.check(sql).status == "unsafe"


def test_gate_allows_what_only_looks_unsafe(users):
    assert users.check("SELECT 'reflect(1) csv.`/x`' AS a FROM users").passed
    assert users.check("WITH a AS (SELECT id FROM users) SELECT count(*) FROM a WHERE id IN (SELECT user_id FROM orders)").passed


@pytest.mark.parametrize(
    ("sql", "status"),
    [
        ("INSERT INTO users SELECT id, name, age FROM users", "empty_result"), ("INSERT INTO users (id, name) VALUES (7, 'x')", "empty_result"), ("INSERT INTO users VALUES (1)", "execution_error"), ("DELETE FROM users WHERE id = 1", "empty_result"),
        ("DELETE FROM users WHERE nope = 1", "execution_error"), ("UPDATE users SET age = age + 1 WHERE id = 2", "empty_result"), ("UPDATE users SET age = nope", "execution_error"), ("DROP TABLE users", "unsafe"), ("INSERT INTO users SELECT * FROM csv.`/x`", "unsafe"),
    ],
)
def test_gate_checks_changes_without_making_them(spark, users, sql, status):
    writer = gate.Gate(spark, users.tables, timeout=60, allow_writes=True)
    assert writer.check(sql).status == status
    assert gate.Gate(spark, users.tables, timeout=60, allow_writes=True, allow_empty=True).check(sql).passed == (status == "empty_result")
    assert writer.check("SELECT count(*) FROM users", "SELECT 3").passed


def test_one_deadline_holds_for_a_whole_check(spark):
    g = gate.Gate(spark, timeout=1.5)
    spark.range(100_000).createOrReplaceTempView("many")
    slow = "SELECT count(*) FROM many a JOIN many b ON a.id < b.id + b.id % 7"
    began = time.time()
    assert g.check("SELECT 1", slow).status == "timeout" and time.time() - began < 15


def test_execution_accuracy(spark, users):
    rows = [(1, "SELECT name FROM users", "SELECT name FROM users ORDER BY 1"), (2, "SELECT 1", "SELECT 2"), (3, None, "SELECT 1"), (4, "SELECT 1", None), (5, "SELECT id FROM users WHERE id > 9", "SELECT id FROM users WHERE id > 8"), (6, "SELECT nope", "SELECT 1"), (1, "SELECT 1", "SELECT 1")]
    df = spark.createDataFrame(rows[:6], "id int, p string, t string")
    made = report.scored(df, "p", "t", ["exact_match", "exec_accuracy"], users, "id")
    assert {r.id: r.exec_accuracy for r in made.collect()} == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 1.0, 6: 0.0}
    assert report.evaluate(made.withColumn("category", F.lit("a")).withColumn("difficulty", F.lit("b")), ["exec_accuracy"]).filter("group_kind = 'overall'").head().exec_accuracy == 0.333333
    with pytest.raises(ValueError):
        report.scored(df, "p", "t", ["exec_accuracy"])
    assert gate.execution_scores(users, df.limit(0), "id", "p", "t").collect() == []


def test_rows_are_zipped_in_order(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([("y", 20), ("x", 10), ("z", 30)], "v string, n int")
    assert sorted(tuple(r) for r in report.zipped(a, b, "k", "n").collect()) == [(1, "a", "x", 10), (2, "b", "y", 20), (3, "c", "z", 30)]
    assert report.zipped(a, b.filter("n < 30"), "k", "n", strict=False).count() == 2
    with pytest.raises(ValueError):
        report.zipped(a, b.filter("n < 30"), "k", "n")
    assert report.zipped(a.limit(0), b.limit(0), "k", "n").collect() == []


def test_positions_over_many_ranges(spark, monkeypatch):
    from pairloom.operators import ranking

    monkeypatch.setattr(ranking, "BIN_ROWS", 50)
    got = {r.id: r.at for r in ranking.positions(spark.range(1000).withColumn("id", F.col("id") * 7 % 1000), "id", "at").collect()}
    assert got == {i: i for i in range(1000)} and ranking.bin_digits(50 * 16 + 1) == 2


def test_judges_and_jobs_fail_row_by_row(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, "9"), (4, None)], "id int, a string")
    assert {r.id: (r.score, r.error is None) for r in report.judged(df, lambda a: a, ["a"], "id").collect()} == {1: (5, True), 2: (0, False), 3: (0, False), 4: (0, False)}
    assert {r.id: (r.response, r.error) for r in runs.run_jobs(df, ["a"], lambda a: a.upper(), "id").collect()}[2] == ("X", None)
    assert {r.id: r.response for r in runs.run_jobs(df, ["a"], lambda a: a.upper(), "id").collect()}[4] is None


def test_small_reports(spark):
    rows = spark.createDataFrame([("a", 0.5), ("b", 1.0)], "k string, bleu double")
    assert tuple(report.benchmark_row(rows, "m", ["bleu"], 4.0).head()) == ("m", 2, 0.75, 0.5)
    assert report.benchmark_row(rows.limit(0), "m", ["bleu"], 0.0).head().per_second == 0.0
    pct = spark.createDataFrame([(95.0,), (75.0,), (60.0,), (10.0,), (None,)], "p double").select(report.parity_verdict(F.col("p")).alias("v"))
    assert [r.v for r in pct.collect()] == ["EXCELLENT", "GOOD", "ACCEPTABLE", "NEEDS WORK", None]
    assert [r.k for r in runs.latest(rows, "bleu").collect()] == ["b"] and runs.latest(rows.limit(0), "bleu").collect() == []
    bits = spark.createDataFrame([(4.5, "x"), (None, "q8"), (None, "?")], "b double, m string").select(runs.effective_bits(F.col("b"), F.col("m"), {"q8": 8.5}).alias("e"), runs.adapter_scale(F.lit(32), F.lit(16)).alias("s"))
    assert [tuple(r) for r in bits.collect()] == [(4.5, 2.0), (8.5, 2.0), (None, 2.0)]
    cost = runs.volume_costs(spark.createDataFrame([(1.0, 10.0)], "u double, f double"), "u", "f", [1, 100], 2.0).collect()
    assert [(r.own_cost, r.other_cost, r.saved, r.break_even) for r in cost] == [(11.0, 2.0, -9.0, 10), (110.0, 200.0, 90.0, 10)]
    assert runs.run_views(spark, rows, spark.createDataFrame([], "run_id string, metric string, step bigint, value double")) == ["runs", "run_metrics"] and spark.table("runs").count() == 2
