"""Execution gate: runs queries on temporary views, classifies each, and the metrics of its results."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import islice

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.filters import UNSAFE, WRITES
from pairloom.runtime import col, materialize, table_path

PASSED, SYNTAX, FAILED, WRONG, TIMEOUT, EMPTY, UNSAFE_STATUS = "passed", "syntax_error", "execution_error", "wrong_result", "timeout", "empty_result", "unsafe"
NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")


@dataclass
class GateResult:
    status: str
    error_message: str | None = None

    @property
    def passed(self) -> bool:
        return self.status == PASSED


def _message(e: Exception) -> str:
    return str(e).strip().splitlines()[0][:300] if str(e).strip() else type(e).__name__


def _table(plan) -> str:
    """The name of the relation that a change names, under an alias or not."""
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.multipartIdentifier().mkString(".")


def _count(rows: DataFrame) -> int:
    """The number of rows, each computed whole: a late row may fail."""
    named = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return named.agg(F.count(F.hash(*named.columns)) if named.columns else F.count("*")).head()[0]


def compared(a: DataFrame, b: DataFrame) -> tuple[int, int, int]:
    """(rows of a, distinct rows only in a, distinct rows only in b), in one pass over both.

    Order and repeats don't count, null equals null, 1 equals 1.0, a text never equals a number. Two empty results are
    the same, whatever their columns.
    """
    comparable = len(a.columns) == len(b.columns)
    x, y = (d.toDF(*[f"c{i}" for i in range(len(d.columns))]) for d in (a, b))
    if comparable:
        for (name, left), (_, right) in zip(x.dtypes, y.dtypes):
            numbers = [t.split("(")[0] in NUMERIC for t in (left, right)]
            if numbers[0] != numbers[1] and left != right and "void" not in (left, right):
                comparable = False
            elif left != right:
                x, y = (d.withColumn(name, F.col(name).cast("double" if all(numbers) else "string")) for d in (x, y))
    if not comparable:
        n, m = _count(a), _count(b)
        return n, n, m
    both = x.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(y.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    keys = both.groupBy(*x.columns).agg(F.sum("_a").alias("n"), F.sum("_b").alias("m"))
    got = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("m") == 0), F.count_if(F.col("n") == 0)).head()
    return got[0], got[1], got[2]


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two results hold the same set of rows; see compared()."""
    _, only, missing = compared(a, b)
    return not only and not missing


# Functions that reach beyond the tables, and what the parser calls the statements that change one.
REACHING = re.compile(r"\b(?:reflect|java_method|try_reflect)\s*\(", re.I)
CHANGES = ("InsertIntoStatement", "DeleteFromTable", "UpdateTable")
LITERALS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|--[^\n]*|/\*.*?\*/", re.S)
RELATION = re.compile(r"'UnresolvedRelation \[([^\]]*)\]")
CTE = re.compile(r"^\W*CTE \[([^\]]*)\]", re.M)


@dataclass
class Gate:
    """Checks queries against tables that are registered by name as temporary views of a session.

    What a statement may do is told by its parsed plan: a query may read the registered tables and its own CTEs, and nothing
    else, so commands, files read by path, other catalogs' tables and calls by reflection are unsafe. With allow_writes,
    INSERT, UPDATE and DELETE are checked by running what they read: the inserted rows, or the changed rows and their new
    values. Nothing is written, since Spark tables have no transaction to roll back, and a statement that passes gives no
    rows. A check that runs longer than timeout seconds, all its steps together, is cancelled.
    """

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    timeout: float = 5.0
    allow_empty: bool = False
    allow_writes: bool = False

    def __post_init__(self) -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)

    def _views(self) -> set[str]:
        return {t.lower() for t in self.tables} or {t.name.lower() for t in self.spark.catalog.listTables() if t.isTemporary}

    def _plan(self, sql: str):
        """The parsed plan if the statement may run, the reason why not as text, or a failure to parse."""
        if any(w in UNSAFE + (() if self.allow_writes else WRITES) for w in sql.upper().split()):
            return "the statement holds a forbidden word"
        if REACHING.search(LITERALS.sub(" ", sql).replace("`", "")):
            return "the statement calls a method by reflection"
        try:
            plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
        except Exception as e:  # noqa: BLE001 - the parser's own errors
            return "the statement is not a plain query" if not re.match(r"[(\s]*(?:select|with|values|from|table)\b", sql, re.I) else GateResult(FAILED, _message(e))
        kind = plan.getClass().getSimpleName()
        command = self.spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command").isInstance(plan)
        if (command or kind in CHANGES or "Statement" in kind) and not (self.allow_writes and kind in CHANGES):
            return "the statement is not a plain query"
        told = plan.toString()
        own = {n.strip().lower() for names in CTE.findall(told) for n in names.split(",")}
        for name in RELATION.findall(told):
            if name.strip().lower() not in self._views() | own:
                if "," in name or self.spark.catalog.tableExists(name):
                    return "the statement reads more than the tables"
        return plan

    def _rows(self, sql: str, plan) -> DataFrame:
        """The rows of a query, or those that a change reads."""
        kind = plan.getClass().getSimpleName()
        if kind not in CHANGES:
            return self.spark.sql(sql)
        if kind == "InsertIntoStatement":
            from pyspark.sql.classic.dataframe import DataFrame as Rows

            made = Rows(self.spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(self.spark._jsparkSession, plan.query()), self.spark)
            listed = plan.userSpecifiedCols().size()
            wanted = listed or len(self.spark.table(_table(plan.table())).columns)
            if len(made.columns) != wanted:
                raise ValueError(f"{len(made.columns)} values for {wanted} columns")
            return made
        table = self.spark.table(_table(plan.table() if kind == "DeleteFromTable" else plan.children().apply(0)))
        cond = plan.condition()
        if kind == "DeleteFromTable":
            return table.filter(cond.sql())
        values = [plan.assignments().apply(k).value().sql() for k in range(plan.assignments().size())]
        found = table.filter(cond.get().sql()) if cond.isDefined() else table
        return found.select(*[F.expr(v) for v in values])

    def _run(self, work: Callable[[], object]) -> tuple[object, GateResult | None]:
        """The result of work in a job group that a timer cancels, or the failure that ended it."""
        context, group = self.spark.sparkContext, f"gate-{uuid.uuid4().hex}"
        late = threading.Event()

        def stop() -> None:
            late.set()
            context.cancelJobGroup(group)

        timer = threading.Timer(self.timeout, stop)
        context.setJobGroup(group, "gate", interruptOnCancel=True)
        timer.start()
        try:
            return work(), None
        except Exception as e:  # noqa: BLE001 - whatever a query raises is its result
            return None, GateResult(TIMEOUT, f"query timed out after {self.timeout} s") if late.is_set() else GateResult(FAILED, _message(e))
        finally:
            timer.cancel()
            context.setLocalProperty("spark.jobGroup.id", None)

    def check(self, sql: str | None, target: str | None = None) -> GateResult:
        """One deadline holds for the whole check. Without a target the query runs once, to its end; with one, query and
        target run once, side by side in the comparison."""
        sql = re.sub(r"[;\s]+$", "", sql or "")
        if not sql.strip():
            return GateResult(SYNTAX, "empty SQL")
        plan = self._plan(sql)
        if isinstance(plan, GateResult):
            return plan
        if isinstance(plan, str):
            return GateResult(UNSAFE_STATUS, plan)
        target = re.sub(r"[;\s]+$", "", target or "")
        wanted = self._plan(target) if target.strip() else None
        result, failure = self._run(lambda: self._outcome(sql, plan, target, wanted))
        return failure or result

    def _outcome(self, sql: str, plan, target: str, wanted) -> GateResult:
        rows = self._rows(sql, plan)
        if plan.getClass().getSimpleName() in CHANGES:
            rows.write.format("noop").mode("overwrite").save()
            return GateResult(PASSED) if self.allow_empty else GateResult(EMPTY, "no rows")
        if wanted is None:
            n = _count(rows)
            return GateResult(PASSED) if n or self.allow_empty else GateResult(EMPTY, "no rows")
        if isinstance(wanted, str):
            return GateResult(UNSAFE_STATUS, "the target: " + wanted)
        if isinstance(wanted, GateResult):
            return wanted
        try:
            goal = self._rows(target, wanted)
        except Exception as e:  # noqa: BLE001
            return GateResult(FAILED, "the target: " + _message(e))
        n, only, missing = compared(rows, goal)
        if not n and not self.allow_empty:
            return GateResult(EMPTY, "no rows")
        return GateResult(WRONG, "the result differs from the target's") if only or missing else GateResult(PASSED)

    def check_batch(self, queries: Iterable[tuple[str | None, str | None]], parallel: int = 4) -> list[GateResult]:
        """Results in the order of the (sql, target) pairs; up to `parallel` queries run at a time, each a Spark job of its own."""
        return in_threads(self.spark, lambda pair: self.check(*pair), list(queries), parallel)


def in_threads(spark: SparkSession, work: Callable, todo: list, parallel: int) -> list:
    """work of each item, in order; up to `parallel` at a time, each in a thread that has the session's properties of its own."""
    out: list = [None] * len(todo)
    errors: list[Exception] = []

    def one(k: int) -> None:
        def body() -> None:
            try:
                out[k] = work(todo[k])
            except Exception as e:  # noqa: BLE001 - raised again below
                errors.append(e)

        thread = InheritableThread(target=body, session=spark)
        thread.start()
        thread.join()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(one, range(len(todo))))
    if errors:
        raise errors[0]
    return out


@dataclass
class Repair:
    sql: str
    result: GateResult
    attempts: int
    history: list[dict]


def repair(gate: Gate, sql: str, target: str | None, fix: Callable[[str, GateResult], str], max_attempts: int = 3, first: GateResult | None = None) -> Repair:
    """first: the query's own check, if it is known. At most max_attempts fixes of a failing query, each made from the one before; stops at the first that passes.

    If fix raises, the history tells so and attempts counts as max_attempts.
    """
    result = first or gate.check(sql, target)
    history = [_entry(0, "initial", sql, result)]
    for k in range(1, max_attempts + 1):
        if result.passed:
            return Repair(sql, result, k - 1, history)
        try:
            sql = fix(sql, result)
        except Exception as e:  # noqa: BLE001 - the fixer is the caller's
            history.append({"attempt": k, "action": "fixer_error", "sql": sql, "status": result.status, "passed": False, "error_message": str(e)})
            return Repair(sql, result, max_attempts, history)
        result = gate.check(sql, target)
        history.append(_entry(k, "repair", sql, result))
    return Repair(sql, result, max_attempts, history)


def _entry(attempt: int, action: str, sql: str, r: GateResult) -> dict:
    return {"attempt": attempt, "action": action, "sql": sql, "status": r.status, "passed": r.passed, "error_message": r.error_message}


def gate_records(df: DataFrame, id_col: str) -> DataFrame:
    """(id, natural_language, sql, target_sql): what the gate checks; the target comes from metadata and is null if empty."""
    target = F.col("metadata")["target_sql"]
    return df.select(F.col(id_col).alias("id"), "natural_language", "sql", F.when(target != "", target).alias("target_sql"))


def annotated(metadata: Column, status: Column, error: Column, was_repaired: Column, attempts: Column, original_sql: Column, history: Column | None = None) -> Column:
    """metadata with the gate's entries added; an error, original or repair history (as JSON) that is null is left out."""
    entries = F.array(
        *[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in (("gate_status", status), ("gate_error", error), ("was_repaired", was_repaired), ("repair_attempts", attempts), ("original_sql", original_sql), *((("repair_history", history),) if history is not None else ()))]
    )
    added = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    empty = F.create_map().cast("map<string,string>")
    kept = F.map_filter(F.coalesce(metadata, empty), lambda k, _: ~F.map_contains_key(added, k))
    return F.map_concat(kept, added)


def attempts_by_example(results: DataFrame) -> DataFrame:
    """(example_id, first_status, first_passed, last_status, last_passed, attempts) from one row for each attempt.

    Repeated rows count once, since only the extremes of the attempts are used; a null flag is read from the status.
    """
    ok = F.coalesce(F.col("passed"), F.col("status") == PASSED)
    row = F.struct(F.col("attempt"), F.coalesce("status", F.lit("unknown")).alias("status"), F.coalesce(ok, F.lit(False)).alias("ok"))
    both = results.filter("example_id is not null").groupBy("example_id").agg(F.min(row).alias("a"), F.max(row).alias("z"))
    return both.select(
        "example_id", F.col("a.status").alias("first_status"), F.col("a.ok").alias("first_passed"), F.col("z.status").alias("last_status"), F.col("z.ok").alias("last_passed"), (F.col("z.attempt") - F.col("a.attempt")).alias("attempts")
    )


def gate_metrics(checked: DataFrame) -> DataFrame:
    """One row of counts and rates over attempts_by_example(). repair_attempts is the sum of attempts after the first."""
    agg = checked.agg(
        F.count("*").alias("total"),
        F.count_if("first_passed").alias("passed_first_try"),
        F.count_if(~F.col("first_passed")).alias("failed_first_try"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("repair_attempts"),
        F.count_if(F.col("attempts") > 0).alias("repaired_rows"),
        F.count_if(~F.col("first_passed") & F.col("last_passed")).alias("repair_success"),
        F.count_if("last_passed").alias("final_passed"),
        F.count_if(~F.col("last_passed")).alias("final_failed"),
    )
    rate = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6)
    return agg.select(
        "*", rate("passed_first_try", "total").alias("pass_rate_first_try"), rate("final_passed", "total").alias("pass_rate_final"),
        F.coalesce(rate("repair_success", "repair_attempts"), F.lit(0.0)).alias("repair_success_rate"),
    )


def failure_types(checked: DataFrame) -> DataFrame:
    """(status, n) of the first attempts, passed among them."""
    return checked.groupBy(F.col("first_status").alias("status")).agg(F.count("*").alias("n"))


def writer_and_fixer(checked: DataFrame) -> DataFrame:
    """One row: rows that failed first, those mended, and the share that passes in the end."""
    agg = checked.agg(
        F.count("*").alias("total"), F.count_if(~F.col("first_passed")).alias("attempts"), F.count_if(~F.col("first_passed") & F.col("last_passed")).alias("success"), F.count_if("first_passed").alias("ok")
    )
    share = F.coalesce(F.round(F.try_divide(F.col("success").cast("double"), F.col("attempts")), 6), F.lit(0.0))
    final = F.coalesce(F.round(F.try_divide((F.col("ok") + F.col("success")).cast("double"), F.col("total")), 6), F.lit(0.0))
    return agg.select("total", "attempts", "success", share.alias("success_rate"), final.alias("pass_rate"))


def execution_scores(gate: Gate, df: DataFrame, id_col: str, pred: str, target: str, chunk: int = 200) -> DataFrame:
    """(id, exec_accuracy): 1 where the predicted query gives the target query's rows at the gate, else 0; empty results count.

    Each different pair of texts is checked once. The driver schedules the checks, which are Spark jobs of their own, from
    an iterator, and appends their results to one table, chunk by chunk.
    """
    checker = Gate(gate.spark, gate.tables, gate.timeout, True, gate.allow_writes)
    rows = materialize(df.select(col(id_col).alias("id"), col(pred).alias("pred"), col(target).alias("target")), "predicted")
    todo = rows.select("pred", "target").distinct().filter("coalesce(target, '') <> ''").toLocalIterator(prefetchPartitions=True)
    path = table_path(gate.spark, "executed")
    schema = "p string, t string, ok boolean"
    gate.spark.createDataFrame([], schema).write.parquet(path)
    while part := list(islice(todo, chunk)):
        done = checker.check_batch([(r.pred, r.target) for r in part])
        gate.spark.createDataFrame([(r.pred, r.target, d.passed) for r, d in zip(part, done)], schema).write.mode("append").parquet(path)
    done = gate.spark.read.schema(schema).parquet(path)
    joined = rows.join(done, F.col("pred").eqNullSafe(F.col("p")) & F.col("target").eqNullSafe(F.col("t")), "left")
    return joined.select("id", F.coalesce(F.col("ok"), F.lit(False)).cast("double").alias("exec_accuracy"))
