"""Scores of predictions, overall and by group, and comparisons of models."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import metrics as M
from pairloom.functions.text import filled
from pairloom.operators.ranking import positions
from pairloom.runtime import col

GROUPS = ("category", "difficulty")
# The summary of a comparison; verdicts on a student by its share of the teacher's scores, in percent.
BETTER, TIED = "{0} is better on {1}/{2} metrics", "Models are tied across metrics"
VERDICTS = ((90.0, "EXCELLENT"), (75.0, "GOOD"), (60.0, "ACCEPTABLE"))
WORST = "NEEDS WORK"


def scored(df: DataFrame, pred: str, target: str, names: list[str], gate=None, id_col: str | None = None) -> DataFrame:
    """df with a column for each metric, each made once for a row; the ROUGE measures share one pass.

    exec_accuracy runs both queries at the gate and needs one, and a column of unique ids.
    """
    if M.EXECUTION in names:
        if gate is None or id_col is None:
            raise ValueError(f"{M.EXECUTION} needs a gate and an id column")
        from pairloom.operators.gate import execution_scores

        done = execution_scores(gate, df, id_col, pred, target).withColumnRenamed("id", "_id")
        joined = scored(df, pred, target, [n for n in names if n != M.EXECUTION]).join(done, col(id_col) == F.col("_id"), "left")
        return joined.drop("_id")
    for n in names:
        M.metric(n)
    out = df
    rouge = [n for n in names if n.startswith("rouge")]
    if rouge:
        out = out.withColumn("_rouge", M.rouge_scores(F.col(pred), F.col(target)))
        for n in rouge:
            out = out.withColumn(n, F.col("_rouge")[n])
        out = out.drop("_rouge")
    for n in names:
        if not n.startswith("rouge"):
            out = out.withColumn(n, M.metric(n)(F.col(pred), F.col(target)))
    return out


def evaluate(df: DataFrame, names: list[str], groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """(group_kind, group_value, n, metric columns): means over all rows and over each value of each group, in one pass.

    A null group value is unknown. No rows give no scores.
    """
    filled = df.select(*[F.coalesce(F.col(g).cast("string"), F.lit("unknown")).alias(g) for g in groups], *names)
    means = [F.round(F.avg(n), 6).alias(n) for n in names]
    sets = filled.groupingSets([[], *[[F.col(g)] for g in groups]], *[F.col(g) for g in groups]).agg(F.count("*").alias("n"), *[F.grouping(g).alias(f"_{g}") for g in groups], *means)
    kind, value = F.lit("overall"), F.lit("")
    for g in groups:
        kind = F.when(F.col(f"_{g}") == 0, F.lit(g)).otherwise(kind)
        value = F.when(F.col(f"_{g}") == 0, F.col(g)).otherwise(value)
    return sets.filter("n > 0").select(kind.alias("group_kind"), value.alias("group_value"), "n", *names)


def long_scores(evaluated: DataFrame, names: list[str], model: str) -> DataFrame:
    """(model, group_kind, group_value, metric, score)."""
    return evaluated.unpivot(["group_kind", "group_value"], names, "metric", "score").select(F.lit(model).alias("model"), "group_kind", "group_value", "metric", "score")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """(metric, model_a, model_b, delta, improved) of two sets of (metric, score); a metric that one lacks counts 0 there."""
    x = a.select("metric", F.col("score").alias("sa"))
    y = b.select("metric", F.col("score").alias("sb"))
    both = x.join(y, "metric", "full_outer").select("metric", F.coalesce("sa", F.lit(0.0)).alias("sa"), F.coalesce("sb", F.lit(0.0)).alias("sb"))
    delta = F.col("sb") - F.col("sa")
    return both.select("metric", F.round("sa", 4).alias("model_a"), F.round("sb", 4).alias("model_b"), F.round(delta, 4).alias("delta"), (delta > 0).alias("improved"))


def comparison_summary(compared: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """One row: wins of each model and who is better."""
    agg = compared.agg(F.count_if("improved").alias("wins_b"), F.count_if(~F.col("improved") & (F.col("delta") < 0)).alias("wins_a"), F.count("*").alias("n_metrics"))

    better = lambda model, wins: filled(BETTER, F.lit(model), F.col(wins), F.col("n_metrics"))
    text = F.when(F.col("wins_b") > F.col("wins_a"), better(model_b, "wins_b")).when(F.col("wins_a") > F.col("wins_b"), better(model_a, "wins_a")).otherwise(F.lit(TIED))
    return agg.withColumn("summary", text)


def parity(compared: DataFrame) -> DataFrame:
    """One row: the mean percentage of model a's scores that model b reaches, over metrics where a has any."""
    return compared.filter("model_a > 0").agg(F.round(F.avg(F.col("model_b") / F.col("model_a") * 100), 4).alias("parity_pct"), F.count("*").alias("n_metrics"))


def parity_verdict(pct: Column) -> Column:
    """The verdict on a percentage of parity; null for null."""
    out = F.when(pct.isNull(), F.lit(None).cast("string"))
    for least, said in VERDICTS:
        out = out.when(pct >= least, F.lit(said))
    return out.otherwise(F.lit(WORST))


def zipped(left: DataFrame, right: DataFrame, left_order: str, right_order: str, strict: bool = True) -> DataFrame:
    """The columns of both, row by row in the order of each side's own order column (unique values): first with first.

    strict fails unless both have as many rows; else the longer side is cut. The position of a row is its rank over ranges
    of the order column, so no task sorts a whole side. Columns of the same name are kept twice under right_ names.
    """
    if strict and left.count() != right.count():
        raise ValueError("the sides differ in length")
    a, b = positions(left, left_order, "_at"), positions(right, right_order, "_at")
    taken = {c.lower() for c in left.columns}
    named = b.select("_at", *[col(c).alias(f"right_{c}" if c.lower() in taken else c) for c in right.columns])
    return a.join(named, "_at").drop("_at")


def benchmark_row(scores: DataFrame, model: str, names: list[str], seconds: float) -> DataFrame:
    """One row of a report: the model, its examples, the mean of each metric to four digits, and examples a second."""
    means = [F.round(F.avg(n), 4).alias(n) for n in names]
    rate = F.round(F.count("*") / F.lit(float(seconds)), 2) if seconds > 0 else F.lit(0.0)
    return scores.agg(F.lit(model).alias("model"), F.count("*").alias("n"), *means, rate.alias("per_second"))


def judged(df: DataFrame, judge, columns: list[str], id_col: str) -> DataFrame:
    """(id, score, error) by a function of the caller that scores a row's columns; it runs in the tasks, on Arrow batches.

    A call that raises, or gives no whole number from 1 to 5, scores 0 and tells why, and doesn't end the others.
    """
    base = df.select(col(id_col).alias("id"), *[col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns)])

    def run(batches):
        for batch in batches:
            scores, errors = [], []
            for values in zip(*(batch.column(k + 1).to_pylist() for k in range(len(columns)))):
                try:
                    got = int(judge(*values))
                    if not 1 <= got <= 5:
                        raise ValueError(f"score {got}")
                    scores.append(got)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the judge is the caller's
                    scores.append(0)
                    errors.append(str(e) or type(e).__name__)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.int32()), pa.array(errors, pa.string())], names=["id", "score", "error"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, score int, error string")


def judge_mean(df: DataFrame, score: str) -> DataFrame:
    """One row: mean of the scores above 0 (0 stands for an error), rows judged and rows in error."""
    value = F.when(F.col(score) > 0, F.col(score))
    return df.agg(F.round(F.coalesce(F.avg(value), F.lit(0.0)), 3).alias("mean_score"), F.count(value).alias("num_judged"), F.count_if(F.coalesce(F.col(score), F.lit(0)) <= 0).alias("num_errors"))


def judge_distribution(df: DataFrame, score: str) -> DataFrame:
    """(score, n) for 1 to 5, zeros included."""
    every = df.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("score"))
    counts = df.groupBy(F.col(score).cast("int").alias("score")).agg(F.count("*").alias("n"))
    return every.join(counts, "score", "left").select("score", F.coalesce("n", F.lit(0)).alias("n"))


def throughput(n: int, seconds: float) -> float:
    return round(n / seconds, 2) if seconds > 0 else 0.0
