"""Similarity of predicted and target texts. Exact match stays in the JVM; n-gram metrics run on Arrow batches."""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairloom.functions.porter import stem
from pairloom.functions.text import normalize_sql, normalize_text

BLEU_TOKEN = re.compile(r"[^\W]+|[^\s\w]")
ROUGE_BREAK = re.compile(r"[^a-z0-9]+")
EPSILON = 0.1
ROUGE_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("rouge1", "rouge2", "rougeL")])


def exact_match(pred: Column, target: Column) -> Column:
    return (normalize_sql(F.coalesce(pred, F.lit(""))) == normalize_sql(F.coalesce(target, F.lit("")))).cast("double")


def _grams(tokens: list[str], n: int) -> Counter:
    return Counter(zip(*(tokens[i:] for i in range(n))))


def bleu(pred: str, target: str) -> float:
    """Sentence BLEU of up to 4-grams with equal weights; n-grams that never match count EPSILON."""
    p, t = BLEU_TOKEN.findall(pred), BLEU_TOKEN.findall(target)
    if not t:
        return float(not p)
    logs = 0.0
    for n in range(1, 5):
        mine, theirs = _grams(p, n), _grams(t, n)
        hit = sum(min(c, theirs[g]) for g, c in mine.items())
        if n == 1 and not hit:
            return 0.0
        logs += math.log((hit or EPSILON) / max(1, sum(mine.values()))) / 4
    penalty = 1.0 if len(p) > len(t) else math.exp(1 - len(t) / len(p))
    return penalty * math.exp(logs)


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with one bit for each token of a."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    rows = full = (1 << len(a)) - 1
    for w in b:
        hit = rows & at.get(w, 0)
        rows = (rows + hit | rows - hit) & full
    return len(a) - rows.bit_count()


def _f1(hit: int, a: int, b: int) -> float:
    return 2 * hit / (a + b) if hit else 0.0


def rouge(pred: str, target: str, stemmed: bool = True) -> tuple[float, float, float]:
    """F-measures of 1-grams, 2-grams and the longest common subsequence of ASCII words."""
    words = [[w for w in ROUGE_BREAK.split(x) if w] for x in (pred, target)]
    if stemmed:
        words = [[stem(w) if len(w) > 3 else w for w in x] for x in words]
    p, t = words
    out = []
    for n in (1, 2):
        mine, theirs = _grams(p, n), _grams(t, n)
        out.append(_f1(sum((mine & theirs).values()), sum(mine.values()), sum(theirs.values())))
    return out[0], out[1], _f1(_common(p, t) if p and t else 0, len(p), len(t))


@pandas_udf(T.DoubleType())
def _bleu_udf(pred: pd.Series, target: pd.Series) -> pd.Series:
    return pd.Series([bleu(p, t) for p, t in zip(pred, target)], dtype="float64")


def _rouge_udf(stemmed: bool):
    @pandas_udf(ROUGE_TYPE)
    def run(pred: pd.Series, target: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([rouge(p, t, stemmed) for p, t in zip(pred, target)], columns=["rouge1", "rouge2", "rougeL"], dtype="float64")

    return run


def _plain(c: Column) -> Column:
    return normalize_text(F.coalesce(c, F.lit("")))


def bleu_score(pred: Column, target: Column) -> Column:
    return _bleu_udf(_plain(pred), _plain(target))


def rouge_scores(pred: Column, target: Column, stemmed: bool = True) -> Column:
    return _rouge_udf(stemmed)(_plain(pred), _plain(target))


#: The metric that runs queries; report.scored() makes it with a gate.
EXECUTION = "exec_accuracy"
#: Metrics by name: each makes a double column of a predicted and a target column.
METRICS = {
    "exact_match": exact_match,
    "bleu": bleu_score,
    "rouge1": lambda p, t: rouge_scores(p, t)["rouge1"],
    "rouge2": lambda p, t: rouge_scores(p, t)["rouge2"],
    "rougeL": lambda p, t: rouge_scores(p, t)["rougeL"],
}


def metric(name: str):
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(METRICS)}")
    return METRICS[name]


def register_metrics(spark) -> list[str]:
    """Make the text metrics SQL functions of their names (bleu, and rouge with fields rouge1, rouge2, rougeL); returns the names."""
    spark.udf.register("bleu", _bleu_udf)
    spark.udf.register("rouge", _rouge_udf(True))
    return ["bleu", "rouge"]
