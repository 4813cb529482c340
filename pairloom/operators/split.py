"""Random and stratified splits, their statistics, and few-shot selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.functions.text import group_key
from pairloom.operators.balance import normalized
from pairloom.operators.ranking import permuted_rank
from pairloom.runtime import fresh_name

DEFAULT_RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def bucket(rank: Column, size: Column, ratios: dict[str, float]) -> Column:
    """The split of a rank: consecutive runs of round(ratio * size) ranks, halves to even; the last takes the rest."""
    names = list(ratios)
    out, upto = None, F.lit(0)
    for name in names[:-1]:
        upto = upto + F.bround(F.lit(ratios[name]) * size).cast("bigint")
        out = F.when(rank < upto, F.lit(name)) if out is None else out.when(rank < upto, F.lit(name))
    return F.lit(names[-1]) if out is None else out.otherwise(F.lit(names[-1]))


def split(df: DataFrame, order: Column, ratios: dict[str, float] | None = None, stratify: str | None = None, seed: int = 42, name: str = "split") -> DataFrame:
    """df with a split column. Rows are put in a permuted order, within each category if stratify names one, and cut by ratios.

    order is a unique value of each row; the same seed and rows give the same splits, however the rows are partitioned.
    """
    shares = normalized(ratios or DEFAULT_RATIOS)
    rank, size = fresh_name(df, "_rank"), fresh_name(df, "_size")
    group = group_key(stratify) if stratify else F.lit("")
    ranked = permuted_rank(df, group, order, seed, rank, size)
    return ranked.withColumn(name, bucket(F.col(rank), F.col(size), shares)).drop(rank, size)


def split_stats(df: DataFrame, split_col: str = "split", field: str | None = None) -> DataFrame:
    """(split, category, n, ratio): sizes of the splits, with category null, and of each category within its split."""
    s = F.col(split_col).alias("split")
    if field is None:
        sizes = df.groupBy(s).agg(F.count("*").alias("n")).withColumn("category", F.lit(None).cast("string"))
        return sizes.select("split", "category", "n", F.round(F.col("n") / sizes.agg(F.sum("n")).scalar(), 4).alias("ratio"))
    cells = df.groupBy(s, group_key(field).alias("category")).agg(F.count("*").alias("n"))
    inner = cells.withColumn("ratio", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("split")), 4))
    outer = cells.groupBy("split").agg(F.sum("n").alias("n")).withColumn("category", F.lit(None).cast("string"))
    outer = outer.withColumn("ratio", F.round(F.col("n") / outer.agg(F.sum("n")).scalar(), 4))
    return outer.select("split", "category", "n", "ratio").unionByName(inner.select("split", "category", "n", "ratio"))


def few_shot(df: DataFrame, n: int, order: Column, mode: str = "random", difficulty: str | None = None, category: str | None = None, seed: int = 42) -> DataFrame:
    """n examples in a permuted order. category: from that category, or from all if there is none of it; difficulty: about
    70 % from that difficulty, the rest from the others."""
    key = fresh_name(df, "_key")
    keyed = df.withColumn(key, F.md5(F.concat(F.lit(f"{seed}:"), order.cast("string"))))

    def first(d: DataFrame, k: int) -> DataFrame:
        return d.orderBy(key, order).limit(max(0, k))

    if mode == "category" and category is not None:
        pool = keyed.filter(F.col("category") == category)
        keyed = pool if not pool.isEmpty() else keyed
    elif mode == "difficulty" and difficulty is not None:
        same = first(keyed.filter(F.col("difficulty") == difficulty), max(1, int(n * 0.7)))
        have = same.count()
        others = first(keyed.filter(F.coalesce(F.col("difficulty") != difficulty, F.lit(True))), n - have)
        return same.unionByName(others).drop(key)
    return first(keyed, n).drop(key)


def shuffled(df: DataFrame, order: Column, seed: int = 42) -> DataFrame:
    """df in a permuted order, the same for the same seed and rows."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), order.cast("string"))), order)


def first_rows(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The first n rows in the order of a column."""
    return df.orderBy(F.col(order_col)).limit(max(0, n))


def seed_subsets(df: DataFrame, requests: DataFrame, request_col: str, order: Column, k: int, seed: int = 42) -> DataFrame:
    """(request, nth, columns of df): k different rows of df for each request, or all of them where df has fewer.

    df is put in a permuted order once; a request takes k consecutive rows of it from a start that a hash of its value
    names, so a request is joined with its own rows and no others.
    """
    rank, size, at = fresh_name(df, "_rank"), fresh_name(df, "_size"), fresh_name(df, "_at")
    ranked = permuted_rank(df, F.lit(""), order, seed, rank, size)
    n = df.count()
    asked = requests.select(F.col(request_col).alias("request"), F.explode(F.sequence(F.lit(1), F.lit(max(1, min(k, n))))).alias("nth"))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("request").cast("string"))), 1, 12), 16, 10).cast("bigint")
    asked = asked.withColumn(at, F.pmod(start + F.col("nth") - 1, F.lit(max(1, n))))
    return asked.join(ranked, F.col(at) == F.col(rank)).drop(at, rank, size)
