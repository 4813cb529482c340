"""Rebalancing of categories towards target proportions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import group_key
from pairloom.operators.ranking import permuted_rank
from pairloom.runtime import fresh_name

#: Draws that one task makes at a time.
BLOCK = 1_000_000
STRATEGIES = ("downsample", "upsample", "both")


def normalized(proportions: dict[str, float]) -> dict[str, float]:
    total = sum(proportions.values()) if proportions else 0
    if total <= 0:
        raise ValueError("proportions must have a positive sum")
    return {k: v / total for k, v in proportions.items()}


def target_counts(df: DataFrame, field: str, proportions: dict[str, float], strategy: str = "both") -> DataFrame:
    """(category, current, target) for each target category that df has.

    downsample scales by the category that is scarcest for its proportion and never grows one; upsample by the most
    abundant and never shrinks one; both takes the proportion of all rows, those outside the targets too. A target is 1 at
    least, except that with no positive proportion among the categories present, down- and upsample keep every category as is.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    shares = normalized(proportions)
    spark = df.sparkSession
    wanted = spark.createDataFrame([(str(k), float(v)) for k, v in shares.items()], "category string, share double")
    groups = df.groupBy(group_key(field).alias("category")).agg(F.count("*").alias("current"))
    joined = groups.join(F.broadcast(wanted), "category", "left")  # a row for each target category, given by the caller
    ratio = F.when(F.col("share") > 0, F.col("current") / F.col("share"))
    whole = groups.agg(F.sum("current")).scalar() if strategy == "both" else joined.agg((F.min if strategy == "downsample" else F.max)(ratio)).scalar()
    joined = joined.withColumn("scale", whole)
    sized = F.greatest(F.lit(1), F.bround(F.col("share") * F.col("scale")).cast("bigint"))
    if strategy == "downsample":
        sized = F.least("current", sized)
    elif strategy == "upsample":
        sized = F.greatest("current", sized)
    whole = F.col("scale").isNull()  # no category present has a positive share
    return joined.filter(F.col("share").isNotNull() | whole).select("category", "current", F.when(whole, F.col("current")).otherwise(sized).alias("target"))


def rebalance(df: DataFrame, field: str, proportions: dict[str, float], order: Column, strategy: str = "both", seed: int = 42) -> DataFrame:
    """df with each target category resized; categories outside the targets are dropped.

    A category that shrinks keeps the first rows of its permuted order (see permuted_rank). One that grows keeps all rows
    and adds draws with replacement: draw i repeats the row at rank hash(seed, category, i) modulo size. The draws are
    made once as (category, rank, copies), a row for each rank drawn, so that no row is multiplied in a shuffle.
    """
    sizes = target_counts(df, field, proportions, strategy)
    rank, size, cat, target, copies = (fresh_name(df, n) for n in ("_rank", "_size", "_cat", "_target", "_copies"))
    ranked = permuted_rank(df.withColumn(cat, group_key(field)), F.col(cat), order, seed, rank, size)
    plan = sizes.select(F.col("category").alias(cat), F.col("target").alias(target))
    kept = ranked.join(plan, cat).filter((F.col(rank) < F.col(target)) | (F.col(size) <= F.col(target)))
    extra = F.col("target") - F.col("current")
    blocks = sizes.filter("target > current").select("category", "current", extra.alias("extra"), F.explode(F.sequence(F.lit(0), F.floor((extra - 1) / BLOCK))).alias("k"))
    spread = blocks.repartition("category", "k")  # the draws of a large category are made in many tasks
    grown = spread.select("category", "current", F.explode(F.sequence(F.col("k") * BLOCK + 1, F.least((F.col("k") + 1) * BLOCK, F.col("extra")))).alias("i"))
    drawn = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "category", F.col("i").cast("string"))), 1, 12), 16, 10).cast("bigint"), F.col("current"))
    draws = grown.select(F.col("category").alias(cat), drawn.alias(rank)).groupBy(cat, rank).agg(F.count("*").alias(copies))
    out = kept.join(draws, [cat, rank], "left").withColumn(copies, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(copies), F.lit(0)))))
    return out.select(*[out[c] for c in df.columns])


def distribution(df: DataFrame, field: str) -> DataFrame:
    """(category, n, ratio) of a field's values; null is __unknown__."""
    counts = df.groupBy(group_key(field).alias("category")).agg(F.count("*").alias("n"))
    return counts.withColumn("ratio", F.round(F.col("n") / counts.agg(F.sum("n")).scalar(), 4))


def value_counts(df: DataFrame, field: str) -> DataFrame:
    return df.groupBy(group_key(field).alias("category")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def unknown_categories(df: DataFrame, field: str, proportions: dict[str, float]) -> DataFrame:
    """(category, n) of the categories that the proportions don't name, which rebalance() drops."""
    wanted = df.sparkSession.createDataFrame([(str(k),) for k in proportions], "category string")
    return df.groupBy(group_key(field).alias("category")).agg(F.count("*").alias("n")).join(F.broadcast(wanted), "category", "left_anti")  # the caller's plan
