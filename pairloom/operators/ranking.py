"""Ranks within groups of any size: no task sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.runtime import col, fresh_name, materialize

#: Rows of a bin, about; a bin is named by leading hexadecimal digits of the order's hash.
BIN_ROWS = 50_000


def bin_digits(n: int) -> int:
    """Digits that name bins of about BIN_ROWS rows of n."""
    digits = 1
    while digits < 8 and n > BIN_ROWS << 4 * digits:
        digits += 1
    return digits


def shuffle_key(seed: int, order: Column) -> Column:
    """The permuted order of a row: md5 of the seed and the row's order value. It depends on no partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), order.cast("string")))


def permuted_rank(df: DataFrame, group: Column, order: Column, seed: int, rank: str, size: str) -> DataFrame:
    """df with each row's rank (from 0) in its group's permuted order, and the group's size.

    A rank is the number of rows in the group's lower hash bins plus the rank within the bin. The counts of the bins are
    aggregated before their shuffle, and a window runs over one bin of a group, so a group that holds a third of all
    rows is ranked by many tasks. Equal hashes are ordered by the order value.
    """
    key, part, first = (fresh_name(df, n) for n in ("_hash", "_group", "_bin"))
    keyed = df.withColumn(part, group).withColumn(key, F.coalesce(shuffle_key(seed, order), F.lit("")))
    keyed = keyed.withColumn(first, F.substring(key, 1, bin_digits(df.count())))
    before, of, nth, held = (fresh_name(keyed, n) for n in ("_before", "_of", "_nth", "_held"))
    bins = keyed.groupBy(F.col(part).alias(of), F.col(first).alias(nth)).agg(F.count("*").alias(held))
    lower = Window.partitionBy(of).orderBy(nth).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(of, nth, F.coalesce(F.sum(held).over(lower), F.lit(0)).alias(before), F.sum(held).over(Window.partitionBy(of)).alias(size))
    joined = keyed.join(bins, F.col(part).eqNullSafe(F.col(of)) & (F.col(first) == F.col(nth))).drop(of, nth)
    inside = Window.partitionBy(part, first).orderBy(key, order)
    return joined.withColumn(rank, (F.col(before) + F.row_number().over(inside) - 1).cast("bigint")).drop(key, part, first, before)


def positions(df: DataFrame, order_col: str, name: str) -> DataFrame:
    """df with each row's number from 0 in the order of a column of unique values.

    The rows are divided into ranges of the column; a number is the count of the rows in the ranges before and the rank
    within the range. The ranges are written once, so that both see the same ones.
    """
    at, before = fresh_name(df, "_range"), fresh_name(df, "_before")
    parts = max(1, min(df.count() // BIN_ROWS + 1, 100_000))
    ranged = materialize(df.repartitionByRange(parts, col(order_col)).withColumn(at, F.spark_partition_id()), "ranged")
    held = ranged.groupBy(at).agg(F.count("*").alias("n"))
    held = held.select(at, F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))  # a row for each range
    inside = Window.partitionBy(at).orderBy(col(order_col))
    return ranged.join(held, at).withColumn(name, (F.col(before) + F.row_number().over(inside) - 1).cast("bigint")).drop(at, before)
