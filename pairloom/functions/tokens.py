"""Token columns: text of a record in any layout, token arrays, statistics, cutting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import tokens
from pairloom.runtime import col, fresh_name

LAYOUTS = ("text", "messages", "conversations", "prompt", "nl", "natural_language")


def record_text(df: DataFrame) -> Column:
    """The text of a record, from the first layout that df's columns have."""
    have = set(df.columns)
    if "text" in have:
        return col("text")
    if "messages" in have:
        return F.array_join(F.transform(col("messages"), lambda t: F.coalesce(t["content"], F.lit(""))), "\n")
    if "conversations" in have:
        return F.array_join(F.transform(col("conversations"), lambda t: F.coalesce(t["value"], F.lit(""))), "\n")
    for pair in (("prompt", "completion"), ("nl", "sql"), ("natural_language", "sql")):
        if set(pair) <= have:
            return F.concat(F.coalesce(col(pair[0]), F.lit("")), F.lit("\n"), F.coalesce(col(pair[1]), F.lit("")))
    raise ValueError(f"no text in columns {sorted(have)}; expected one of {LAYOUTS}")


def with_text(df: DataFrame, text: Column) -> DataFrame:
    """df with text in place of what record_text() read."""
    have = set(df.columns)
    if "text" in have:
        return df.withColumn("text", text)
    if "messages" in have:
        return df.withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), text.alias("content"))))
    if "conversations" in have:
        return df.withColumn("conversations", F.array(F.struct(F.lit("human").alias("from"), text.alias("value"))))
    if {"prompt", "completion"} <= have:
        return df.withColumn("prompt", text).withColumn("completion", F.lit(""))
    for pair in (("nl", "sql"), ("natural_language", "sql")):
        if set(pair) <= have:
            return df.withColumn("text", text).drop(*pair)
    raise ValueError(f"no text in columns {sorted(have)}")


def token_stats(df: DataFrame, count: Column) -> DataFrame:
    """One row: n, min, max, mean, median, p90, p95, p99 of token counts; percentiles are exact and interpolated."""
    cuts = F.percentile(F.col("_n"), F.array(*[F.lit(x) for x in (0.5, 0.9, 0.95, 0.99)]))
    agg = df.select(count.alias("_n")).agg(
        F.count("_n").alias("n"), F.min("_n").alias("min_tokens"), F.max("_n").alias("max_tokens"), F.avg("_n").alias("mean_tokens"), cuts.alias("_p")
    )
    named = [F.round(F.col("_p")[i], 1).alias(n) for i, n in enumerate(("median_tokens", "p90", "p95", "p99"))]
    return agg.select("n", "min_tokens", "max_tokens", F.round("mean_tokens", 1).alias("mean_tokens"), *named)


def length_report(df: DataFrame, count: Column, max_len: int) -> DataFrame:
    """One row: records, those within max_len and beyond it, and the percentage beyond."""
    agg = df.select(count.alias("_n")).agg(F.count("*").alias("n"), F.count_if(F.col("_n") <= max_len).alias("n_within"))
    over = F.col("n") - F.col("n_within")
    return agg.select("n", "n_within", over.alias("n_over"), F.round(F.coalesce(F.try_divide(over * 100.0, F.col("n")), F.lit(0.0)), 2).alias("pct_over"))


def chunked(df: DataFrame, ids: str, max_len: int, overlap: int = 0, strategy: str = "split") -> DataFrame:
    """df with a row for each chunk: its number (chunk) and its tokens in place of the array column ids.

    truncate keeps the first max_len tokens, drop only arrays that fit, split every chunk of max_len. Chunks start every
    max_len - overlap tokens up to the end, so the last ones may lie within the one before. The starts are exploded, not
    the chunks, so that the array is made once for a row and cut as it leaves.
    """
    if max_len < 1:
        raise ValueError("max_len must be 1 or more")
    tokens_, start = col(ids), fresh_name(df, "_start")
    if strategy == "truncate":
        return df.withColumn(ids, F.slice(tokens_, 1, max_len)).withColumn("chunk", F.lit(0))
    if strategy == "drop":
        return df.filter(F.size(tokens_) <= max_len).withColumn("chunk", F.lit(0))
    if strategy == "split":
        step = max(1, max_len - overlap)
        last = F.when(F.size(tokens_) <= max_len, F.lit(0)).otherwise(F.size(tokens_) - 1)
        rows = df.withColumn(start, F.explode(F.sequence(F.lit(0), last, F.lit(step))))
        return rows.withColumn(ids, F.slice(tokens_, F.col(start) + 1, max_len)).withColumn("chunk", F.floor(F.col(start) / step).cast("int")).drop(start)
    raise ValueError("strategy must be truncate, drop or split")


def word_tokens(df: DataFrame) -> Column:
    return tokens(record_text(df))


def tokenized(text: Column, tokenizer) -> Column:
    """Tokens of a text by a tokenizer: a function of columns, which stays in the JVM, or an object with encode(text), whose ids
    are made on Arrow batches. Null gives an empty array."""
    given = F.coalesce(text, F.lit(""))
    if callable(tokenizer):
        return tokenizer(given)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(tokenizer.encode(t)))

    return ids(given)
