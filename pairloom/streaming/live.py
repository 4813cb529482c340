"""Operators on arriving rows: event-time deduplication, windowed metric means, flags of overfitting."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pairloom.functions.text import fingerprint


def dedup_stream(df: DataFrame, fields: list[str], time_col: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of each set of rows that agree on the fields; state older than the watermark is dropped."""
    marked = df.withColumn("_fingerprint", fingerprint(fields)).withWatermark(time_col, delay)
    return marked.dropDuplicatesWithinWatermark(["_fingerprint"]).drop("_fingerprint")


def windowed_means(df: DataFrame, time_col: str, keys: list[str], value: str, size: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """(window_start, keys, n, mean) of a value over event-time windows; rows later than the watermark are left out."""
    marked = df.withWatermark(time_col, delay)
    window = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return marked.groupBy(window.alias("w"), *keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean")).select(F.col("w.start").alias("window_start"), *keys, "n", "mean")


def overfitting_stream(df: DataFrame, margin: float = 0.1) -> DataFrame:
    """(run_id, step, gap, flagged) for each arriving eval_loss, against the latest train_loss of its run so far.

    The state of a run is its last training step and loss, so it doesn't grow with the stream.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_step, loss = state.get if state.exists else (-1, None)
        rows = pd.concat(list(batches)).dropna(subset=["step", "value"]).sort_values(["step", "metric"], ascending=[True, False], kind="stable")
        out = []
        for metric, at, value in zip(rows["metric"], rows["step"], rows["value"]):
            if metric == "train_loss" and at >= last_step:
                last_step, loss = int(at), float(value)
            elif metric == "eval_loss" and loss is not None:
                out.append((key[0], int(at), round(value - loss, 6), bool(value - loss > margin)))
        state.update((last_step, loss))
        yield pd.DataFrame(out, columns=["run_id", "step", "gap", "flagged"])

    return df.groupBy("run_id").applyInPandasWithState(step, "run_id string, step bigint, gap double, flagged boolean", "last_step bigint, loss double", "append", GroupStateTimeout.NoTimeout)
