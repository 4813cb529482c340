"""Generated pairs through quality checks, the gate and repair, to accepted and rejected rows."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from pairloom.operators import gate as G
from pairloom.operators.filters import quality
from pairloom.runtime import materialize, table_path

#: Rows that are checked before their results are written; the driver holds no more of them.
CHUNK = 200
CHECKED = "id bigint, sql string, original_sql string, first_status string, last_status string, error string, attempts int, accepted boolean, history string"


@dataclass
class Generation:
    """checked: each pair that passed the quality checks, with what the gate said; rejected_early: the others."""

    pairs: DataFrame
    checked: DataFrame
    rejected_early: DataFrame

    def accepted(self) -> DataFrame:
        return self._annotated(True)

    def rejected(self) -> DataFrame:
        return self._annotated(False)

    def totals(self) -> DataFrame:
        """One row: generated, passed quality, passed the gate, repaired, rejected."""
        ok = F.col("accepted")
        counts = self.checked.agg(F.count("*").alias("passed_quality"), F.count_if(ok).alias("passed_gate"), F.count_if(ok & (F.col("attempts") > 0)).alias("repaired"))
        early = self.rejected_early.agg(F.count("*").alias("early"))
        return counts.select(
            (F.col("passed_quality") + early.scalar()).alias("generated"), "passed_quality", "passed_gate", "repaired", (F.col("passed_quality") - F.col("passed_gate") + early.scalar()).alias("rejected")
        )

    def _annotated(self, accepted: bool) -> DataFrame:
        rows = self.pairs.drop("sql").join(self.checked.filter(F.col("accepted") == accepted), "id")
        repaired = F.col("attempts") > 0
        meta = G.annotated(F.col("metadata"), F.col("last_status"), F.col("error"), repaired, F.col("attempts"), F.when(repaired, F.col("original_sql")), F.col("history"))
        return rows.withColumn("metadata", meta).select(*self.pairs.columns)


def _checked(row: Row, gate: G.Gate, fix: Callable | None, max_attempts: int) -> tuple:
    first = gate.check(row.sql, row.target_sql)
    sql, last, attempts, history = row.sql, first, 0, None
    if not first.passed and fix is not None:
        mended = G.repair(gate, sql, row.target_sql, fix, max_attempts, first)
        sql, last, attempts, history = mended.sql, mended.result, mended.attempts, json.dumps(mended.history)
    return row.id, sql, row.sql, first.status, last.status, last.error_message, attempts, last.passed, history


def run(pairs: DataFrame, gate: G.Gate, fix: Callable[[str, G.GateResult], str] | None = None, max_attempts: int = 3, parallel: int = 4) -> Generation:
    """pairs (id, natural_language, sql, metadata and more) through all stages.

    The cheap checks run on the whole table; each pair that passes is a query of its own at the gate, so the driver
    schedules those, chunk by chunk, up to `parallel` at a time, and each that fails is fixed by the same thread if there
    is a fixer. Chunks are appended to one table, which is read once at the end. metadata['target_sql'] is the target.
    """
    spark = pairs.sparkSession
    ok = quality(F.col("natural_language"), F.col("sql"))["passed"]
    judged = materialize(pairs.withColumn("_passed", ok), "judged")
    rows = G.gate_records(judged.filter("_passed"), "id").toLocalIterator(prefetchPartitions=True)
    path = table_path(spark, "checked")
    spark.createDataFrame([], CHECKED).write.parquet(path)
    while part := list(islice(rows, CHUNK)):
        done = G.in_threads(spark, lambda row: _checked(row, gate, fix, max_attempts), part, parallel)
        spark.createDataFrame(done, CHECKED).coalesce(1).write.mode("append").parquet(path)
    return Generation(judged.drop("_passed"), spark.read.schema(CHECKED).parquet(path), judged.filter("not _passed").drop("_passed"))
