"""Problem 4: records of evaluation splits that also stand, exactly or nearly, in the training split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.wordjoin import RARE, linked_nodes, records
from pairloom.runtime import col, materialize

# How the names of the splits begin, as lower-cased letters.
SPLIT_NAMES = {"train": ("train",), "validation": ("val", "dev", "eval"), "test": ("test", "holdout", "heldout")}


def split_name(name: str) -> Column:
    """train, validation, test, or null for a null or unknown split; case, marks, blanks and what follows the name don't matter
    (" Train", "dev_set", "hold-out", "evaluation")."""
    letters = F.regexp_replace(F.lower(col(name).cast("string")), r"[^\p{L}]+", "")
    out = F.lit(None).cast("string")
    for split, starts in SPLIT_NAMES.items():
        for start in starts:
            out = F.when(letters.startswith(start), F.lit(split)).otherwise(out)
    return out


def split_overlaps(df: DataFrame, id_col: str, text_cols: list[str], split_col: str, source_col: str | None = None, threshold: float = 0.8, rare: int = RARE) -> DataFrame:
    """(train_id, eval_id, eval_split, train_source, eval_source, overlap, same_format) of each cross-split pair.

    A bipartite prefix join: side 0 is training, side 1 is evaluation, and only pairs of the two meet. Equal word sets
    are one key of both sides and need no prefix. Rows with a null or unknown split, a null id or no word have no pairs;
    null texts count as empty; rows repeated whole count as one row. An empty table gives no pairs.
    """
    split = split_name(split_col)
    source = col(source_col).cast("string") if source_col else F.lit(None).cast("string")
    placed = df.filter(split.isNotNull())
    recs = records(placed, id_col, text_cols, {"split": split, "source": source, "side": F.when(split == "train", 0).otherwise(1)})
    near = linked_nodes(recs, threshold, rare, bipartite=True)
    train = recs.filter("side = 0").select(F.col("node").alias("a"), F.col("id").alias("train_id"), F.col("source").alias("train_source"), F.col("fmt").alias("fmt_a")).distinct()
    held = recs.filter("side = 1").select(F.col("node").alias("b"), F.col("id").alias("eval_id"), F.col("split").alias("eval_split"), F.col("source").alias("eval_source"), F.col("fmt").alias("fmt_b")).distinct()
    pairs = near.join(train, "a").join(held, "b")
    return materialize(pairs.select("train_id", "eval_id", "eval_split", "train_source", "eval_source", "overlap", (F.col("fmt_a") == F.col("fmt_b")).alias("same_format")), "overlaps")


def overlap_report(pairs: DataFrame) -> DataFrame:
    """Per evaluation split and source of the evaluation row: its pairs, affected evaluation rows, training rows hit, exact pairs."""
    return pairs.groupBy("eval_split", "eval_source").agg(
        F.count("*").alias("n_pairs"),
        F.countDistinct("eval_id").alias("n_eval_rows"),
        F.countDistinct("train_id").alias("n_train_rows"),
        F.count_if(F.col("same_format")).alias("n_same_format"),
    )
