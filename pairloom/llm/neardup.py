"""Problem 2: near-duplicate records with small edits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.unionfind import components
from pairloom.llm.wordjoin import BLOCK, HOT, RARE, linked_nodes, records
from pairloom.runtime import materialize


@dataclass
class NearDuplicates:
    """classes: id, node, fmt of each record with words; links: a, b, overlap between different word sets; alone: id of each record without words."""

    classes: DataFrame
    links: DataFrame
    alone: DataFrame

    def pairs(self) -> DataFrame:
        """Row pairs (id_a < id_b, overlap) that reach the threshold and are not format-equal."""
        return expand(self.links, self.classes, self.classes, F.col("fmt_a") != F.col("fmt_b"), within=True)

    def groups(self) -> DataFrame:
        """One row for each record: class_id (smallest id with the same words), group_id (smallest id that links of
        records lead to, also through others) and n_links, the number of other word sets linked to its own. A record
        without words is a class and a group of its own."""
        ids = self.classes.groupBy("node").agg(F.min("id").alias("class_id"))
        ends = self.links.select("a", "b").unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = ends.groupBy("a").agg(F.count("*").alias("n_links")).withColumnRenamed("a", "node")
        edge = self.links.join(ids.select(F.col("node").alias("a"), F.col("class_id").alias("u")), "a").join(
            ids.select(F.col("node").alias("b"), F.col("class_id").alias("v")), "b"
        )
        root = components(edge.select("u", "v"))
        named = ids.join(degree, "node", "left").join(root.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
        worded = self.classes.select("id", "node").join(named, "node").select(
            "id", "class_id", F.coalesce("root", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        )
        return worded.unionByName(self.alone.select("id", F.col("id").alias("class_id"), F.col("id").alias("group_id"), F.lit(0).cast("bigint").alias("n_links")))


def expand(links: DataFrame, left: DataFrame, right: DataFrame, keep, within: bool) -> DataFrame:
    """Row pairs of node links. within: pairs of one table, so that equal word sets are pairs as well."""
    a = left.select(F.col("node").alias("a"), F.col("id").alias("id_a"), F.col("fmt").alias("fmt_a"))
    b = right.select(F.col("node").alias("b"), F.col("id").alias("id_b"), F.col("fmt").alias("fmt_b"))
    rows = links.join(a, "a").join(b, "b").filter(keep & (F.col("id_a") != F.col("id_b")))
    if within:
        mixed = left.groupBy("node").agg(F.min("fmt").alias("lo"), F.max("fmt").alias("hi")).filter("lo <> hi").select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(1.0).alias("overlap"))
        same = mixed.join(a, "a").join(b, "b").filter((F.col("id_a") < F.col("id_b")) & keep)
        rows = rows.unionByName(same)
    return rows.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "overlap")


def near_duplicates(df: DataFrame, id_col: str, text_cols: list[str], threshold: float = 0.8, rare: int = RARE, hot: int = HOT, block: int = BLOCK) -> NearDuplicates:
    """Find the records of df whose word overlap reaches the threshold, by rare-first prefix filtering (see wordjoin).

    Null texts count as empty; records without any word, or with a null id, have no near-duplicates; repeated rows share
    one word set and are compared once; a row never pairs with itself, and rows repeated whole count as one row. Other
    columns of df are never read. An empty table gives empty results.
    """
    every = records(df, id_col, text_cols, wordless=True)
    recs = every.filter(F.size("words") > 0)
    links = materialize(linked_nodes(recs, threshold, rare, hot=hot, block=block), "word-links", dictionary=False)
    return NearDuplicates(recs.select("id", "node", "fmt").distinct(), links, every.filter(F.size("words") == 0).select("id").distinct())
