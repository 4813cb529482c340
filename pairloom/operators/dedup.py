"""Exact and fuzzy deduplication."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import fingerprint, tokens
from pairloom.runtime import col, fresh_name, materialize

PRIME = (1 << 31) - 1
#: Rows of buckets that one task decides in order.
TASK_ROWS = 2_000_000


def exact_dedup(df: DataFrame, fields: list[str], order_col: str, keep: str = "first") -> DataFrame:
    """One row of each set of rows that agree on the fields as text: the first or last by order_col, which is unique.

    Null counts as empty text. The survivors are found by an aggregate of fingerprint and order alone, which is combined
    before its shuffle, so neither wide rows nor a key with a third of all rows go to one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be first or last")
    pick = F.min if keep == "first" else F.max
    name = fresh_name(df, "_kept")
    kept = df.groupBy(fingerprint(fields).alias("_f")).agg(pick(col(order_col)).alias(name)).select(name)
    return df.join(kept, col(order_col) == F.col(name), "left_semi")


def best_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows of a band with the least mean of false positives and false negatives around the threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")

    def area(lo: float, hi: float, f) -> float:
        step = (hi - lo) / 200 if hi > lo else 0
        return sum(f(lo + (i + 0.5) * step) for i in range(200)) * step

    best = (math.inf, 1, 1)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            met = lambda s: 1 - (1 - s**r) ** b  # noqa: B023, E731
            error = 0.5 * area(0, threshold, met) + 0.5 * area(threshold, 1, lambda s: 1 - met(s))  # noqa: B023
            if error < best[0]:
                best = (error, b, r)
    return best[1], best[2]


def permutations(num_perm: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of num_perm affine permutations modulo PRIME: a linear congruential sequence from the seed."""
    x, out = seed % PRIME or 1, []
    for _ in range(2 * num_perm):
        x = x * 48271 % PRIME
        out.append(x)
    return np.array(out[:num_perm], dtype=np.int64), np.array(out[num_perm:], dtype=np.int64)


def band_keys(flat: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each list of hashes and each band: a hash of the band's number and its least permuted values."""
    filled = np.flatnonzero(np.diff(offsets))
    keys = np.empty((len(offsets) - 1, bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(len(offsets) - 1, band + 1, dtype=np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                low = np.full(len(offsets) - 1, PRIME, dtype=np.int64)
                if len(filled):  # lists without values lie between the starts of others and take no part
                    low[filled] = np.minimum.reduceat((flat * a[k] + b[k]) % PRIME, offsets[filled])
                key = (key ^ low.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
            keys[:, band] = key
    return keys.view(np.int64)


def _banded(threshold: float, num_perm: int, seed: int):
    bands, rows = best_bands(threshold, num_perm)
    a, b = permutations(num_perm, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
            keys = band_keys(flat, offsets - offsets[0], a, b, bands, rows)
            ends = np.arange(0, keys.size + 1, bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("pos"), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))], names=["pos", "bands"])

    return run


def token_hashes(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """(pos, hashes): the 28-bit md5 hashes of a text's distinct tokens, sorted."""
    words = F.array_distinct(tokens(col(text_col).cast("string")))
    hashed = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("bigint"))
    return df.select(col(order_col).cast("bigint").alias("pos"), F.array_sort(F.array_distinct(hashed)).alias("hashes"))


def _classes(df: DataFrame, text_col: str, order_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(k, pos): the first row of each token set; (pos, hashes): the sets of those first rows; (k, pos): the set of every row."""
    hashed = materialize(token_hashes(df, text_col, order_col).withColumn("k", F.sha2(F.array_join("hashes", ","), 256)), "tokens")
    first = hashed.groupBy("k").agg(F.min("pos").alias("pos"))
    return first, hashed.select("pos", "hashes").join(first.select("pos"), "pos", "left_semi"), hashed.select("k", "pos")


def minhash_pairs(df: DataFrame, text_col: str, order_col: str, threshold: float = 0.85, num_perm: int = 128, seed: int = 42) -> DataFrame:
    """(pos_a, pos_b): pairs of rows, the earlier first, whose MinHash signatures agree on a whole band.

    Rows with one token set are one class, joined by its first row only; a band key meets different sets alone.
    minhash_links adds the other rows of the classes.
    """
    _, sets, _ = _classes(df, text_col, order_col)
    return _band_pairs(sets, threshold, num_perm, seed)


def minhash_links(df: DataFrame, text_col: str, order_col: str, threshold: float = 0.85, num_perm: int = 128, seed: int = 42) -> DataFrame:
    """(pos_a, pos_b, same_tokens): the pairs of minhash_pairs, and every other row of a class with the class's first row.

    Two rows are candidates exactly if their first rows are one row or a pair, so every link of rows follows from the
    result, and n copies add n - 1 rows to it rather than a row for every two of them.
    """
    first, sets, members = _classes(df, text_col, order_col)
    near = _band_pairs(sets, threshold, num_perm, seed).withColumn("same_tokens", F.lit(False))
    heads = first.select("k", F.col("pos").alias("pos_a"))
    same = members.withColumnRenamed("pos", "pos_b").hint("merge").join(heads, "k").filter("pos_a < pos_b")
    return near.unionByName(same.select("pos_a", "pos_b", F.lit(True).alias("same_tokens")))


def _band_rows(sets: DataFrame, threshold: float, num_perm: int, seed: int) -> DataFrame:
    """(pos, v): the band keys of each set; a key holds its band's number."""
    return sets.mapInArrow(_banded(threshold, num_perm, seed), "pos bigint, bands array<bigint>").select("pos", F.explode("bands").alias("v"))


def _band_pairs(sets: DataFrame, threshold: float, num_perm: int, seed: int) -> DataFrame:
    keys = _band_rows(sets, threshold, num_perm, seed)
    a, b = keys.alias("a"), keys.alias("b")
    met = a.join(b, (F.col("a.v") == F.col("b.v")) & (F.col("a.pos") < F.col("b.pos")))
    return met.select(F.col("a.pos").alias("pos_a"), F.col("b.pos").alias("pos_b")).distinct()


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows to drop among those of one task, in the order of pos."""
    parts = [(b.column("pos").to_numpy(zero_copy_only=False), b.column("v").to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return
    pos, v = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(pos, kind="stable")
    pos, v = pos[order], np.unique(v, return_inverse=True)[1][order].tolist()
    starts = np.flatnonzero(np.diff(pos, prepend=pos[0] - 1)).tolist()
    taken: set[int] = set()
    gone = []
    for lo, hi in zip(starts, [*starts[1:], len(v)]):
        if taken.isdisjoint(v[lo:hi]):
            taken.update(v[lo:hi])
        else:
            gone.append(int(pos[lo]))
    yield pa.RecordBatch.from_arrays([pa.array(gone, pa.int64())], names=["pos"])


def bucket_drops(members: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(pos): rows to drop, so that a row stays exactly if it shares no bucket with an earlier row that stays.

    members (pos, v): the buckets v of each row; the rows of a bucket are all partners of each other, and are never written
    as pairs. A round keeps each row that is the first undecided one of all its buckets, and drops what shares a bucket
    with it, so that a bucket of any size is decided by its first row. A chain a-b-c keeps a and c. Rounds work on the rows
    that are still undecided, and end when those fit in one task (task_rows), which decides them in order; so only chains
    of rows waiting for each other among more than task_rows rows cost a round for each link.
    """
    spark = members.sparkSession
    sizes = members.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1")
    left = materialize(members.join(sizes.select("v"), "v", "left_semi").select("pos", "v"), "open")
    found: list[DataFrame] = []
    while left.count() > task_rows:
        first = left.groupBy("v").agg(F.min("pos").alias("m"))
        kept = left.join(first, "v").groupBy("pos").agg(F.bool_and(F.col("pos") == F.col("m")).alias("first")).filter("first").select("pos")
        kept = materialize(kept, "kept")
        taken = first.join(kept.withColumnRenamed("pos", "m"), "m")  # a row that is kept is the first of its buckets
        gone = materialize(left.join(taken, "v").filter("pos <> m").select("pos").distinct(), "gone")
        found.append(gone)
        left = materialize(left.join(kept.unionByName(gone), "pos", "left_anti"), "open")
    found.append(materialize(left.coalesce(1).mapInArrow(_one_by_one, "pos bigint"), "gone"))
    return spark.read.schema("pos bigint").parquet(*[f for d in found for f in d.inputFiles()]) if any(d.inputFiles() for d in found) else found[-1]


def greedy_drops(pairs: DataFrame) -> DataFrame:
    """(pos): rows to drop, so that a row stays exactly if no earlier row that stays is paired (pos_a, pos_b) with it."""
    pair = F.concat_ws(":", F.least("pos_a", "pos_b").cast("string"), F.greatest("pos_a", "pos_b").cast("string"))
    return bucket_drops(pairs.filter("pos_a <> pos_b").select(F.explode(F.array("pos_a", "pos_b")).alias("pos"), pair.alias("v")).distinct())


def fuzzy_dedup(df: DataFrame, text_col: str, order_col: str, threshold: float = 0.85, num_perm: int = 128, seed: int = 42) -> DataFrame:
    """df without the rows that resemble an earlier row that stays, in the order of order_col (a unique integer).

    Candidates are rows whose MinHash signatures agree on a band; they aren't verified further. All texts without tokens
    resemble each other, so the first stays; null counts as empty.
    """
    first, sets, _ = _classes(df, text_col, order_col)
    gone = bucket_drops(_band_rows(sets, threshold, num_perm, seed))
    name = fresh_name(df, "_pos")
    stay = first.select("pos").join(gone, "pos", "left_anti").withColumnRenamed("pos", name)
    return df.join(stay, col(order_col) == F.col(name), "left_semi")
