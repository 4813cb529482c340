"""Exact set-similarity join on the words of records: rare-first prefixes, n-gram keys, length, position and suffix filters.

Two records are linked if their word sets x and y have |x & y| / |x | y| >= threshold. The steps:

1. Every record becomes the set of its words' hashes; records with the same set are one node, so copies never meet.
2. A frequency sketch of a fixed number of cells gives each word a rank class; words are ordered by class, then hash.
   Any total order is exact, so the sketch's collisions cost time only, and what is broadcast is bounded whatever the data.
3. Linked x and y share at least o words, and then the first |x| - o + k words of x and |y| - o + k words of y share at
   least k. So they agree on the first k shared words, each within its own prefix. A sequence of prefix words is a join key
   as soon as its expected number of holders is small: one rare word is enough, frequent words are extended to
   2-grams and more. Words that go together make some keys far more frequent than expected; a second sketch counts the
   keys so made, and those in hot cells are extended too, round by round, until no more can be. Whether a sequence is
   emitted depends on the sequence and the size range alone, so both sides emit the same key. Pairs are divided into
   ranges by their larger set, and each range has the longest sequences that its overlaps allow and its sizes can afford.
4. Keys that are hot even so are salted: a key of L holders is divided into blocks of BLOCK holders, and each pair of
   blocks is a key of its own, so no key has more than about BLOCK holders on either side, whatever the data.
5. The keys are joined once. A key row carries the size, the positions of its last word and a parity bitmap of the words
   behind it, which give the length, positional and suffix filters.
6. Surviving pairs are made distinct and verified once each against the whole word sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.texts import format_key, word_hashes
from pairloom.runtime import col, materialize

SKETCH_BITS = 18
#: The sketch of keys has 2**16 cells or more, so many that a cell holds about CELL_KEYS keys at most, but 2**30 at most.
KEY_BITS, CELL_KEYS, KEYS_A_RECORD = (16, 30), 2048, 16
#: The driver and the workers are told at most so many hot cells: those of more than a 2**-20 of all keys always.
MAX_HOT = 1 << 20
#: A sequence of words with at most this many expected holders is emitted as a key.
RARE = 256
#: A cell of the key sketch is hot if it holds more than this and four times the mean.
HOT = 512
#: Holders of a key that one block of a salted key has, about.
BLOCK = 4096
#: Rows of keys that one task joins, about.
TASK_KEYS = 250_000
#: Ranges of pairs by the size of their larger set: the largest size and the words of a key at most. Larger sets have longer
#: prefixes, whose sequences would be too many; the ranges of tiny sets have as many words as their overlaps are sure to.
RANGES = ((1, 1), (2, 2), (3, 3), (4, 4), (8, 4), (128, 5), (512, 3), (4096, 2), (1 << 40, 1))
#: Sequences that are extended at a time: what bounds a worker's memory, whatever a batch holds.
SLICE = 400_000
HASH_BITS = 55

KEY_FIELDS = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("meta", pa.int64()), ("bits", pa.int64()), ("side", pa.int32())])
KEY_SCHEMA = "key bigint, node bigint, meta bigint, bits bigint, side int"
#: What a row of a salted key is: partner of any row, or only of rows of the other role.
BOTH, FIRST, SECOND = 0, 1, 2


@dataclass(frozen=True)
class Threshold:
    num: int
    den: int

    @classmethod
    def of(cls, value: float) -> Threshold:
        f = Fraction(str(value))  # exact: 0.8 is 4/5
        if not Fraction(1, 2) <= f <= 1:
            raise ValueError("the threshold must lie between 0.5 and 1")
        return cls(f.numerator, f.denominator)


def records(df: DataFrame, id_col: str, text_cols: list[str], keep: dict | None = None, wordless: bool = False) -> DataFrame:
    """id, fmt (hash of the format key), words, node (hash of the word set) and the columns of keep; written once.

    Rows whose id is null or that hold no word have no links and are left out; wordless keeps the latter.
    """
    base = df.select(
        col(id_col).alias("id"),
        F.xxhash64(format_key(text_cols)).alias("fmt"),
        F.sort_array(word_hashes(text_cols)).alias("words"),
        *[c.alias(n) for n, c in (keep or {}).items()],
    )
    # node and the filter come after the table, else the words would be made again for each of them
    table = materialize(base, "records", dictionary=False)
    return table.withColumn("node", F.xxhash64("words")).filter(((F.size("words") > 0) | F.lit(wordless)) & F.col("id").isNotNull())


def frequency_classes(recs: DataFrame, bits: int = SKETCH_BITS) -> tuple[np.ndarray, int]:
    """A class (0 to 255, eight to a doubling) for each of 2**bits cells of word hashes, and the number of records.

    The driver receives at most 2**bits rows, whatever the size of the data.
    """
    cells = recs.select(F.explode("words").alias("w")).groupBy(F.col("w").bitwiseAND((1 << bits) - 1).cast("int").alias("cell")).agg(F.count("*").alias("n"))
    got = cells.toPandas()
    table = np.zeros(1 << bits, dtype=np.uint8)
    if len(got):
        table[got["cell"].to_numpy()] = np.minimum(255, np.floor(8 * np.log2(got["n"].to_numpy() + 1.0)))
    return table, recs.count()


def _mix(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One step of a 64-bit hash over a sequence."""
    h = (h ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class KeyMaker:
    """Turns batches of word sets into key rows. It is sent to the Python workers with the sketches' broadcasts."""

    def __init__(self, table, total: int, t: Threshold, rare: int, bits: int, block: int, hot=None, loads=None):
        """hot, loads: broadcasts of (sorted cells, holders), of the cells whose sequences are extended and of those whose keys are salted."""
        self.table, self.total, self.t, self.rare, self.block, self.hot, self.load = table, max(1, total), t, rare, block, hot, loads
        self.shift = np.uint64(64 - bits)

    def held(self, told, h: np.ndarray) -> np.ndarray:
        """The holders of each hash's cell, 0 for a cell that isn't told."""
        cells, loads = told.value
        cell = (h >> self.shift).astype(np.int64)
        at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
        return np.where(cells[at] == cell, loads[at], 0)

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many keys, and how many that can be extended, fall into each cell of the key sketch."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def told() -> pa.RecordBatch:
            cell, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            open_end = np.concatenate([m for _, m in held])
            n, more = np.bincount(at, minlength=len(cell)), np.bincount(at, weights=open_end, minlength=len(cell)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64()), pa.array(more, pa.int64())], names=["cell", "n", "more"])

        size = 0
        for h, _, _, _, open_end, _ in self.sequences(batches):
            held.append(((h >> self.shift).astype(np.int64), open_end))
            size += len(h)
            if size > 2_000_000:
                yield told()
                held, size = [], 0
        if held:
            yield told()

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, node, meta, bits, _, side in self.sequences(batches):
            yield from self.salted(h, node, meta, bits, side)

    def salted(self, h, node, meta, bits, side):
        """Key rows of sequences; the rows of a key with more than a block of holders go to a row and a column of pairs of blocks."""
        blocks = np.ones(len(h), dtype=np.int64)
        if self.load is not None:
            blocks = np.maximum(1, -(-self.held(self.load, h) // self.block))
        out = [(h[blocks == 1], node[blocks == 1], meta[blocks == 1], bits[blocks == 1], side[blocks == 1])]
        hot = np.flatnonzero(blocks > 1)
        mine = (_mix(np.full(len(hot), 7, dtype=np.uint64), node[hot].view(np.uint64)) % blocks[hot].astype(np.uint64)).astype(np.int64)
        for role in (FIRST, SECOND):
            at = 0
            while at < len(hot):  # as many rows at a time as a slice holds
                upto = at + max(1, int(np.searchsorted(np.cumsum(blocks[hot[at:]]), SLICE)))
                some, own = hot[at:upto], mine[at:upto]
                src = np.repeat(np.arange(len(some)), blocks[some])
                other = np.arange(len(src)) - np.repeat(np.cumsum(blocks[some]) - blocks[some], blocks[some])
                i, j = (own[src], other) if role == FIRST else (other, own[src])
                r = some[src]
                out.append((_mix(_mix(h[r], i + 1), j + 1), node[r], meta[r], bits[r], side[r] + 2 * role))
                at = upto
        for key, *rest in out:
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), *rest)], names=KEY_FIELDS.names).cast(KEY_FIELDS)

    def sequences(self, batches: Iterator[pa.RecordBatch]):
        """(hash, node, meta, bits, whether it can be extended, side) arrays of the emitted sequences of all records."""
        cells = self.table.value
        expected = 2.0 ** (np.arange(256) / 8.0) - 1
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            node = batch.column("node").to_numpy(zero_copy_only=False)
            side = batch.column("side").to_numpy(zero_copy_only=False)
            fresh = np.ones(len(node), dtype=bool)
            for k, pair in enumerate(zip(node.tolist(), side.tolist())):  # copies within a partition are joined once
                fresh[k] = pair not in seen
                seen.add(pair)
            if len(seen) > 2_000_000:
                seen.clear()
            words = batch.column("words").filter(pa.array(fresh))
            if fresh.any():
                yield from self.keys(node[fresh], side[fresh], words, cells, np.int64(len(cells) - 1), expected)

    def keys(self, node, side, words, cells, mask, expected):
        offsets = words.offsets.to_numpy().astype(np.int64)
        flat = words.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        size = np.diff(offsets)
        rec = np.repeat(np.arange(len(size)), size)
        cls = cells[flat & mask]
        ordered = (cls.astype(np.int64) << HASH_BITS) | (flat & np.int64((1 << HASH_BITS) - 1))
        order = np.lexsort((ordered, rec))
        flat, cls = ordered[order], cls[order]
        freq = np.maximum(expected[cls], 1.0)
        pos = np.arange(len(flat)) - offsets[rec]
        # parity bitmaps of the words from each position on: a running xor from the end, less what lies in later records
        bit = np.uint64(1) << (flat.astype(np.uint64) % np.uint64(64))
        run = np.bitwise_xor.accumulate(bit[::-1])[::-1]
        run = np.append(run, np.uint64(0))
        tail = run[offsets[1:]]
        need = -(-self.t.num * size // self.t.den)
        prefix = size - need + 1
        up = size * self.t.den // self.t.num  # the largest partner
        lo = 0
        for regime, (hi, words_most) in enumerate(RANGES):
            depth = min(words_most, -(-self.t.num * (lo + 1) // self.t.den))  # sets of lo + 1 words share at least so many
            at = np.flatnonzero(((size <= hi) & (up > lo))[rec] & (pos < prefix[rec]))
            start = np.full(len(at), regime, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for h, r, last, k in self.extend(_mix(start, flat[at]), freq[at], rec[at], at, 1, depth, flat, freq, offsets, size, prefix):
                meta = (size[r] << 34) | ((last - offsets[r]) << 4) | k
                yield h, node[r], meta, (run[last + 1] ^ tail[r]).view(np.int64), np.full(len(h), k < depth), side[r]
            lo = hi

    def extend(self, h, holders, r, last, k, depth, flat, freq, offsets, size, prefix):
        """(hash, record, flat index of the last word, k) of the sequences that few records hold; the others are extended by
        each later word of the (k+1)-prefix, a slice of them at a time."""
        if self.hot is not None:
            holders = np.maximum(holders, self.held(self.hot, h))
        done = (holders <= self.rare) | (k == depth)
        if done.any():
            yield h[done], r[done], last[done], k
        h, holders, r, last = h[~done], holders[~done], r[~done], last[~done]
        end = offsets[r] + np.minimum(prefix[r] + k, size[r])
        room = np.maximum(end - last - 1, 0)
        total = np.cumsum(room)
        at = 0
        while at < len(h):
            upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
            part = room[at:upto]
            src = np.repeat(np.arange(at, upto), part)
            nxt = last[src] + 1 + np.arange(len(src)) - np.repeat(np.cumsum(part) - part, part)
            if len(src):
                yield from self.extend(_mix(h[src], flat[nxt]), holders[src] * freq[nxt] / self.total, r[src], nxt, k + 1, depth, flat, freq, offsets, size, prefix)
            at = upto


def _meta(side: str) -> tuple:
    m = F.col(f"{side}.meta")
    return F.shiftrightunsigned(m, 34), F.shiftrightunsigned(m, 4).bitwiseAND((1 << 30) - 1), m.bitwiseAND(15)


def key_rows(recs: DataFrame, t: Threshold, rare: int = RARE, bipartite: bool = False, hot: int = HOT, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The key rows of all records, and about their number: sequences are counted and extended until no hot cell has one
    that can be, then those of cells beyond a block are salted. The counts stay distributed; the driver and the workers
    are told only the hot cells, of which there are at most MAX_HOT because each has more than a MAX_HOT-th of all keys."""
    table, total = frequency_classes(recs)
    bits = min(KEY_BITS[1], max(KEY_BITS[0], (KEYS_A_RECORD * total // CELL_KEYS).bit_length()))
    spread = recs.sparkSession.sparkContext.broadcast
    maker = KeyMaker(spread(table), total, t, rare, bits, block)
    source = recs.select("node", "words", F.col("side").cast("int") if bipartite else F.lit(0).alias("side"))
    known: dict[int, int] = {}

    def told(loads: dict[int, int]):
        cells = sorted(loads)
        return spread((np.array(cells, dtype=np.int64), np.array([loads[c] for c in cells], dtype=np.int64))) if cells else None

    while True:
        counted = source.mapInArrow(maker.counts, "cell bigint, n bigint, more bigint").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("more").alias("more"))
        counted = materialize(counted, "key-counts")
        n_keys = counted.agg(F.sum("n")).head()[0] or 0
        noise, share = 4 * n_keys / (1 << bits), n_keys // MAX_HOT
        over = counted.filter((F.col("more") > 0) & (F.col("n") > max(hot + noise, share))).select("cell", "n").collect()
        fresh = {c: n for c, n in over if c not in known}
        if not fresh:
            break
        known |= fresh
        maker = KeyMaker(maker.table, total, t, rare, bits, block, told(known))
    # a cell's load is its hottest key's, but for about the mean of the others
    large = dict(counted.filter(F.col("n") > max(block + noise, share)).select("cell", (F.col("n") - int(noise / 4)).alias("n")).collect())
    maker = KeyMaker(maker.table, total, t, rare, bits, block, maker.hot, told(large))
    return source.mapInArrow(maker, KEY_SCHEMA), n_keys + sum(n * 2 * -(-n // block) for n in large.values())


def candidates(recs: DataFrame, t: Threshold, rare: int = RARE, bipartite: bool = False, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Distinct node pairs (a, b) that pass all filters. With bipartite, a is of side 0 and b of side 1, and they may be equal."""
    keys, n = key_rows(recs, t, rare, bipartite, hot, block)
    tasks = max(int(recs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // TASK_KEYS)
    # rows of one node from several map tasks become one where the join reads them
    keys = keys.repartition(tasks, "key").groupBy("key", "node", "side", "meta", "bits").count().drop("count")
    a, b = keys.alias("a"), keys.alias("b")
    (sa, pa_, k), (sb, pb, _) = _meta("a"), _meta("b")
    both = sa + sb
    needed = F.ceil(F.lit(t.num) * both / F.lit(t.num + t.den) - F.lit(1e-9))
    role_a, role_b = (F.shiftright(f"{x}.side", 1) for x in "ab")
    # conditions on both sides at once, so that none is pushed to one side: the keys are made and shuffled once for both
    roles = (3 * role_a + role_b).isin(3 * BOTH + BOTH, 3 * BOTH + SECOND, 3 * FIRST + BOTH, 3 * FIRST + SECOND)
    side = 2 * F.col("a.side").bitwiseAND(1) + F.col("b.side").bitwiseAND(1) == 1 if bipartite else F.col("a.node") < F.col("b.node")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & side & roles).filter(
        (sa * t.den >= sb * t.num)
        & (sb * t.den >= sa * t.num)
        & (k + F.least(sa - pa_, sb - pb) - 1 >= needed)  # position: what may still be shared behind the last key word
        & (pa_ + pb + 2 - 2 * k + F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= both - 2 * needed)  # suffix
    )
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def verified(recs: DataFrame, pairs: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b, overlap) whose whole word sets meet the threshold; each pair is verified once."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = recs.select("node", "words").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("words").alias("words"))
    left = sets.select(F.col("node").alias("a"), F.col("words").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("words").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    sizes = F.size("x") + F.size("y")
    met = pairs.join(left, "a").join(right, "b").withColumn("shared", shared).withColumn("sizes", sizes)
    good = F.col("shared") * (t.num + t.den) >= F.col("sizes") * t.num
    return met.filter(good).select("a", "b", (F.col("shared") / (F.col("sizes") - F.col("shared"))).alias("overlap"))


def linked_nodes(recs: DataFrame, threshold: float, rare: int = RARE, bipartite: bool = False, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Node pairs (a, b, overlap) of different word sets whose overlap reaches the threshold (bipartite: equal sets too)."""
    t = Threshold.of(threshold)
    pairs = materialize(candidates(recs, t, rare, bipartite, hot, block), "word-pairs", dictionary=False)
    return verified(recs, pairs, t)
