"""Problem 6: records that differ in formatting only, collapsed and counted."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.texts import format_key
from pairloom.runtime import col, materialize

#: Bytes of different canonical records that a bucket may hold; a larger bucket is split by a further byte of the digest.
BUCKET_BYTES = 32 << 20
#: A map task folds its records in tries of at most so many bytes.
LOCAL_BYTES = 32 << 20
STRIDE = 32
#: Prefixes of an unusual depth are broadcast up to so many, of at most 50 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Bytes of a digest that may name a bucket: 256 ** 5 buckets, 3 * 10^19 bytes of different records at BUCKET_BYTES each.
MAX_DEPTH = 5


class Trie:
    """A trie over byte strings, STRIDE bytes to a level, that keeps a key's rest in a leaf until another key meets it.

    A terminal is [smallest id, ids seen or count]; add() returns it.
    """

    def __init__(self):
        self.root: dict = {}

    def add(self, key: bytes) -> list:
        node, at = self.root, 0
        while True:
            part = key[at : at + STRIDE]
            at += STRIDE
            got = node.get(part)
            if got is None:
                node[part] = leaf = (key[at:], [])
                return leaf[1]
            if isinstance(got, tuple):
                rest, terminal = got
                if rest == key[at:]:
                    return terminal
                node[part] = branch = {}
                branch[rest[:STRIDE]] = (rest[STRIDE:], terminal)
                got = branch
            node = got


def _emit(groups: list[tuple[list, bytes, str]]) -> pa.RecordBatch:
    ids, keep, tables, keys, counts = [], [], [], [], []
    for members, key, table in groups:
        least = min(members)
        head = members.index(least)
        for k, m in enumerate(members):
            ids.append(m)
            keep.append(least)
            tables.append(table)
            first = k == head
            keys.append(key if first else None)
            counts.append(len(members) if first else None)
    return pa.RecordBatch.from_arrays(
        [pa.array(tables, pa.string()), pa.array(ids, pa.int64()), pa.array(keep, pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64())],
        names=["table_name", "id", "local_keep", "canon", "n_local"],
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a map task folded in a trie: every id with its local group's smallest, the key once for a group."""
    trie, groups, size = Trie(), [], 0

    def drain():
        for at in range(0, len(groups), 20_000):
            yield _emit(groups[at : at + 20_000])

    for batch in batches:
        for table, i, canon in zip(*(batch.column(n).to_pylist() for n in ("table_name", "id", "canon"))):
            key = table.encode() + b"\x01" + canon
            members = trie.add(key)
            if not members:
                groups.append((members, canon, table))
                size += len(canon) + 200
            members.append(i)
            size += 40
        if size > LOCAL_BYTES:
            yield from drain()
            trie, groups, size = Trie(), [], 0
    yield from drain()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets, one after another, counted in a trie each: (table_name, local_keep, keep, n_copies) of each local group."""
    trie, held, bucket = Trie(), [], None

    def drain():
        for at in range(0, len(held), 20_000):
            part = held[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in part], pa.string()), pa.array([h[1] for h in part], pa.int64()), pa.array([h[2][0] for h in part], pa.int64()), pa.array([h[2][1] for h in part], pa.int64())],
                names=["table_name", "local_keep", "keep_id", "n_copies"],
            )

    for batch in batches:
        for b, table, i, canon, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "table_name", "local_keep", "canon", "n_local"))):
            if b != bucket:
                yield from drain()
                trie, held, bucket = Trie(), [], b
            terminal = trie.add(table.encode() + b"\x01" + canon)
            if terminal:
                terminal[0] = min(terminal[0], i)
                terminal[1] += n
            else:
                terminal += [i, n]
            held.append((table, i, terminal))
    yield from drain()


def canonical(df: DataFrame, table_name: str, id_col: str, text_cols: list[str]) -> DataFrame:
    """(table_name, id, canon): the canonical bytes of each record, lower-cased letters and digits of each field."""
    return df.select(F.lit(table_name).alias("table_name"), col(id_col).cast("bigint").alias("id"), format_key(text_cols).cast("binary").alias("canon")).filter("id is not null")


def parsed_lines(df: DataFrame, id_col: str, line_col: str, fields: dict[str, list[str]]) -> DataFrame:
    """(id, field...) of the lines that hold a JSON object; of a field's names, the first with a value counts.

    What is no text is written as JSON; null or missing gives null. Lines that are no valid JSON object are left out.
    """
    base = df.select(col(id_col).cast("bigint").alias("id"), col(line_col).cast("string").alias("line")).filter("line is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for i, line in zip(batch.column("id").to_pylist(), batch.column("line").to_pylist()):
                try:
                    o = json.loads(line)
                except (ValueError, RecursionError):
                    continue
                if isinstance(o, dict):
                    got = [next((o[n] for n in names if o.get(n) is not None), None) for names in fields.values()]
                    rows.append([i, *(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in got)])
            columns = list(zip(*rows)) if rows else [[] for _ in range(len(fields) + 1)]
            texts = [pa.array([None if v is None else v.encode("utf-8", "replace").decode() for v in c], pa.string()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *texts], names=["id", *fields])

    return base.mapInArrow(run, ", ".join(["id bigint", *(f"{f} string" for f in fields)]))


def bucket_depths(heads: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """(table_name, prefix, depth) and the number of bytes of prefix: how many leading bytes of the digest name a record's bucket.

    heads (table_name, canon, digest). The bytes of the different records below each prefix are summed in one pass; the
    depth of a record is the least at which its prefix holds at most bucket_bytes, or all bytes of prefix where a single
    key is larger than that. Digests spread keys evenly, so a byte beyond the depth that the mean needs always suffices.
    """
    distinct = heads.groupBy("table_name", "digest").agg(F.first(F.length("canon")).alias("n"))
    distinct = materialize(distinct.groupBy("table_name", F.substring("digest", 1, 2 * MAX_DEPTH).alias("prefix")).agg(F.sum("n").alias("n")), "prefixes")
    whole = distinct.groupBy("table_name").agg(F.sum("n").alias("n")).agg(F.max("n")).head()[0] or 0
    most = 1
    while most < MAX_DEPTH and bucket_bytes << (8 * (most - 1)) < whole:
        most += 1
    sized = distinct.groupBy("table_name", F.substring("prefix", 1, 2 * most).alias("prefix")).agg(F.sum("n").alias("n"))
    depth = F.lit(most)
    for d in range(most - 1, 0, -1):
        below = F.sum("n").over(Window.partitionBy("table_name", F.substring("prefix", 1, 2 * d)))
        depth = F.when(below <= bucket_bytes, F.lit(d)).otherwise(depth)
    return materialize(sized.select("table_name", "prefix", depth.alias("depth")), "depths"), most


class FormatDuplicates:
    """The collapsed records. Ids are unique within a table; a row repeated whole adds to its record's count.

    Null texts count as empty, so records without any letter or digit are copies of each other; rows with a null id are
    left out; an empty table gives no groups.
    """

    def __init__(self, records: DataFrame, bucket_bytes: int = BUCKET_BYTES):
        """records (table_name, id, canon) of one or more tables.

        1. Every map task folds its records in a trie, so that a shuffle carries a key once for each task, however many
           copies it has: a group that holds a third of all rows is spread over all tasks.
        2. The local groups go to radix buckets by the leading bytes of a digest of their canonical bytes (the bytes
           themselves begin alike, "select", and would need dozens of levels). A bucket whose different records take
           more than bucket_bytes is split by one byte more, and only such a bucket; see bucket_depths().
        3. Each bucket is counted in a trie over the whole canonical bytes, whose terminals hold smallest id and count.
           Local groups of one key are streamed through its terminal, so a key that stands in every map task needs no
           more memory than one that stands in one.
        """
        self.local = materialize(records.mapInArrow(_fold, "table_name string, id bigint, local_keep bigint, canon binary, n_local bigint"), "folded")
        heads = self.local.filter("canon is not null").withColumn("digest", F.md5("canon"))
        depths, most = bucket_depths(heads, bucket_bytes)
        prefixed = heads.withColumn("prefix", F.substring("digest", 1, 2 * most))
        counts = {r["depth"]: r["count"] for r in depths.groupBy("depth").count().collect()}  # a row for each depth
        usual = max(counts, key=lambda d: (counts[d], d), default=1)
        # digests spread keys evenly, so nearly all prefixes have one depth; only the others are looked up
        others, n = depths.filter(F.col("depth") != usual), sum(counts.values()) - counts.get(usual, 0)
        joined = prefixed.withColumn("depth", F.lit(usual))
        if n:
            others = others.withColumnRenamed("depth", "own")
            looked = prefixed.join(F.broadcast(others) if n <= BROADCAST_ROWS else others, ["table_name", "prefix"], "left")
            joined = looked.withColumn("depth", F.coalesce("own", F.lit(usual)))
        bucketed = joined.select(F.concat_ws(":", "table_name", F.expr("substring(prefix, 1, 2 * depth)")).alias("bucket"), "table_name", "local_keep", "canon", "n_local")
        counted = bucketed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count, "table_name string, local_keep bigint, keep_id bigint, n_copies bigint")
        self.groups = materialize(counted, "counted", dictionary=False)

    def counts(self) -> DataFrame:
        """(table_name, keep_id, n_copies): one row for each record that is kept, with the copies it had, itself included."""
        return self.groups.filter("local_keep = keep_id").select("table_name", "keep_id", "n_copies").distinct()

    def copies(self) -> DataFrame:
        """(table_name, keep_id, copy_id) of each record that is a copy."""
        moved = self.groups.filter("local_keep <> keep_id").select("table_name", "keep_id", F.col("local_keep").alias("copy_id"))
        folded = self.local.filter("id <> local_keep").select("table_name", "local_keep", F.col("id").alias("copy_id"))
        joined = folded.join(self.groups.select("table_name", "local_keep", "keep_id").distinct(), ["table_name", "local_keep"]).select("table_name", "keep_id", "copy_id")
        return moved.unionByName(joined)
