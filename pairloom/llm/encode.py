"""Problem 7: encoding a corpus with a public tokenizer, long texts in overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm import tokenizer as tok
from pairloom.runtime import col

#: Texts beyond CHUNK code points are encoded in chunks that reach OVERLAP code points into the next.
CHUNK, OVERLAP = 16_384, 512
TRANSITION = re.compile(r"\S(?=\s)")


def starts(text: str, lo: int, hi: int) -> list[int]:
    """Starts of pre-tokens in [lo, hi), found by scanning from a safe place before lo, or from the start of text.

    The match that reaches the end of text is cut short by it, so what follows a match counts only if it ends before.
    How a run of white space is divided depends on what follows it, so a start right behind white space doesn't count.
    """
    import regex

    pattern = regex.compile(tok.PATTERN)
    safe = 0
    for m in TRANSITION.finditer(text, max(0, lo - 256), lo):
        safe = m.end()
    if tok.SEPARATORS.search(text):
        safe = 0
    found = [0] if lo == 0 else []
    for m in pattern.finditer(text, safe):
        if m.end() >= hi or m.end() >= len(text):
            break
        if m.end() >= lo and not text[m.end() - 1].isspace():
            found.append(m.end())
    return found


def _bounds(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("piece").to_pylist()
            ints = pa.list_(pa.int32())
            head = pa.array([starts(t, 0, overlap) for t in texts], ints)
            tail = pa.array([[b - chunk for b in starts(t, chunk, chunk + overlap)] if len(t) > chunk else [] for t in texts], ints)
            yield pa.RecordBatch.from_arrays([*batch.columns, head, tail], names=[*batch.schema.names, "head", "tail"])

    return run


def encoder(column: str, name: str, folder: str, sizes_only: bool = False):
    """A mapInArrow function that replaces the text of a column by its ids, or by their number; null gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tok.load(name, folder).encode
        for batch in batches:
            k = batch.schema.get_field_index(column)
            ids = [encode(t) if t else [] for t in batch.column(k).to_pylist()]
            made = pa.array([len(x) for x in ids], pa.int64()) if sizes_only else pa.array(ids, pa.list_(pa.int32()))
            columns = list(batch.columns)
            columns[k] = made
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def encode(df: DataFrame, id_col: str, text_col: str, name: str, folder: str = tok.TOKENIZER_DIR, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, ids) of each row of df, without special tokens; what looks like a special token is ordinary text.

    Null and empty texts give an empty list; repeated rows give a row each, null ids stay null. Texts of up to `chunk`
    code points are encoded where they are read, without a shuffle. The distinct longer texts are cut into chunks that
    overlap, pre-tokenised in parallel, stitched at the first pre-token start that a chunk and the next one agree on
    (from there on both go on alike, as pre-tokens depend on nothing before them), and the pieces are encoded in parallel.
    A text with an overlap that has no common start is encoded in one piece. Ids of pieces are joined by their order.
    """
    base = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    if not tok.is_byte_level(name, folder):
        return base.mapInArrow(encoder("text", name, folder), f"id {kind}, text array<int>").withColumnRenamed("text", "ids")
    is_long = F.length(F.coalesce("text", F.lit(""))) > chunk
    short = base.filter(~is_long).mapInArrow(encoder("text", name, folder), f"id {kind}, text array<int>").withColumnRenamed("text", "ids")
    long_rows = base.filter(is_long).withColumn("digest", F.sha2("text", 256))
    texts = long_rows.groupBy("digest").agg(F.first("text").alias("text"))
    pieces = (
        texts.withColumn("n", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))))
        .select("digest", "n", F.substring("text", F.col("n") * chunk + 1, F.lit(chunk + overlap)).alias("piece"))
        .repartition("digest", "n")
        .mapInArrow(_bounds(chunk, overlap), "digest string, n int, piece string, head array<int>, tail array<int>")
    )
    order = Window.partitionBy("digest").orderBy("n")
    cut = F.when(F.col("n") == 0, 0).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(order))))
    stitched = pieces.withColumn("cut", cut).drop("head", "tail").withColumn("next", F.lead("cut").over(order)).withColumn("last", F.lead("n").over(order).isNull())
    stitched = stitched.withColumn("broken", F.max(F.col("cut").isNull()).over(Window.partitionBy("digest")))
    size = F.when(F.col("last"), F.length("piece")).otherwise(F.lit(chunk) + F.col("next")) - F.col("cut")
    # a text that can't be stitched is put together from the chunks again
    own = F.when(F.col("broken"), F.when(F.col("last"), F.col("piece")).otherwise(F.substring("piece", 1, chunk))).otherwise(F.col("piece").substr(F.col("cut") + 1, size))
    parts = stitched.select("digest", "n", "broken", own.alias("piece"))
    whole = parts.filter("broken").groupBy("digest").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "piece"))), lambda x: x["piece"]), "").alias("piece"))
    todo = parts.filter("not broken").select("digest", "n", "piece").unionByName(whole.select("digest", F.lit(0).alias("n"), "piece"))
    encoded = todo.repartition("digest", "n").mapInArrow(encoder("piece", name, folder), "digest string, n int, piece array<int>")
    joined = encoded.groupBy("digest").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "piece"))), lambda x: x["piece"])).alias("ids"))
    return short.unionByName(long_rows.select("id", "digest").join(joined, "digest").select("id", "ids"))


def decode(df: DataFrame, id_col: str, ids_col: str, name: str, folder: str = tok.TOKENIZER_DIR) -> DataFrame:
    """(id, text): the bytes of the ids one after another; null ids give a null text."""
    base = df.select(col(id_col).alias("id"), col(ids_col).alias("ids"))
    kind = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = tok.load(name, folder).decode
        for batch in batches:
            texts = pa.array([None if x is None else decoder(x) for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts], names=["id", "text"])

    return base.mapInArrow(run, f"id {kind}, text string")
