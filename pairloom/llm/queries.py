"""The pN_ queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import defects, encode, formatdup, neardup, overlap, packing, proportions, related, spam
from pairloom.runtime import read_table, spread_table

Query = Callable[[SparkSession, str], DataFrame]
PAIR = ["natural_language", "sql"]


#: Shares of the rows in the splits of problem 3.
RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def _sample(spark: SparkSession, sf_dir: str) -> proportions.ProportionalSample:
    return proportions.ProportionalSample(read_table(spark, sf_dir, "generated_examples"), read_table(spark, sf_dir, "sampling_targets"), "example_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).unmet()


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).report()


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).sample().withColumnRenamed("id", "example_id")


def p1_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).report().drop("drawn")


def p1_plan_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).plan_sizes()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR]), "example_id", PAIR)
    return found.pairs().select(F.col("id_a").alias("example_id_a"), F.col("id_b").alias("example_id_b"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR]), "example_id", PAIR)
    return found.groups().withColumnRenamed("id", "example_id")


def _related(spark: SparkSession, sf_dir: str) -> related.RelatedGroups:
    rows = related.schema_records(read_table(spark, sf_dir, "seeds"), read_table(spark, sf_dir, "generation_jobs"))
    return related.RelatedGroups(rows, read_table(spark, sf_dir, "schema_registry"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _related(spark, sf_dir).grouped()


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _related(spark, sf_dir).split(RATIOS)


def p3_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return related.split_checks(_related(spark, sf_dir).split(RATIOS), RATIOS)


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.split_overlaps(spread_table(spark, sf_dir, "seeds", ["seed_id", *PAIR, "split", "source"]), "seed_id", PAIR, "split", "source")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _overlaps(spark, sf_dir)
    return pairs.select(F.least("train_id", "eval_id").alias("seed_id_a"), F.greatest("train_id", "eval_id").alias("seed_id_b"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_report(_overlaps(spark, sf_dir))


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.flagged(spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR]), "example_id", "natural_language", "sql")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir).withColumnRenamed("id", "example_id")


def _collapsed(spark: SparkSession, sf_dir: str) -> formatdup.FormatDuplicates:
    examples = formatdup.canonical(spread_table(spark, sf_dir, "generated_examples", ["example_id", *PAIR]), "generated_examples", "example_id", PAIR)
    lines = formatdup.parsed_lines(read_table(spark, sf_dir, "raw_lines"), "line_id", "line", {"natural_language": ["natural_language", "nl"], "sql": ["sql"]})
    return formatdup.FormatDuplicates(examples.unionByName(formatdup.canonical(lines, "raw_lines", "id", PAIR)))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collapsed(spark, sf_dir).copies()


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collapsed(spark, sf_dir).counts()


#: The tokenizer that problems 7 and 8 name.
TOKENIZER = "byte_bpe_50k"


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(spread_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text", TOKENIZER).withColumnRenamed("id", "doc_id")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sizes(spread_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]), "doc_id", "text", "source", TOKENIZER)


def _specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "container_specs").filter(F.col("tokenizer") == TOKENIZER).select("spec_id", "capacity")


def _packed(items: DataFrame, specs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    return packing.pack(items, [packing.Spec(r.spec_id, r.capacity) for r in specs.collect()], targets=targets)


def _even_targets(items: DataFrame) -> DataFrame:
    """As many tokens of each source as of any other, for as long as it has any."""
    return items.select("source").distinct().withColumn("share", F.lit(1.0))


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(_sizes(spark, sf_dir), _specs(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _specs(spark, sf_dir)
    return packing.report(_packed(_sizes(spark, sf_dir), specs), specs)


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invariants of packing to target proportions."""
    specs, items = _specs(spark, sf_dir), _sizes(spark, sf_dir)
    return packing.checks(items, _packed(items, specs, _even_targets(items)), specs)


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of each source that have a window, with even targets."""
    items = _sizes(spark, sf_dir)
    targets = _even_targets(items)
    made = packing.mixture(packing.schedule(items, targets=targets), targets)
    return made.select(F.when(F.col("source") != "\x00", F.col("source")).alias("source"), "n_items")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.judged_pages(spread_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).filter("spam").select(F.col("id").alias("doc_id"))


def p9_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.shape_report(_pages(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("p") and name[1:2].isdigit()}
