"""Problem 1: a sample that matches target proportions of categories."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.runtime import col, materialize

#: Rows of a hash bin of the permuted order, about; only the bin in which a quota is reached is drawn in part.
BIN_ROWS = 50_000
ANY = "*"


@dataclass
class Target:
    target_id: int
    plan_id: int
    difficulty: str
    category: str
    share: float
    min_rows: int
    fraction: float
    matching: int = 0
    available: int = 0
    size: int = 0
    need: int = 0
    quota: int = 0
    taken: int = 0

    @property
    def plan(self) -> tuple[int, float]:
        return self.plan_id, self.fraction

    @property
    def short(self) -> int:
        return max(0, self.need - self.matching)


def label(name: str) -> Column:
    """A label without regard to case, outer blanks and how its words are joined; null is empty."""
    text = F.regexp_replace(F.lower(F.coalesce(col(name).cast("string"), F.lit(""))), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.regexp_replace(text, r"[\s\p{Z}_-]+", "_")


def _any_label(name: str) -> Column:
    return F.when(col(name).isNull(), F.lit(ANY)).otherwise(label(name))


def read_targets(targets: DataFrame) -> list[Target]:
    """The plans, which their caller writes; the driver holds them, as it does any plan."""
    rows = targets.select("target_id", "plan_id", _any_label("difficulty").alias("d"), _any_label("category").alias("c"), "target_share", "min_rows", "sample_fraction").orderBy("plan_id", "target_id").collect()
    return [Target(r[0], r[1], r[2], r[3], r[4] or 0.0, r[5] or 0, r[6] or 0.0) for r in rows]


def _give(amount: int, cells: list[tuple[Target, float]], room) -> int:
    """Add amount to the cells' rows by their weights, none beyond its room, by largest remainder; returns what none could take."""
    while amount > 0:
        free = [(t, w) for t, w in cells if room(t) > 0]
        weight = sum(w for _, w in free)
        if not free:
            break
        exact = [(amount * w / weight if weight > 0 else amount / len(free), t) for t, w in free]
        left = amount - sum(math.floor(x) for x, _ in exact)
        given = 0
        for k, (x, t) in enumerate(sorted(exact, key=lambda e: (math.floor(e[0]) - e[0], e[1].target_id))):
            more = min(math.floor(x) + (k < left), room(t))
            t.taken += more
            given += more
        if not given:
            break
        amount -= given
    return amount


def _take(amount: int, cells: list[Target]) -> None:
    """Take amount back from cells in proportion to their slack above their minimums, by largest remainder."""
    slack = [(t, t.taken - min(t.min_rows, t.taken)) for t in cells]
    whole = sum(x for _, x in slack)
    amount = min(amount, whole)
    exact = [(amount * x / whole if whole else 0.0, x, t) for t, x in slack]
    left = amount - sum(math.floor(e) for e, _, _ in exact)
    for e, x, t in sorted(exact, key=lambda v: (math.floor(v[0]) - v[0], v[2].target_id)):
        back = math.floor(e)
        if left > 0 and back < x:
            back, left = back + 1, left - 1
        t.taken -= back


def allocate(targets: list[Target], total: int) -> list[Target]:
    """Quotas of each plan, from the root down: a cell's share of the sample, no less than its min_rows.

    The sample is divided among the families (categories), each family's part among its cells, by largest remainder. A
    minimum beyond a cell's part is paid by all cells in proportion to what they hold above their own minimums. What a
    cell lacks goes to its siblings (cells of the same category), what they lack to its cousins, by shares. Minimums that
    together exceed the sample are kept, and the sample is that much larger. Targets of one plan that name different
    sample_fractions are plans of their own, each over its own size.
    """
    for plan in sorted({t.plan for t in targets}):
        cells = [t for t in targets if t.plan == plan]
        size = math.floor(cells[0].fraction * total)
        for t in cells:
            t.size = size
            t.need = max(t.min_rows, math.floor(t.share * size + 0.5))
        families: dict[str, list[Target]] = {}
        for t in cells:
            families.setdefault(t.category, []).append(t)
        weight = sum(t.share for t in cells) or 1.0
        # top down: whole rows to families by largest remainder, then within each family
        quota = _largest_remainder(size, {c: sum(t.share for t in f) / weight for c, f in families.items()})
        for c, f in families.items():
            inner = sum(t.share for t in f) or 1.0
            own = _largest_remainder(quota[c], {t.target_id: t.share / inner for t in f})
            for t in f:
                t.quota = max(own[t.target_id], t.min_rows)
                t.taken = min(t.quota, t.available)
        _take(max(0, sum(t.taken for t in cells) - size), cells)
        spare = lambda t: t.available - t.taken
        for f in families.values():
            lacking = sum(max(0, t.quota - t.available) for t in f)
            _give(min(lacking, max(0, size - sum(t.taken for t in cells))), [(t, t.share) for t in f], spare)
        _give(max(0, size - sum(t.taken for t in cells)), [(t, t.share) for t in cells], spare)
    return targets


def _largest_remainder(amount: int, shares: dict) -> dict:
    exact = {k: amount * s for k, s in shares.items()}
    got = {k: math.floor(x) for k, x in exact.items()}
    left = min(amount - sum(got.values()), len(got))
    for k in sorted(exact, key=lambda k: (got[k] - exact[k], str(k)))[: max(0, left)]:
        got[k] += 1
    return got


class ProportionalSample:
    def __init__(self, df: DataFrame, targets: DataFrame, id_col: str, difficulty_col: str = "difficulty", category_col: str = "category", seed: int = 42):
        """Counts the cells in one pass (pre-aggregated) and allocates the quotas.

        A cell is a difficulty, a category and a hash bin of the id; a row belongs to the most specific target that matches
        it (both labels, then the category, then the difficulty, then any). Repeated rows are rows of their own, as they
        are in the table's count. Null labels count as empty ones, which only a target of any label matches; rows with a
        null id count, but can't be drawn. The driver gets one row for each target. An empty table leaves all targets unmet.
        """
        self.seed = seed
        base = df.select(col(id_col).alias("id"), label(difficulty_col).alias("d"), label(category_col).alias("c"))
        self.targets = read_targets(targets)
        self.spark = df.sparkSession
        self.total = df.count()  # of a Parquet table, from its footers
        self.bits = max(6, min(24, (self.total // BIN_ROWS).bit_length()))
        wanted_d = sorted({t.difficulty for t in self.targets} - {ANY})
        wanted_c = sorted({t.category for t in self.targets} - {ANY})
        # labels that no target names are one, so that a free text makes no cells of its own
        named = lambda c, wanted: F.when(F.col(c).isin(wanted), F.col(c)).otherwise(F.lit("")).alias(c)
        self.rows = base.select("id", named("d", wanted_d), named("c", wanted_c), F.xxhash64("id", F.lit(seed)).alias("h"))
        bin_of = F.shiftrightunsigned("h", 64 - self.bits).cast("int")
        self.cells = materialize(self.rows.groupBy("d", "c", bin_of.alias("bin")).agg(F.count("*").alias("n"), F.count("id").alias("n_ids")), "cells")
        self.owned = materialize(self._owners(), "owners")
        for r in self.owned.groupBy("target_id").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("owner"), F.col("n_ids"))).alias("n_ids")).collect():
            for t in self.targets:
                if t.target_id == r["target_id"]:
                    t.matching, t.available = r["n"], r["n_ids"] or 0
        allocate(self.targets, self.total)

    def _plan_table(self) -> DataFrame:
        schema = "target_id bigint, plan int, kd string, kc string, mask bigint, quota bigint"
        plans = {p: k for k, p in enumerate(sorted({t.plan for t in self.targets}))}
        return self.spark.createDataFrame([(t.target_id, plans[t.plan], t.difficulty, t.category, _mask(self.seed, plans[t.plan]), t.taken) for t in self.targets], schema)

    def _owners(self) -> DataFrame:
        """(target_id, plan, d, c, n, n_ids, owner) of each target and each pair of labels that it matches; owner: the pair's rows are drawn for it."""
        pairs = self.cells.groupBy("d", "c").agg(F.sum("n").alias("n"), F.sum("n_ids").alias("n_ids"))
        levels = F.array(*[F.struct(F.lit(k).alias("level"), kd.alias("kd"), kc.alias("kc")) for k, (kd, kc) in enumerate(((F.col("d"), F.col("c")), (F.lit(ANY), F.col("c")), (F.col("d"), F.lit(ANY)), (F.lit(ANY), F.lit(ANY))))])
        keyed = pairs.withColumn("k", F.explode(levels)).select("d", "c", "n", "n_ids", "k.level", "k.kd", "k.kc")
        hits = keyed.join(self._plan_table().drop("quota", "mask"), ["kd", "kc"])
        first = Window.partitionBy("plan", "d", "c").orderBy("level", "target_id")
        return hits.select("target_id", "plan", "d", "c", "n", "n_ids", (F.row_number().over(first) == 1).alias("owner"))

    def report(self) -> DataFrame:
        """Per target: rows needed, matching, drawn, and how many the rows fall short of the need."""
        data = [(t.target_id, t.plan_id, t.size, t.need, t.matching, t.taken, t.short) for t in self.targets]
        return self.spark.createDataFrame(data, "target_id bigint, plan_id bigint, sample_size bigint, needed bigint, matching bigint, drawn bigint, short bigint")

    def sample(self) -> DataFrame:
        """(plan_id, target_id, id, draw_rank): the drawn rows of each plan.

        A target's rows are put in a permuted order and the first `drawn` are taken by rank. The order is that of the id's
        seeded hash, in which each plan flips bits of its own; the flipped upper bits name the bin, so the bins counted
        once give every plan's ranks: rows in lower bins, and the rank within the bin. The counted bins also tell
        the last bin that a quota reaches, by which rows are left out where they are read: what is shuffled is the sample
        and at most a bin more for each target, and a target that holds a third of all rows is ranked in many tasks.
        """
        low = F.col("bin").bitwiseXOR(F.shiftrightunsigned("mask", 64 - self.bits).cast("int"))
        plan = self._plan_table().filter("quota > 0").select("target_id", "mask", "quota")
        mine = self.owned.filter("owner").select("target_id", "d", "c")
        per_bin = self.cells.join(mine, ["d", "c"]).join(plan, "target_id").groupBy("target_id", "mask", "quota", low.alias("bin")).agg(F.sum("n_ids").alias("n"))
        before = Window.partitionBy("target_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        per_bin = materialize(per_bin.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("offset < quota"), "bins")
        last = per_bin.groupBy("target_id", "mask", "quota").agg(F.max("bin").alias("last"))
        table = materialize(mine.join(last, "target_id"), "draws")  # a row for each target and pair of labels
        turned = F.col("h").bitwiseXOR(F.col("mask"))
        rows = self.rows.filter("id is not null").join(table, ["d", "c"]).withColumn("h", turned).withColumn("bin", F.shiftrightunsigned("h", 64 - self.bits).cast("int")).filter("bin <= last")
        placed = rows.select("target_id", "bin", "id", "h").join(per_bin.select("target_id", "bin", "offset", "quota"), ["target_id", "bin"])
        ranked = placed.withColumn("draw_rank", F.col("offset") + F.row_number().over(Window.partitionBy("target_id", "bin").orderBy("h", "id")))
        plans = self.spark.createDataFrame([(t.target_id, t.plan_id) for t in self.targets], "target_id bigint, plan_id bigint")
        return ranked.filter("draw_rank <= quota").join(plans, "target_id").select("plan_id", "target_id", "id", "draw_rank")

    def plan_sizes(self, sample: DataFrame | None = None) -> DataFrame:
        """(plan_id, n_drawn, n_ids): rows and different ids that sample() draws for each plan."""
        return (sample or self.sample()).groupBy("plan_id").agg(F.count("*").alias("n_drawn"), F.countDistinct("id").alias("n_ids"))

    def unmet(self) -> DataFrame:
        """(target_id): targets that the rows cannot meet, found by drawing.

        The sample is drawn and each target's rows in it are counted. Those of fewer rows than needed are checked exactly:
        a target is unmet if even all rows that match it are too few, whichever target they are drawn for.
        """
        drawn = self.sample().groupBy("target_id").agg(F.count("*").alias("n"))
        checked = self.report().join(drawn, "target_id", "left").filter(F.coalesce("n", F.lit(0)) < F.col("needed"))
        return checked.filter("short > 0").select("target_id")


def _mask(seed: int, plan: int) -> int:
    """The bits that a plan flips in the hashes of ids: none for the first, a fixed mix of seed and number for the others."""
    x = (plan * 0x9E3779B97F4A7C15 ^ (seed * 0xBF58476D1CE4E5B9 if plan else 0)) & (2**64 - 1)
    return x - 2**64 if x >= 2**63 else x
