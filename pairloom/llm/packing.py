"""Problem 8: filling containers of fixed capacity with items, source by source in target proportions."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm import tokenizer as tok
from pairloom.llm.encode import encoder
from pairloom.runtime import col, materialize

#: Tokens of a window: what is packed together in one task.
WINDOW_TOKENS = 1_000_000
#: Rows of a hash bin of a source's queue, about; a bin is the unit in which the running totals are computed.
BIN_ROWS = 50_000
#: Cells of the axis on which the stretches between dry queues are looked up.
CELLS = 1024


@dataclass(frozen=True)
class Spec:
    spec_id: int
    capacity: int


def sizes(df: DataFrame, id_col: str, text_col: str, source_col: str, name: str, folder: str = tok.TOKENIZER_DIR) -> DataFrame:
    """(id, source, n_tokens) of each row that has tokens; a null source is a queue of its own."""
    base = df.select(col(id_col).alias("id"), F.coalesce(col(source_col).cast("string"), F.lit("\x00")).alias("source"), col(text_col).cast("string").alias("n_tokens"))
    kind = base.schema["id"].dataType.simpleString()
    counted = base.mapInArrow(encoder("n_tokens", name, folder, sizes_only=True), f"id {kind}, source string, n_tokens bigint")
    return materialize(counted.filter("n_tokens > 0"), "sizes")


def _shares(queues: DataFrame, targets: DataFrame | None) -> DataFrame:
    """queues (source, source_tokens, all_tokens) with each queue's share of a window while all are served; shares sum to 1.

    A queue without a target, or whose target is null, NaN, infinite or not positive, keeps the share that it has of all
    tokens. The targeted queues have the rest, in the proportions of their targets, whatever these sum to.
    """
    natural = F.col("source_tokens") / F.col("all_tokens")
    if targets is None:
        return queues.withColumn("share", natural).withColumn("targeted", F.lit(False))
    given = targets.select(F.coalesce(F.col("source").cast("string"), F.lit("\x00")).alias("source"), F.col("share").cast("double").alias("t"))
    given = given.filter("t > 0 and not isnan(t) and t < double('infinity')").groupBy("source").agg(F.sum("t").alias("t"))
    joined = queues.join(given, "source", "left")
    sums = joined.agg(F.sum(F.when(F.col("t").isNull(), natural)).alias("free"), F.sum("t").alias("whole"))
    free, whole = F.coalesce(sums.select("free").scalar(), F.lit(0.0)), sums.select("whole").scalar()
    return joined.select("source", "source_tokens", "all_tokens", F.coalesce(F.col("t") / whole * (1 - free), natural).alias("share"), F.col("t").isNotNull().alias("targeted"))


def _stretches(shares: DataFrame) -> DataFrame:
    """(cell, low, high, base, slope): from virtual time low to high, base + slope * time tokens are served by all queues.

    A queue of T tokens and share p is dry at virtual time T / p. Untargeted queues all fall dry at the same time, so
    there are at most as many stretches as targets, and one more.
    """
    dry = F.when(F.col("targeted"), F.col("source_tokens") / F.col("share")).otherwise(F.col("all_tokens").cast("double"))
    ends = shares.groupBy(dry.alias("high")).agg(F.sum("source_tokens").alias("t"), F.sum("share").alias("p"))
    before = Window.partitionBy(F.lit(0)).orderBy("high").rowsBetween(Window.unboundedPreceding, -1)  # a row for each target
    later = Window.partitionBy(F.lit(0)).orderBy("high").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0.0)
    made = ends.select(
        "high", F.coalesce(F.lag("high").over(Window.partitionBy(F.lit(0)).orderBy("high")), zero).alias("low"), F.coalesce(F.sum("t").over(before), zero).alias("base"),
        F.sum("p").over(later).alias("slope"), F.max("high").over(Window.partitionBy(F.lit(0))).alias("last"),
    )
    cell = lambda c: F.least(F.lit(CELLS - 1), F.floor(F.col(c) / F.col("last") * CELLS)).cast("int")
    return made.select(F.explode(F.sequence(cell("low"), cell("high"))).alias("cell"), "low", "high", "base", "slope", "last")


def schedule(items: DataFrame, window_tokens: int = WINDOW_TOKENS, targets: DataFrame | None = None) -> DataFrame:
    """items (id, source, n_tokens) with the window in which each is packed; every item has one window.

    Deficit round-robin in closed form. In every round a source's queue gets its quantum, its share of the tokens given
    out; an item is taken in the first round in which the credit given so far covers all tokens up to its end, and what is
    left over is carried on. The credit after v rounds is v quanta, so an item whose tokens end at E in a queue of share p
    is due at virtual time v = E / p, wherever it is computed: deficits carry across windows and partitions without a
    pass from one to the next. When a queue falls dry, its share of the later windows goes to the queues that are left, by
    their shares: the tokens served until v are S(v), the sum of min(T, p v) over the queues, and the item's window is
    S(v) / (tokens of a window). So all windows hold about as many tokens, and none is left out when a queue is dry.

    targets (source, share): the proportions, of any sum; without it those of the items themselves, which uses every item
    evenly. A source without a target, or with one that is null, NaN or not positive, keeps its own share of all tokens.
    Untargeted queues start at a phase of their own, so that sources of a single item don't all fall due at once.
    The running totals are computed over hash bins of a queue, then within a bin: no task holds a whole source. A null
    source is a queue of its own. An empty table gives no rows.
    """
    items = items.withColumn("source", F.coalesce("source", F.lit("\x00")))
    totals = items.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t"), F.count("*").alias("n")).head()
    n_windows, bins = max(1, -(-totals["t"] // window_tokens)), max(64, totals["n"] // BIN_ROWS)
    placed = items.withColumn("h", F.xxhash64("id")).withColumn("bin", F.pmod("h", F.lit(bins)))
    per_bin = materialize(placed.groupBy("source", "bin").agg(F.sum("n_tokens").alias("bin_tokens")), "bins")
    queues = per_bin.groupBy("source").agg(F.sum("bin_tokens").alias("source_tokens")).withColumn("all_tokens", F.lit(totals["t"]))
    shares = materialize(_shares(queues, targets), "shares")
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.withColumn("offset", F.coalesce(F.sum("bin_tokens").over(before), F.lit(0))).join(shares, "source")
    inside = Window.partitionBy("source", "bin").orderBy("h", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queue = placed.join(per_bin, ["source", "bin"]).withColumn("end", F.col("offset") + F.sum("n_tokens").over(inside))
    phase = F.pmod(F.xxhash64("source", F.lit("phase")), F.lit(1_000_003)) / 1_000_003.0
    turned = F.pmod(F.col("end") + phase * F.col("source_tokens"), F.col("source_tokens"))
    due = F.when(F.col("targeted"), (F.col("end") - 1) / F.col("share")).otherwise(turned / F.col("source_tokens") * F.col("all_tokens"))
    timed = queue.select("id", "source", "n_tokens", due.alias("due"))
    if targets is None:
        served = timed.withColumn("served", F.col("due"))
    else:
        steps = materialize(_stretches(shares), "stretches")
        last = steps.agg(F.max("last")).scalar()
        cell = F.least(F.lit(CELLS - 1), F.floor(F.col("due") / last * CELLS)).cast("int")
        inner = (F.col("low") <= F.col("due")) & ((F.col("due") < F.col("high")) | (F.col("high") == F.col("last")))
        served = timed.withColumn("cell", cell).join(steps, "cell").filter(inner).withColumn("served", F.col("base") + F.col("slope") * F.col("due"))
    at = F.least(F.lit(n_windows - 1), F.floor(F.col("served") * F.lit(n_windows / max(1, totals["t"])))).cast("bigint")
    return served.select("id", "source", "n_tokens", at.alias("window"))


def best_fit(lengths: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """(container, item, length) for items (item, length <= capacity): longest first, each into the fullest container that holds it."""
    by_free: dict[int, list[int]] = {}
    open_mask = 0
    out, made = [], 0
    for item, length in sorted(lengths, key=lambda x: (-x[1], x[0])):
        fit = open_mask >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            box = by_free[free].pop()
            if not by_free[free]:
                open_mask &= ~(1 << free)
        else:
            free, box, made = capacity, made, made + 1
        out.append((box, item, length))
        if rest := free - length:
            by_free.setdefault(rest, []).append(box)
            open_mask |= 1 << rest
    return out


def _packer(specs: list[Spec]):
    def run(items: pa.Table) -> pa.Table:
        window = items.column("window")[0].as_py()
        pairs = sorted(zip(items.column("n_tokens").to_pylist(), map(str, items.column("id").to_pylist()), range(len(items))))
        ids = items.column("id").take(pa.array([k for _, _, k in pairs]))
        counts = [n for n, _, _ in pairs]
        out: list[list[int]] = [[] for _ in range(6)]  # spec, slot, item, piece, start, length

        def place(*row: int) -> None:
            for column, value in zip(out, row):
                column.append(value)

        for spec in specs:
            full = [(k, p) for k, n in enumerate(counts) for p in range(n // spec.capacity)]
            rest = [(k, n % spec.capacity) for k, n in enumerate(counts) if n % spec.capacity]
            for box, (k, p) in enumerate(full):
                place(spec.spec_id, box, k, p, p * spec.capacity, spec.capacity)
            for box, k, length in best_fit(rest, spec.capacity):
                p = counts[k] // spec.capacity
                place(spec.spec_id, len(full) + box, k, p, p * spec.capacity, length)
        spec_id, slot, item, piece, start, length = (pa.array(c, pa.int64()) for c in out)
        windows = pa.array([window] * len(item), pa.int64())
        return pa.table({"spec_id": spec_id, "window": windows, "slot": slot, "id": ids.take(item), "piece": piece, "start": start, "length": length})

    return run


def pack(items: DataFrame, specs: list[Spec], window_tokens: int = WINDOW_TOKENS, targets: DataFrame | None = None) -> DataFrame:
    """(spec_id, window, slot, id, piece, start, length): what each container (spec_id, window, slot) holds.

    Items (id, source, n_tokens > 0) go to windows by schedule(); a window's items are packed by best fit, longest first.
    An item beyond the capacity is cut into full pieces and a rest; no other item is cut. Every token has one place.
    Repeated rows and rows with a null id are items of their own; an empty table gives no containers. A window holds about window_tokens, at most
    one item more for each source, so a task's memory doesn't grow with the table.
    """
    if not specs or any(s.capacity < 1 for s in specs):
        raise ValueError("capacities must be 1 or more")
    kind = items.schema["id"].dataType.simpleString()
    planned = materialize(schedule(items, window_tokens, targets).select("id", "n_tokens", "window"), "planned")
    n_windows = (planned.agg(F.max("window")).head()[0] or 0) + 1
    tasks = min(n_windows, max(2 * items.sparkSession.sparkContext.defaultParallelism, n_windows // 256))
    return planned.repartition(tasks, "window").groupBy("window").applyInArrow(
        _packer(specs), f"spec_id bigint, window bigint, slot bigint, id {kind}, piece bigint, start bigint, length bigint"
    )


def checks(items: DataFrame, packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: items placed, tokens that have no place or several, containers filled beyond the capacity, and items cut
    although they fit; the last three are 0 whatever the data."""
    wanted = items.agg(F.sum("n_tokens")).scalar()
    pieces = packed.join(specs.select("spec_id", "capacity"), "spec_id")
    boxes = pieces.groupBy("spec_id", "capacity", "window", "slot").agg(F.sum("length").alias("filled"))
    full = boxes.groupBy("spec_id").agg(F.count_if(F.col("filled") > F.col("capacity")).alias("n_overfull"))
    owned = pieces.groupBy("spec_id", "capacity", "id").agg(F.sum("length").alias("n"), F.count("*").alias("k"))
    cut = owned.groupBy("spec_id").agg(F.count("*").alias("n_items"), (F.coalesce(wanted, F.lit(0)) - F.sum("n")).alias("n_tokens_lost"), F.count_if((F.col("k") > 1) & (F.col("n") <= F.col("capacity"))).alias("n_cut"))
    return cut.join(full, "spec_id").select("spec_id", "n_items", "n_tokens_lost", "n_overfull", "n_cut")


def mixture(planned: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, n_items, n_tokens, first_share, target): what schedule() placed of each source, and the source's share of
    the tokens of the first window beside its target's share of all targets."""
    per = planned.groupBy("source").agg(F.count("*").alias("n_items"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.when(F.col("window") == 0, F.col("n_tokens"))).alias("early"))
    early = per.agg(F.sum("early")).scalar()
    whole = targets.agg(F.sum("share")).scalar()
    named = targets.select(F.coalesce("source", F.lit("\x00")).alias("source"), (F.col("share") / whole).alias("target"))
    return per.join(named, "source", "left").select("source", "n_items", "n_tokens", F.round(F.coalesce("early", F.lit(0)) / early, 4).alias("first_share"), F.round("target", 4).alias("target"))


def report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: containers, tokens placed and the share of the capacity that stays unused."""
    boxes = packed.groupBy("spec_id", "window", "slot").agg(F.sum("length").alias("filled"), F.count("*").alias("pieces"))
    total = boxes.groupBy("spec_id").agg(F.count("*").alias("n_containers"), F.sum("filled").alias("n_tokens"), F.sum("pieces").alias("n_pieces"), F.max("filled").alias("fullest"))
    return total.join(specs.select("spec_id", "capacity"), "spec_id").withColumn("unused_share", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6))
