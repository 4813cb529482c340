"""Problem 3: splits that keep the records of a schema together, however its name is written."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.unionfind import components
from pairloom.runtime import col, materialize

#: The registry is reference data read by the driver; more entries are refused.
MAX_ENTRIES = 5_000
#: Groups of one size that a hash bin holds, about.
BIN_ROWS = 50_000

SPLITTERS = re.compile(r"[,/&+;|\[\](){}\"'`<>\\:.]+|\s+(?:and|und|et|y|or|plus|with)\s+", re.I)
DDL = re.compile(r"\bcreate\s+(?:or\s+replace\s+)?(?:temp(?:orary)?\s+)?table\s+(?:if\s+not\s+exists\s+)?([^\s(,;]+)", re.I)
COLUMN = re.compile(r"(?:^|[(,\n])\s*[\"`\[]?(\w+)[\"`\]]?\s+(?:integer|int|bigint|text|varchar|char|decimal|numeric|date|datetime|timestamp|real|double|float|boolean|json)\b", re.I)


def squeeze(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum())


def deletes(word: str, depth: int) -> set[str]:
    out = {word}
    for k in range(1, depth + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in combinations(range(len(word)), k)}
    return out


def distance(a: str, b: str, most: int = 2) -> int:
    """Edit distance with swaps of neighbours, or most + 1 if it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return min(last[-1], most + 1)


class Resolver:
    """Finds the registry entries that a text names: by name, alias, tables of its DDL, a name with up to two typing errors, or an alias with one in its letters."""

    def __init__(self, registry: list[tuple[str, list[str], list[str]]]):
        self.exact: dict[str, str] = {}
        self.tables: dict[str, str] = {}
        self.names: dict[str, str] = {}
        self.aliases: dict[str, str] = {}
        for name, aliases, tables in registry:
            self.names[squeeze(name)] = name
            for a in (name, *(aliases or [])):
                if squeeze(a):
                    self.exact[squeeze(a)] = name
            self.aliases |= {squeeze(a): name for a in aliases or [] if squeeze(a)}
            for t in tables or []:
                self.tables[squeeze(t)] = name
        self.near: dict[str, set[str]] = {}
        self.near_aliases: dict[str, set[str]] = {}
        self.near_tables: dict[str, set[str]] = {}
        for index, words, most in ((self.near, self.names, 2), (self.near_aliases, self.aliases, 1), (self.near_tables, self.tables, 2)):
            for key in words:
                for d in deletes(key, most):
                    index.setdefault(d, set()).add(key)
        self.longest = max((len(k) for words in (self.names, self.aliases, self.tables) for k in words), default=0)
        self.cache: dict[str, tuple[str, ...]] = {}

    def misspelt(self, key: str, index: dict[str, set[str]], words: dict[str, str]) -> str | None:
        most = 2 if len(key) >= 8 else 1 if len(key) >= 5 else 0
        if not most or len(key) > self.longest + most:  # no entry is within reach of a longer text
            return None
        found = {c for d in deletes(key, most) for c in index.get(d, ())}
        ranked = sorted((distance(key, c, most), c) for c in found)
        ranked = [r for r in ranked if r[0] <= most]
        if not ranked or len(ranked) > 1 and ranked[0][0] == ranked[1][0] and words[ranked[0][1]] != words[ranked[1][1]]:
            return None
        return words[ranked[0][1]]

    def misspelt_alias(self, key: str) -> str | None:
        """The only entry with an alias one edit away; the digits, which tell aliases apart, must agree."""
        if not 5 <= len(key) <= self.longest + 1:
            return None
        digits = re.sub(r"\D", "", key)
        found = {c for d in deletes(key, 1) for c in self.near_aliases.get(d, ())}
        hits = {self.aliases[c] for c in found if re.sub(r"\D", "", c) == digits and distance(key, c, 1) == 1}
        return hits.pop() if len(hits) == 1 else None

    def one(self, part: str) -> str | None:
        key = re.sub(r"(?:sql|ddl|json|ya?ml)$", "", squeeze(part)) if "." in part else squeeze(part)
        return self.exact.get(key) or self.misspelt(key, self.near, self.names) or self.misspelt_alias(key)

    def resolve(self, text: str | None) -> tuple[str, ...]:
        if not text or text.isspace():
            return ()
        got = self.cache.get(text)
        if got is None:
            if len(self.cache) > 50_000:
                self.cache.clear()
            got = self.cache[text] = tuple(sorted(self.named(text)))
        return got

    def named(self, text: str) -> set[str]:
        found: set[str] = set()
        tables = DDL.findall(text)
        if tables:
            for t in tables:
                key = squeeze(re.split(r"[.]", t)[-1])
                hit = self.tables.get(key) or self.misspelt(key, self.near_tables, self.tables)
                if hit:
                    found.add(hit)
            return found
        if whole := self.exact.get(squeeze(text)):
            return {whole}
        for part in SPLITTERS.split(text):
            if not part or not squeeze(part):
                continue
            if hit := self.one(part):
                found.add(hit)
                continue
            pieces = part.split()
            if len(pieces) > 1:  # names side by side, of one or two words each
                at = 0
                while at < len(pieces):
                    two = self.one("".join(pieces[at : at + 2])) if at + 1 < len(pieces) else None
                    hit = self.one(pieces[at]) or two
                    if hit:
                        found.add(hit)
                    at += 2 if two and not self.one(pieces[at]) else 1
        return found


_resolvers: dict[int, Resolver] = {}


def resolver_of(entries: list) -> Resolver:
    """The resolver of a registry, made once in each worker."""
    key = hash(repr(entries))
    if key not in _resolvers:
        _resolvers.clear()
        _resolvers[key] = Resolver(entries)
    return _resolvers[key]


def read_registry(registry: DataFrame) -> list[tuple[str, list[str], list[str]]]:
    rows = registry.select("schema_name", "aliases", "table_names").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} registry entries")
    return [(r[0], r[1], r[2]) for r in rows if r[0]]


def mentions(records: DataFrame, registry: DataFrame) -> DataFrame:
    """records (rec_kind, rec_id, name) with entries, the array of the registry entries that name means; empty for none."""
    entries = registry.sparkSession.sparkContext.broadcast(read_registry(registry))  # at most MAX_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resolver = resolver_of(entries.value)
        for batch in batches:
            found = [list(resolver.resolve(t)) for t in batch.column("name").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rec_kind"), batch.column("rec_id"), pa.array(found, pa.list_(pa.string()))], names=["rec_kind", "rec_id", "entries"])

    return records.select("rec_kind", "rec_id", "name").mapInArrow(run, "rec_kind string, rec_id bigint, entries array<string>")


class RelatedGroups:
    def __init__(self, records: DataFrame, registry: DataFrame):
        """records (rec_kind, rec_id, name): names are resolved row by row, entries named by one row are united.

        Null, blank and unknown names belong to no group; their rows are groups of their own in split().
        """
        self.named = materialize(mentions(records, registry), "mentions")
        pairs = self.named.filter(F.size("entries") > 1).select(F.explode(F.slice("entries", 2, 1 << 30)).alias("v"), F.col("entries")[0].alias("u"))
        self.roots = materialize(components(pairs.distinct()), "roots")

    def grouped(self) -> DataFrame:
        """(rec_kind, rec_id, group_id) of each row that names an entry: the group's alphabetically first entry."""
        rows = self.named.filter(F.size("entries") > 0).select("rec_kind", "rec_id", F.col("entries")[0].alias("node"))
        return rows.join(self.roots, "node", "left").select("rec_kind", "rec_id", F.coalesce("root", "node").alias("group_id"))

    def split(self, ratios: dict[str, float]) -> DataFrame:
        """(rec_kind, rec_id, group_id, split) of every row; rows of no group have a null group_id and are placed alone."""
        node = self.named.select("rec_kind", "rec_id", F.try_element_at("entries", F.lit(1)).alias("node"))
        rows = node.join(self.roots, "node", "left").select("rec_kind", "rec_id", F.coalesce("root", "node").alias("group_id"))
        key = F.coalesce(F.col("group_id"), F.concat_ws("\x01", F.lit("row"), "rec_kind", F.col("rec_id").cast("string")))
        keyed = materialize(rows.withColumn("key", key), "keyed")
        placed = assign_groups(keyed.groupBy("key").agg(F.count("*").alias("n")), ratios)
        return keyed.join(placed, "key").select("rec_kind", "rec_id", "group_id", "split")


def fill(count: int, size: int, lacks: dict[str, float]) -> dict[str, int]:
    """How many of `count` groups of one size go to each split if each goes to the split that then lacks most.

    The greedy choice takes the largest values of lack - j * size over all splits and j = 0, 1, ...; their number above a
    level is known in closed form, so the level is found by bisection and the few values at it are taken one by one.
    """
    if not count:
        return dict.fromkeys(lacks, 0)
    above = lambda level: {s: max(0, math.ceil((lack - level) / size)) for s, lack in lacks.items()}
    low, high = min(lacks.values()) - count * size - size, max(lacks.values())
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if sum(above(middle).values()) > count:
            low = middle
        else:
            high = middle
    got = above(high)
    while (left := count - sum(got.values())) > 0:
        for s in sorted(lacks, key=lambda s: (got[s] * size - lacks[s], s))[:left]:
            got[s] += 1
            break
    return got


def greedy(sizes: list[tuple[int, int]], targets: dict[str, float]) -> dict[int, dict[str, int]]:
    """For each size, how many of its groups go to each split: largest first, each to the split furthest below its target.

    sizes (n, count): the number of groups of n rows. Groups of one size can stand for each other, so the counts are all
    that the greedy assignment decides.
    """
    lacks = dict(targets)
    out = {}
    for n, count in sorted(sizes, reverse=True):
        out[n] = fill(count, n, lacks)
        for s, k in out[n].items():
            lacks[s] -= k * n
    return out


def assign_groups(groups: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """(key, split) for groups (key, n): greedy largest-first, each group whole, to the split furthest below its target.

    The driver holds how many groups there are of each size, and nothing of a single group: R rows have at most
    sqrt(2 R) different sizes. It decides how many groups of each size go where. Within a size the groups are ranked in
    the order of a hash (over bins, then within a bin, so that no task ranks all groups of one row), and consecutive
    ranks go to the splits by these numbers.
    """
    if not ratios or sum(ratios.values()) <= 0 or min(ratios.values()) < 0:
        raise ValueError("ratios must be positive")
    groups = materialize(groups, "groups")
    spark = groups.sparkSession
    sizes = [(r["n"], r["k"]) for r in groups.groupBy("n").agg(F.count("*").alias("k")).collect()]
    total = sum(n * k for n, k in sizes)
    scale = sum(ratios.values())
    plan = greedy(sizes, {s: total * r / scale for s, r in ratios.items()})
    names = list(ratios)
    uptos = [(n, [sum(counts[s] for s in names[: k + 1]) for k in range(len(names))]) for n, counts in plan.items()]
    bounds = spark.createDataFrame(uptos, "n bigint, upto array<bigint>")
    bins = max(1, sum(k for _, k in sizes) // BIN_ROWS)
    placed = groups.withColumn("h", F.xxhash64("key")).withColumn("bin", F.pmod("h", F.lit(bins)))
    before = Window.partitionBy("n").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = placed.groupBy("n", "bin").agg(F.count("*").alias("held")).withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0))).join(bounds, "n")
    inside = Window.partitionBy("n", "bin").orderBy("h", "key")
    ranked = placed.join(per_bin.select("n", "bin", "offset", "upto"), ["n", "bin"]).withColumn("rank", F.col("offset") + F.row_number().over(inside))
    nth = F.size(F.filter("upto", lambda u: u < F.col("rank"))) + 1
    return ranked.select("key", F.element_at(F.array(*[F.lit(s) for s in names]), nth).alias("split"))


def split_checks(split: DataFrame, ratios: dict[str, float], within: float = 0.01) -> DataFrame:
    """One row: rows placed, groups that lie in more than one split, and splits whose share of the rows is further than
    `within` from its ratio."""
    torn = split.filter("group_id is not null").groupBy("group_id").agg(F.countDistinct("split").alias("k")).agg(F.count_if(F.col("k") > 1).alias("n_torn"))
    scale = sum(ratios.values())
    wanted = split.sparkSession.createDataFrame([(s, r / scale) for s, r in ratios.items()], "split string, ratio double")
    sizes = wanted.join(split.groupBy("split").agg(F.count("*").alias("n")), "split", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    gaps = sizes.withColumn("n_rows", F.sum("n").over(Window.partitionBy(F.lit(0))))  # a row for each split
    far = F.abs(F.col("n") - F.col("ratio") * F.col("n_rows")) > F.lit(within) * F.col("n_rows")
    return gaps.agg(F.max("n_rows").alias("n_rows"), torn.scalar().alias("n_torn"), F.count_if(far).alias("n_far"))


def schema_records(seeds: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows of both tables as (rec_kind, rec_id, name); rows with a null id are left out, for nothing could refer to them."""
    a = seeds.select(F.lit("seed").alias("rec_kind"), col("seed_id").alias("rec_id"), col("schema").cast("string").alias("name"))
    b = jobs.select(F.lit("job").alias("rec_kind"), col("job_id").alias("rec_id"), col("schema").cast("string").alias("name"))
    return a.unionByName(b).filter("rec_id is not null")
