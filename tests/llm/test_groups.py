import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.llm import proportions, related

TARGETS = "target_id bigint, plan_id bigint, difficulty string, category string, target_share double, min_rows bigint, sample_fraction double"
ROWS = "example_id bigint, difficulty string, category string"


def sampled(spark, rows, targets):
    return proportions.ProportionalSample(spark.createDataFrame(rows, ROWS), spark.createDataFrame(targets, TARGETS), "example_id")


def test_sample_meets_reachable_targets_and_passes_the_rest_on(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["easy", "Easy ", "EASY", "hard"]), rng.choice(["select", "window function", "Window-Function", "window_function"])) for i in range(2000)]
    rows += [(5000 + i, "hard", "cte") for i in range(3)]
    targets = [(1, 1, "easy", "select", 0.3, 1, 0.2), (2, 1, "hard", "select", 0.2, 1, 0.2), (3, 1, None, "window_function", 0.4, 1, 0.2), (4, 1, "hard", "CTE", 0.1, 20, 0.2)]
    s = sampled(spark, rows, targets)
    report = {r.target_id: r for r in s.report().collect()}
    size = math.floor(0.2 * len(rows))
    assert report[4].short == 40 - 3 and report[4].drawn == 3 and report[4].needed == 40
    assert sum(r.drawn for r in report.values()) == size
    assert [r.target_id for r in s.unmet().collect()] == [4]
    drawn = s.sample().collect()
    assert len(drawn) == size and len({r.id for r in drawn}) == size
    assert Counter(r.target_id for r in drawn) == {k: r.drawn for k, r in report.items()}
    for t in report:
        ranks = sorted(r.draw_rank for r in drawn if r.target_id == t)
        assert ranks == list(range(1, len(ranks) + 1))
    again = sampled(spark, rows[::-1], targets).sample().collect()
    assert {(r.target_id, r.id, r.draw_rank) for r in again} == {(r.target_id, r.id, r.draw_rank) for r in drawn}


def test_siblings_come_before_cousins():
    T = proportions.Target
    cells = [T(1, 1, "easy", "a", 0.25, 0, 1.0, available=2), T(2, 1, "hard", "a", 0.25, 0, 1.0, available=90), T(3, 1, "easy", "b", 0.5, 0, 1.0, available=90)]
    proportions.allocate(cells, 40)
    assert [c.taken for c in cells] == [2, 18, 20]
    cells = [T(1, 1, "easy", "a", 0.25, 0, 1.0, available=2), T(2, 1, "hard", "a", 0.25, 0, 1.0, available=12), T(3, 1, "easy", "b", 0.5, 0, 1.0, available=90)]
    proportions.allocate(cells, 40)
    assert [c.taken for c in cells] == [2, 12, 26]


def test_minimums_are_kept_and_paid_by_the_largest():
    T = proportions.Target
    cells = [T(1, 1, "x", "a", 0.98, 0, 1.0, available=500), T(2, 1, "x", "b", 0.02, 10, 1.0, available=50)]
    proportions.allocate(cells, 100)
    assert [c.taken for c in cells] == [90, 10]


def test_sampling_edges(spark):
    targets = [(1, 1, None, None, 1.0, 2, 0.5)]
    assert sampled(spark, [], targets).sample().collect() == []
    assert [r.target_id for r in sampled(spark, [], targets).unmet().collect()] == [1]
    got = sampled(spark, [(1, None, None), (None, "a", "b"), (2, "c", None), (3, "c", None)], targets).sample().collect()
    assert len(got) == 2 and None not in {r.id for r in got}
    assert sampled(spark, [(1, "a", "b")], []).report().collect() == []


REGISTRY = [("harbour_stock", ["db_harb01", "har-sto-7"], ["harbour_bins", "harbour_pallets"]), ("clinic_visits", ["db_clin02"], ["clinic_tours"]), ("mill_billing", [], ["mill_ledgers"]), ("kiln_upkeep", None, None)]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("harbour_stock", ["harbour_stock"]), (" Harbour Stock\n", ["harbour_stock"]), ("HARBOUR-STOCK", ["harbour_stock"]), ("HarbourStock", ["harbour_stock"]), ("harbourstock", ["harbour_stock"]), ('"harbour_stock"', ["harbour_stock"]),
        ("public.harbour_stock", ["harbour_stock"]), ("schemas/harbour_stock.sql", ["harbour_stock"]), ("HAR-STO-7", ["harbour_stock"]), ("db_harb01", ["harbour_stock"]), ("habrour_stock", ["harbour_stock"]), ("harbur_stok", ["harbour_stock"]),
        ("harbour_stock/clinic_visits", ["clinic_visits", "harbour_stock"]), ("harbour_stock and mill_billing", ["harbour_stock", "mill_billing"]), ('["clinic_visits", "mill_billing"]', ["clinic_visits", "mill_billing"]),
        ("harbour_stock & clinicvisits", ["clinic_visits", "harbour_stock"]), ("CREATE TABLE harbour_bins (id INTEGER);\ncreate table if not exists \"clinic_tours\" (id int)", ["clinic_visits", "harbour_stock"]),
        ("-- x\ncreate table public.mill_ledgers (", ["mill_billing"]), ("n/a", []), ("none", []), ("-", []), ("", []), (None, []), ("unknown", []), ("something else entirely", []),
    ],
)
def test_names_are_resolved(text, names):
    assert list(related.Resolver(REGISTRY).resolve(text)) == names


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("db_hrab01", ["harbour_stock"]), ("DB-HARV01", ["harbour_stock"]), ("db_har01", ["harbour_stock"]), ("har-stoo-7", ["harbour_stock"]), ("db_clim02 and mill_billing", ["clinic_visits", "mill_billing"]),
        ("db_harb02", []), ("db_harb11", []), ("db_harb0", []), ("har-sto-8", []), ("db_hxyb01", []), ("db_harq01", ["harbour_stock"]),
    ],
)
def test_misspelt_aliases_are_resolved_by_their_letters(text, names):
    assert list(related.Resolver(REGISTRY).resolve(text)) == names
    twins = [("a_one", ["db_harb01"], []), ("b_two", ["db_hark01"], [])]
    assert related.Resolver(twins).resolve("db_harq01") == () and related.Resolver(twins).resolve("db_hark01") == ("b_two",)


def groups(spark, rows):
    registry = spark.createDataFrame(REGISTRY, "schema_name string, aliases array<string>, table_names array<string>")
    return related.RelatedGroups(spark.createDataFrame(rows, "rec_kind string, rec_id bigint, name string"), registry)


def test_chains_unite_groups_over_both_tables(spark):
    rows = [("seed", 1, "harbour_stock"), ("job", 1, "mill_billing, harbour stock"), ("seed", 2, "MILL_BILLING/clinic_visits"), ("seed", 3, "kiln_upkeep"), ("seed", 4, "n/a"), ("job", 5, None)]
    g = groups(spark, rows)
    assert sorted(tuple(r) for r in g.grouped().collect()) == [("job", 1, "clinic_visits"), ("seed", 1, "clinic_visits"), ("seed", 2, "clinic_visits"), ("seed", 3, "kiln_upkeep")]
    split = g.split({"train": 0.8, "test": 0.2}).collect()
    assert len(split) == 6 and len({r.split for r in split if r.group_id == "clinic_visits"}) == 1
    assert groups(spark, []).grouped().collect() == [] and groups(spark, []).split({"a": 1.0}).collect() == []


def test_repeated_rows_stay_rows(spark):
    g = groups(spark, [("seed", 1, "kiln_upkeep")] * 3 + [("seed", 2, None)] * 2)
    assert g.split({"train": 0.5, "test": 0.5}).count() == 5


def test_splits_are_near_their_ratios(spark):
    rng = random.Random(3)
    sizes = [3000] + [rng.randint(1, 60) for _ in range(300)] + [1] * 2000
    df = spark.createDataFrame([(f"g{i}", n) for i, n in enumerate(sizes)], "key string, n bigint")
    out = related.assign_groups(df, {"train": 0.8, "validation": 0.1, "test": 0.1}).join(df, "key").groupBy("split").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    total = sum(sizes)
    assert sum(r.k for r in out) == len(sizes)
    for r in out:
        assert abs(r.n / total - {"train": 0.8}.get(r.split, 0.1)) < 0.01
    with pytest.raises(ValueError):
        related.assign_groups(df, {})


def one_by_one(sizes, targets):
    """The greedy assignment, group by group: rows of each split."""
    filled = dict.fromkeys(targets, 0)
    for n in sorted(sizes, reverse=True):
        filled[max(targets, key=lambda s: (targets[s] - filled[s], s))] += n
    return filled


def test_greedy_counts_equal_a_group_by_group_assignment():
    rng = random.Random(11)
    for _ in range(200):
        sizes = [rng.choice([1, 1, 1, 2, 3, 5, 40, 300]) for _ in range(rng.randint(1, 400))]
        total = sum(sizes)
        targets = {"train": 0.8 * total, "validation": 0.1 * total, "test": 0.1 * total}
        plan = related.greedy(list(Counter(sizes).items()), targets)
        assert all(sum(c.values()) == Counter(sizes)[n] for n, c in plan.items())
        got = sorted(sum(n * c[s] for n, c in plan.items()) - targets[s] for s in targets)
        want = sorted(v - targets[s] for s, v in one_by_one(sizes, targets).items())
        assert got == pytest.approx(want, abs=1e-6)
    assert related.fill(0, 3, {"a": 1.0}) == {"a": 0} and related.fill(10**9, 1, {"a": 8e8, "b": 2e8}) == {"a": 8 * 10**8, "b": 2 * 10**8}


def test_long_names_are_resolved():
    name = "warehouse_of_all_northern_harbours_and_their_inland_branches_since_the_reform_of_the_customs_service"
    r = related.Resolver([(name, [], [])])
    assert len(related.squeeze(name)) > 64
    assert r.resolve(name.upper()) == r.resolve(name.replace("northern", "norhtern")) == (name,) and r.resolve("x" * 5000) == ()


def test_split_checks(spark):
    rows = [("seed", i, None, "train" if i % 10 < 8 else "validation" if i % 10 == 8 else "test") for i in range(100)] + [("job", 1, "g", "train"), ("job", 2, "g", "test")]
    df = spark.createDataFrame(rows, "rec_kind string, rec_id bigint, group_id string, split string")
    ratios = {"train": 0.8, "validation": 0.1, "test": 0.1}
    assert related.split_checks(df, ratios).collect() == [(102, 1, 0)]
    assert related.split_checks(df.limit(0), ratios).collect() == [(0, 0, 0)]


def test_minimums_are_paid_by_all_in_proportion():
    T = proportions.Target
    cells = [T(k, 1, "x", f"c{k}", share, low, 1.0, available=10_000) for k, (share, low) in enumerate([(0.30, 0), (0.28, 0), (0.22, 0), (0.18, 0), (0.02, 200)])]
    proportions.allocate(cells, 1000)
    assert [c.taken for c in cells] == [245, 228, 180, 147, 200]
    over = [T(1, 1, "x", "a", 0.5, 80, 1.0, available=500), T(2, 1, "x", "b", 0.5, 70, 1.0, available=500)]
    assert [c.taken for c in proportions.allocate(over, 100)] == [80, 70]


def test_overlapping_targets_and_mixed_fractions(spark):
    rows = [(i, "easy" if i % 4 else "hard", "join") for i in range(400)] + [(1, "easy", "join")] * 3
    targets = [(1, 1, "easy", "join", 0.2, 0, 0.5), (2, 1, None, "join", 0.8, 0, 0.5), (3, 1, "hard", None, 0.5, 0, 0.1), (4, 2, "hard", "cte", 1.0, 1, 0.0)]
    s = sampled(spark, rows, targets)
    report = {r.target_id: r for r in s.report().collect()}
    assert (report[1].matching, report[2].matching, report[3].matching, report[4].short) == (303, 403, 100, 1)
    assert report[1].sample_size == 201 and report[3].sample_size == 40
    drawn = s.sample()
    assert Counter(r.target_id for r in drawn.collect()) == {k: r.drawn for k, r in report.items() if r.drawn}
    assert [r.target_id for r in s.unmet().collect()] == [4]
    assert {r.plan_id: r.n_drawn for r in s.plan_sizes().collect()} == {1: report[1].drawn + report[2].drawn + report[3].drawn}
