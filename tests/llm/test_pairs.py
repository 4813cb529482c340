import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.llm import neardup, overlap, unionfind, wordjoin

WORD = re.compile(r"[^\W_]+")
SCHEMA = "example_id bigint, natural_language string, sql string"


def words(*texts):
    return frozenset(WORD.findall(" ".join(t or "" for t in texts).lower()))


def fmt(*texts):
    return tuple("".join(WORD.findall((t or "").lower())) for t in texts)


def close(x, y, num=4, den=5):
    return bool(x or y) and len(x & y) * den >= num * len(x | y) and len(x) > 0 and len(y) > 0


def brute(rows):
    rows = sorted(set(rows))
    return {
        tuple(sorted((a[0], b[0])))
        for i, a in enumerate(rows)
        for b in rows[i + 1 :]
        if a[0] != b[0] and fmt(*a[1:]) != fmt(*b[1:]) and close(words(*a[1:]), words(*b[1:]))
    }


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r)[:2] for r in neardup.near_duplicates(df, "example_id", ["natural_language", "sql"], **more).pairs().collect()]


def edited(rng, text, vocabulary):
    out = list(text)
    for _ in range(rng.randint(0, max(1, len(out) // 6))):
        k = rng.randrange(len(out))
        out[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
    rng.shuffle(out) if rng.random() < 0.2 else None
    return out


@pytest.mark.parametrize(("seed", "rare", "hot", "block", "slice_rows"), [(0, 128, 512, 4096, 400_000), (1, 2, 512, 4096, 50), (2, 1, 1, 2, 400_000), (3, 4, 2, 3, 1), (4, 128, 3, 1, 7), (5, 10**6, 10**6, 2, 5)])
def test_pairs_equal_brute_force(spark, monkeypatch, seed, rare, hot, block, slice_rows):
    """Records of 1 to 300 words; a small `rare` or `hot` forces long n-grams, a small `block` salted keys."""
    monkeypatch.setattr(wordjoin, "SLICE", slice_rows)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, k = [], 0
    for _ in range(40):
        size = rng.choice([1, 2, 3, 5, 7, 8, 9, 10, 12, 30, 45, 60])
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.randint(1, 4)):
            text = edited(rng, base, vocabulary)
            rows.append((k, " ".join(text[: len(text) // 2]), "_".join(text[len(text) // 2 :])))
            k += 1
    big = [f"v{i}" for i in range(160)]
    for n in (100, 104, 126, 128, 129, 140, 160):
        rows.append((k, " ".join(big[:n]), None))
        k += 1
    got = found(spark, rows, rare=rare, hot=hot, block=block)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_long_records_join_on_ngrams(spark):
    """Sets around the bounds of the ranges, of words that all are frequent."""
    rng = random.Random(13)
    vocabulary = [f"f{i}" for i in range(700)]
    rows = []
    for k, n in enumerate([100, 125, 128, 129, 130, 160, 410, 500, 512, 513, 600, 640] * 2):
        rows.append((k, " ".join(rng.sample(vocabulary[: n + n // 12], n)), ""))
    assert set(found(spark, rows, rare=2, hot=4)) == brute(rows) and brute(rows)


def test_no_salted_key_has_more_holders_than_a_block(spark):
    """All records hold the words of one template and few of their own, so every key is hot."""
    rows = [(i, " ".join([f"t{k}" for k in range(8)] + [f"x{i}", f"y{i}"]), "") for i in range(600)]
    recs = wordjoin.records(spark.createDataFrame(rows, SCHEMA), "example_id", ["natural_language", "sql"])
    t = wordjoin.Threshold.of(0.6)
    sizes = {}
    for block in (10**6, 50):
        keys, _ = wordjoin.key_rows(recs, t, rare=10**6, hot=10**6, block=block)
        sides = keys.groupBy("key").agg(F.count_if(F.expr("side < 4")).alias("a"), F.count_if(F.expr("side < 2 or side > 3")).alias("b"))
        sizes[block] = sides.agg(F.max(F.greatest("a", "b"))).head()[0]
    assert sizes[10**6] == 600 and sizes[50] < 110
    pairs = wordjoin.candidates(recs, t, rare=10**6, hot=10**6, block=50).collect()
    assert len(pairs) == 600 * 599 // 2  # 8 of 12 words shared


def test_nulls_repeats_and_copies(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, text, "x"), (1, text, "x"), (2, text.upper(), "X!"), (3, text, "y"), (4, None, None), (5, "", "  "), (None, text, "z"), (6, text + " x", "")]
    got = found(spark, rows)
    assert sorted(got) == [(1, 3), (1, 6), (2, 3), (2, 6), (3, 6)]
    assert found(spark, []) == []


def test_hot_copies_meet_once(spark):
    text = " ".join(f"h{i}" for i in range(20))
    rows = [(i, text, "") for i in range(400)] + [(1000, text + " more", ""), (1001, "other words here", "")]
    got = found(spark, rows)
    assert len(got) == 400 and all(b == 1000 for _, b in got)


def test_groups(spark):
    base = [f"g{i}" for i in range(30)]
    rows = [(1, " ".join(base), ""), (2, " ".join(base[1:]), ""), (3, " ".join(base[6:]), ""), (4, " ".join(base[3:]), ""), (5, "alone", ""), (6, " ".join(base), "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.id: (r.class_id, r.group_id, r.n_links) for r in neardup.near_duplicates(df, "example_id", ["natural_language", "sql"]).groups().collect()}
    assert out[5] == (5, 5, 0) and out[6][0] == 1
    assert {out[i][1] for i in (1, 2, 3, 4, 6)} == {1}


def test_groups_keep_records_without_words(spark):
    rows = [(1, "a b c d e f g h i j", ""), (2, "a b c d e f g h i j k", ""), (3, None, None), (4, "", "  "), (5, "?!", None), (None, None, None)]
    near = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA), "example_id", ["natural_language", "sql"])
    assert sorted(tuple(r) for r in near.groups().collect()) == [(1, 1, 1, 1), (2, 2, 1, 1), (3, 3, 3, 0), (4, 4, 4, 0), (5, 5, 5, 0)]
    assert [tuple(r)[:2] for r in near.pairs().collect()] == [(1, 2)]


def test_clashing_columns(spark):
    rows = [(1, "a b c d e f g h i j", "q", 5, "s"), (2, "a b c d e f g h i k", "q j", 6, "t")]
    df = spark.createDataFrame(rows, "example_id bigint, natural_language string, sql string, id int, node string").withColumn("words", F.lit(1)).withColumn("fmt", F.lit(2)).withColumn("side", F.lit(3))
    out = neardup.near_duplicates(df, "example_id", ["natural_language", "sql"]).pairs().collect()
    assert [tuple(r)[:2] for r in out] == [(1, 2)]


def test_threshold_bounds():
    with pytest.raises(ValueError):
        wordjoin.Threshold.of(0.3)
    assert (wordjoin.Threshold.of(0.8).num, wordjoin.Threshold.of(0.8).den) == (4, 5)
    assert (wordjoin.Threshold.of(0.80125).num, wordjoin.Threshold.of(0.80125).den) == (641, 800)


def test_cross_split_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    spellings = ["train", "Training ", " TRAIN", "valid", "dev", "Test", "holdout", None, "other"]
    rows, k = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 6, 12, 30]))]
        for _ in range(3):
            rows.append((k, " ".join(edited(rng, base, vocabulary)), None, rng.choice(spellings), rng.choice(["a", None])))
            k += 1
    df = spark.createDataFrame(rows, "seed_id bigint, nl string, sql string, split string, source string")
    side = lambda s: None if s is None else {"train": 0, "training": 0, "valid": 1, "dev": 1, "test": 1, "holdout": 1}.get(s.strip().lower())
    want = {(a[0], b[0]) for a in rows for b in rows if side(a[3]) == 0 and side(b[3]) == 1 and close(words(a[1]), words(b[1]))}
    pairs = overlap.split_overlaps(df, "seed_id", ["nl", "sql"], "split", "source")
    got = [(r.train_id, r.eval_id) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    report = overlap.overlap_report(pairs)
    assert report.agg(F.sum("n_pairs")).head()[0] == len(want)
    assert overlap.split_overlaps(df.limit(0), "seed_id", ["nl", "sql"], "split").collect() == []


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_components_equal_a_plain_search(spark, limit):
    rng = random.Random(6)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(None, 3), (7, 7), (7, None)]
    got = {r.node: r.root for r in unionfind.components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(5), limit).collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [start] if start not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    assert got == want
    path = spark.createDataFrame([(i, i + 1) for i in range(120)], "u bigint, v bigint").repartition(8)
    assert {r.root for r in unionfind.components(path, limit).collect()} == {0}
    assert unionfind.components(path.limit(0)).collect() == []


def test_split_names_in_any_spelling(spark):
    names = {"Train": "train", " TRAINING set": "train", "train_1": "train", "valid": "validation", "Dev-Set": "validation", "evaluation": "validation", "TEST": "test", "hold-out": "test", "held out": "test", "other": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in names], "split string")
    assert {r.split: r.s for r in df.select("split", overlap.split_name("split").alias("s")).collect()} == names
