import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.operators import balance, dedup, filters, ranking, split
from pairloom.plans import curation

SMALL = "/root/testdata/sf0.001"

RECORDS = [
    (0, "Show users", "SELECT * FROM users", 4.5, "easy"),
    (1, "Count users", "SELECT COUNT(*) FROM users", 4.0, "easy"),
    (2, "Show users", "SELECT * FROM users", 4.5, "medium"),
    (3, "Join", "SELECT 1 FROM a JOIN b", 2.0, "hard"),
    (4, "Count users", "SELECT COUNT(*) FROM users", None, "hard"),
    (5, None, None, float("nan"), None),
]
SCHEMA = "pos bigint, nl string, sql string, score double, difficulty string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(RECORDS, SCHEMA)


def ids(df, name="pos"):
    return sorted(r[0] for r in df.select(name).collect())


def test_exact_dedup_first_and_last(rows):
    assert ids(dedup.exact_dedup(rows, ["nl", "sql"], "pos")) == [0, 1, 3, 5]
    assert ids(dedup.exact_dedup(rows, ["nl", "sql"], "pos", "last")) == [2, 3, 4, 5]
    assert dedup.exact_dedup(rows, ["nl"], "pos").columns == rows.columns
    with pytest.raises(ValueError):
        dedup.exact_dedup(rows, ["nl"], "pos", "any")


def test_exact_dedup_null_equals_empty_but_fields_stay_apart(spark):
    df = spark.createDataFrame([(1, None, "ab"), (2, "", "ab"), (3, "a", "b"), (4, "ab", "")], "pos int, nl string, sql string")
    assert ids(dedup.exact_dedup(df, ["nl", "sql"], "pos")) == [1, 3, 4]


def test_exact_dedup_of_nothing_and_clashing_names(spark):
    df = spark.createDataFrame([], "pos int, nl string, _kept int, _f string")
    assert dedup.exact_dedup(df, ["nl"], "pos").collect() == []
    df = spark.createDataFrame([(1, "a", 9, "x"), (2, "a", 8, "y")], "pos int, nl string, _kept int, _f string")
    assert [tuple(r) for r in dedup.exact_dedup(df, ["nl"], "pos").collect()] == [(1, "a", 9, "x")]


def sequential(pairs, n):
    near = {}
    for a, b in pairs:
        near.setdefault(b, set()).add(a)
    kept = set()
    for i in range(n):
        if not near.get(i, set()) & kept:
            kept.add(i)
    return set(range(n)) - kept


@pytest.mark.parametrize("seed", range(3))
def test_greedy_drops_equal_the_sequential_loop(spark, seed):
    rng = random.Random(seed)
    n = 40
    pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(60)})
    df = spark.createDataFrame(pairs, "pos_a bigint, pos_b bigint")
    assert {r[0] for r in dedup.greedy_drops(df).collect()} == sequential(pairs, n)


def test_fuzzy_dedup_keeps_first_of_equal_token_sets_and_one_text_without_tokens(spark):
    texts = ["a b c d e f g", "g f e d c b a", "x y z", "!!", None, "x y z w v u t s r q"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    assert ids(dedup.fuzzy_dedup(df, "text", "pos", 0.85)) == [0, 2, 3, 5]


def test_minhash_estimates_similarity(spark):
    base = [f"w{i}" for i in range(60)]
    near = [*base[:58], "other", "words"]
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(f"v{i}" for i in range(60)))], "pos bigint, text string")
    assert [tuple(r) for r in dedup.minhash_pairs(df, "text", "pos", 0.7).collect()] == [(1, 2)]


def test_bands_follow_the_threshold():
    assert dedup.best_bands(0.85, 128) == (8, 16)
    assert dedup.best_bands(0.5, 128) == (25, 5)
    with pytest.raises(ValueError):
        dedup.best_bands(0, 128)


def test_length_filter_counts_null_as_zero(rows):
    assert ids(rows.filter(filters.length_within(["nl", "sql"], 5, 30))) == [0, 1, 2, 4]


def test_score_filter_keeps_missing_and_drops_nan_and_text(spark, rows):
    assert ids(rows.filter(filters.score_at_least("score", 3.0))) == [0, 1, 2, 4]
    texts = spark.createDataFrame([(1, "4"), (2, "good"), (3, None), (4, "2.9")], "pos int, score string")
    assert ids(texts.filter(filters.score_at_least("score", 3.0))) == [1, 3]


def test_sql_present(spark):
    df = spark.createDataFrame([(1, "SELECT 1"), (2, " \n"), (3, None), (4, "INSERT INTO t VALUES (1)"), (5, "?? what")], "pos int, sql string")
    assert ids(df.filter(filters.sql_present())) == [1, 4]


def test_filter_chain_counts_and_result_agree(rows):
    chain = filters.FilterChain(rows).length(["nl", "sql"]).keywords().score()
    counts = {r.label: (r.removed, r.remaining) for r in chain.counts().collect()}
    assert counts == {"length": (1, 5), "keywords": (0, 5), "score": (1, 4)}
    assert chain.result().count() == 4


def test_heuristic_issues_in_order(spark):
    df = spark.createDataFrame([("Hi", "nope"), ("SELECT the {{x}} rows", "SELECT (1 FROM t"), ("What is the total per region?", "SELECT sum(x) FROM t")], "nl string, sql string")
    got = [r[0] for r in df.select(filters.heuristic_issues(F.col("nl"), F.col("sql"))).collect()]
    assert got[0] == ["NL too short (2 < 10)", "SQL too short (4 < 10)", "SQL missing standard keywords (SELECT/INSERT/UPDATE/DELETE/WITH)"]
    assert got[1] == ["NL looks like raw SQL, not natural language", "NL contains template placeholders", "SQL has unbalanced parentheses"]
    assert got[2] == []


def test_syntax_issue(spark):
    cases = {"SELECT 'a": "SQL has unclosed string literal", "SELECT 'it''s'": None, "SELECT a, ;": "SQL ends with a trailing comma", " ": "SQL holds no statement"}
    df = spark.createDataFrame([(k,) for k in cases], "sql string")
    assert {r[0]: r[1] for r in df.select("sql", filters.syntax_issue(F.col("sql"))).collect()} == cases


def test_quality_counts_a_score_only_if_the_cheap_checks_pass(spark):
    df = spark.createDataFrame([("How many users are there?", "SELECT count(*) FROM users", 2.0), ("How many users are there?", "SELECT count(*) FROM users", None), ("x", "y", 5.0)], "nl string, sql string, s double")
    got = df.select(filters.quality(F.col("nl"), F.col("sql"), F.col("s")).alias("q")).select("q.passed", "q.llm_score").collect()
    assert [tuple(r) for r in got] == [(False, 2.0), (True, None), (False, None)]


def test_unsafe_needs_a_whole_word_between_blanks(spark):
    df = spark.createDataFrame([("drop table t",), ("DROP;",), ("SELECT 'x drop y'",), ("insert into t select 1",), (None,)], "sql string")
    assert [r[0] for r in df.select(filters.unsafe(F.col("sql"))).collect()] == [True, False, True, False, False]
    assert [r[0] for r in df.select(filters.unsafe(F.col("sql"), False)).collect()] == [True, False, True, True, False]


def test_balance_both_is_exact(spark):
    df = spark.createDataFrame([(i, "easy" if i < 50 else "hard") for i in range(60)], "id bigint, difficulty string")
    out = balance.rebalance(df, "difficulty", {"easy": 0.5, "hard": 0.5}, F.col("id"), "both", 1)
    assert {r[0]: r[1] for r in out.groupBy("difficulty").count().collect()} == {"easy": 30, "hard": 30}
    hard = out.filter("difficulty = 'hard'").groupBy("id").count()
    assert hard.count() == 10 and out.columns == df.columns


def test_balance_edge_rules(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, difficulty string")
    down = {r.category: r.target for r in balance.target_counts(df, "difficulty", {"a": 1, "b": 0, "zzz": 1}, "downsample").collect()}
    assert down == {"a": 2, "b": 1}
    absent = {r.category: r.target for r in balance.target_counts(df, "difficulty", {"zzz": 1}, "upsample").collect()}
    assert absent == {"a": 2, "b": 1, "__unknown__": 1}
    assert balance.target_counts(df, "difficulty", {"zzz": 1}, "both").collect() == []
    with pytest.raises(ValueError):
        balance.target_counts(df, "difficulty", {}, "both")


def test_ranks_equal_a_plain_sort(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b", None])) for i in range(500)]
    df = spark.createDataFrame(data, "id bigint, g string").repartition(7)
    out = ranking.permuted_rank(df, F.coalesce("g", F.lit("-")), F.col("id"), 5, "r", "n").collect()
    for g in ("a", "b", None):
        members = sorted((hashlib.md5(f"5:{i}".encode()).hexdigest(), i) for i, x in data if x == g)
        assert [r.id for r in sorted((r for r in out if r.g == g), key=lambda r: r.r)] == [i for _, i in members]
        assert {r.n for r in out if r.g == g} == {len(members)}


def test_split_sizes_and_determinism(spark):
    df = spark.createDataFrame([(i, ["easy", "medium", "hard"][i % 3]) for i in range(100)], "id bigint, difficulty string")
    one = split.split(df, F.col("id"), seed=3)
    assert {r[0]: r[1] for r in one.groupBy("split").count().collect()} == {"train": 80, "validation": 10, "test": 10}
    two = split.split(df.repartition(9), F.col("id"), seed=3)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}
    strat = split.split(df, F.col("id"), stratify="difficulty", seed=3)
    assert strat.filter("split = 'test'").select("difficulty").distinct().count() == 3
    stats = split.split_stats(strat, "split", "difficulty")
    assert stats.filter("category is null").agg(F.sum("n")).head()[0] == 100
    with pytest.raises(ValueError):
        split.split(df, F.col("id"), {"a": 0.0})


def test_split_of_nothing_and_clashing_names(spark):
    assert split.split(spark.createDataFrame([], "id bigint, _rank int"), F.col("id")).collect() == []
    df = spark.createDataFrame([(1, 7, "x"), (2, 8, "y")], "id bigint, _rank int, _hash string")
    out = split.split(df, F.col("id"), {"a": 0.5, "b": 0.5})
    assert out.columns == ["id", "_rank", "_hash", "split"] and out.count() == 2


def test_few_shot_falls_back_to_all(spark):
    df = spark.createDataFrame([(i, "hard" if i < 2 else "easy", "c") for i in range(10)], "id int, difficulty string, category string")
    assert split.few_shot(df, 3, F.col("id"), "category", category="none").count() == 3
    got = split.few_shot(df, 5, F.col("id"), "difficulty", difficulty="hard")
    assert got.filter("difficulty = 'hard'").count() == 2 and got.count() == 5


def test_minhash_pairs_equal_signatures_made_one_by_one(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(sorted(rng.sample(base, rng.randint(34, 40)))) for _ in range(30)]
    a, b = dedup.permutations(32, 42)
    bands, rows_ = dedup.best_bands(0.6, 32)

    def signature(text):
        hashes = [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in set(text.split())]
        return [min((h * int(x) + int(y)) % dedup.PRIME for h in hashes) for x, y in zip(a, b)]

    first, want = {}, set()
    for i, t in enumerate(texts):
        first.setdefault(frozenset(t.split()), i)
    sigs = {i: signature(texts[i]) for i in first.values()}
    for i in sigs:
        for j in sigs:
            if i < j and any(sigs[i][k * rows_ : (k + 1) * rows_] == sigs[j][k * rows_ : (k + 1) * rows_] for k in range(bands)):
                want.add((i, j))
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    assert {tuple(r) for r in dedup.minhash_pairs(df, "text", "pos", 0.6, 32).collect()} == want and want


def test_minhash_links_hold_every_row_of_a_class(spark):
    """Copies that differ in case, marks, spacing and word order, of two texts that resemble each other."""
    base, other = [f"w{i}" for i in range(40)], [*[f"w{i}" for i in range(40)], "more"]
    shapes = [" ".join, lambda w: ", ".join(w).upper(), lambda w: "  ".join(reversed(w)) + "?"]
    texts = [f(w) for f in shapes for w in (base, other)] + ["!!", None, "alone here", shapes[0](base)]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    links = [tuple(r) for r in dedup.minhash_links(df, "text", "pos", 0.7).collect()]
    assert sorted(links) == [(0, 1, False), (0, 2, True), (0, 4, True), (0, 9, True), (1, 3, True), (1, 5, True), (6, 7, True)]
    head = {b: a for a, b, same in links if same}
    near = {(a, b) for a, b, same in links if not same}
    linked = {(i, j) for i in range(10) for j in range(i + 1, 10) if head.get(i, i) == head.get(j, j) or tuple(sorted((head.get(i, i), head.get(j, j)))) in near}
    alike = {0, 1, 2, 3, 4, 5, 9}
    assert linked == {(i, j) for i in alike for j in alike if i < j} | {(6, 7)}
    copies = spark.createDataFrame([(i, shapes[i % 3](base)) for i in range(300)], "pos bigint, text string")
    assert dedup.minhash_links(copies, "text", "pos").count() == 299


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_fuzzy_queries_equal_the_sequential_loop_over_generated_examples(spark):
    rows = sorted((r.example_id, r.natural_language or "") for r in spark.read.parquet(f"{SMALL}/generated_examples.parquet").select("example_id", "natural_language").collect())
    bands, width = dedup.best_bands(0.85, 128)
    a, b = dedup.permutations(128, 42)
    sets, first, index, kept, same, near = {}, {}, {}, [], set(), set()
    for i, text in rows:
        key = frozenset(int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in re.findall(r"\w+", text.lower()))
        same |= {(first[key], i)} if first.setdefault(key, i) != i else set()
        sets.setdefault(key, [min(((h * int(x) + int(y)) % dedup.PRIME for h in key), default=dedup.PRIME) for x, y in zip(a, b)])
        keys = {(k, *sets[key][k * width : (k + 1) * width]) for k in range(bands)}
        if not any(k in index for k in keys):
            kept.append(i)
            index |= dict.fromkeys(keys, i)
    for p, i in first.items():
        near |= {(i, j) for q, j in first.items() if i < j and any(sets[p][k * width : (k + 1) * width] == sets[q][k * width : (k + 1) * width] for k in range(bands))}
    assert sorted(r.example_id for r in curation.fuzzy_dedup(spark, SMALL).collect()) == kept and len(kept) < len(rows)
    assert {tuple(r) for r in curation.fuzzy_pairs(spark, SMALL).collect()} == {(*x, True) for x in same} | {(*x, False) for x in near}
    assert same and near


def test_buckets_of_any_size_equal_the_sequential_loop(spark):
    rng = random.Random(4)
    for _ in range(3):
        members = sorted({(rng.randrange(60), rng.randrange(40)) for _ in range(90)} | {(p, 99) for p in range(50, 60)})
        stay, gone = [], set()
        for pos in range(60):
            mine = {v for p, v in members if p == pos}
            if any(mine & {v for p, v in members if p == k} for k in stay):
                gone.add(pos)
            else:
                stay.append(pos)
        df = spark.createDataFrame(members, "pos bigint, v bigint")
        assert {r[0] for r in dedup.bucket_drops(df).collect()} == gone
        assert {r[0] for r in dedup.bucket_drops(df, task_rows=0).collect()} == gone
    assert dedup.bucket_drops(df.limit(0)).collect() == []


def test_recall_of_minhash_pairs(spark):
    """Pairs of a true overlap well above the threshold are found with a recall of 0.9 or more."""
    rng = random.Random(5)
    rows = []
    for k in range(300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:39] + [f"x{k}"]))]  # overlap 39 of 41
    got = {tuple(r) for r in dedup.minhash_pairs(spark.createDataFrame(rows, "pos bigint, text string"), "text", "pos").collect()}
    assert len(got & {(2 * k, 2 * k + 1) for k in range(300)}) >= 270


def test_disks_buses_and_summaries(spark):
    rows = [("/dev/sda1", "ext4", "sata"), ("/dev/nvme0n1p2", "btrfs", "NVMe"), ("tmpfs", "TMPFS", None), ("/dev/loop3", "xfs", "usb"), ("x", None, ""), ("/dev/mmcblk0p1", "vfat", "mmc"), (None, "ext4", "UASP"), ("/dev/fuse", "fuse", "sas")]
    df = spark.createDataFrame(rows, "d string, f string, b string").select(filters.disk_kind(F.col("d"), F.col("f")).alias("k"), filters.bus_class(F.col("b")).alias("c"))
    assert [(r.k, r.c.builtin, r.c.bus) for r in df.collect()] == [
        ("sda", True, "SATA"), ("nvme0n1", True, "NVME"), ("skip", False, "Unknown"), ("skip", False, "USB"), ("skip", False, "Unknown"), ("mmcblk0", False, "MMC"), ("", False, "UASP"), ("skip", True, "SAS"),
    ]
    q = filters.quality(F.col("n"), F.col("s"), F.lit(4.25))
    made = spark.createDataFrame([("What are all the names?", "SELECT name FROM users"), ("Hi", "SELECT name FROM users,")], "n string, s string").select(filters.quality_summary(q).alias("x")).collect()
    assert made[0].x == "[PASS] llm_score=4.2" and made[1].x == "[FAIL] heuristic_fail syntax_fail issues=[NL too short (2 < 10), SQL ends with a trailing comma]"


def test_seed_subsets_and_order(spark):
    df = spark.range(30).select(F.col("id"), F.lit("q").alias("request"))
    asked = spark.createDataFrame([(7,), (8,), (None,)], "job int")
    got = split.seed_subsets(df.select("id"), asked, "job", F.col("id"), 5).collect()
    assert len(got) == 10 and all(len({r.id for r in got if r.request == k}) == 5 for k in (7, 8))
    assert split.seed_subsets(df.select("id").limit(2), asked.filter("job = 7"), "job", F.col("id"), 5).count() == 2
    assert split.seed_subsets(df.select("id").limit(0), asked, "job", F.col("id"), 5).collect() == []
    assert sorted(r.id for r in split.shuffled(df, F.col("id")).collect()) == list(range(30)) != [r.id for r in split.shuffled(df, F.col("id")).collect()]
    assert [r.id for r in split.first_rows(df, "id", 2).collect()] == [0, 1] and split.first_rows(df, "id", -1).collect() == []
    assert [tuple(r) for r in balance.unknown_categories(df, "request", {"a": 1.0}).collect()] == [("q", 30)]
