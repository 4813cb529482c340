import os
import random

import pytest
from pyspark.sql import functions as F

from pairloom.llm import encode, formatdup, packing, spam
from pairloom.llm import tokenizer as tok

NAME = "byte_bpe_50k"
needs_files = pytest.mark.skipif(not os.path.isdir(tok.TOKENIZER_DIR), reason="no tokenizer files")


def sample_texts(seed):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "日本", "語", "12", "3", " ", "  ", "\n", "\r\n", "\t", " ", "\xa0", "'s", "'ll", "'", "!", "??", "<|endoftext|>", "\x1c", "​", "🙂", "é"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(60)]


@needs_files
def test_segments_give_the_ids_of_whole_texts():
    t = tok.load(NAME)
    for text in sample_texts(1):
        ids = t.encode(text)
        assert ids == t.inner.encode_ordinary(text)
        assert t.decode(ids) == text


@needs_files
@pytest.mark.parametrize(("chunk", "overlap"), [(40, 16), (64, 8), (200, 64)])
def test_chunks_give_the_ids_of_whole_texts(spark, chunk, overlap):
    """Also where no boundary lies in an overlap, for repeated rows and null ids."""
    texts = [None, "", " ", "x" * 5000, "日" * 700, "a b " * 900, *sample_texts(2)]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(0)).withColumn("digest", F.lit("d"))
    got = [(r.id, r.ids) for r in encode.encode(df, "doc_id", "text", NAME, chunk=chunk, overlap=overlap).collect()]
    inner = tok.load(NAME).inner
    want = [(i, inner.encode_ordinary(t) if t else []) for i, t in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)


@needs_files
def test_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(sample_texts(3))), "doc_id bigint, text string")
    back = encode.decode(encode.encode(df, "doc_id", "text", NAME), "id", "ids", NAME)
    assert {r.id: r.text for r in back.collect()} == {r.doc_id: r.text for r in df.collect()}
    assert encode.encode(df.limit(0), "doc_id", "text", NAME).collect() == []


@needs_files
@pytest.mark.parametrize("name", ["word_bpe_49k", "piece_bpe_32k", "byte_bpe_multi_50k"])
def test_other_tokenizers_encode(spark, name):
    df = spark.createDataFrame([(1, "select a from b"), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.id: r.ids for r in encode.encode(df, "doc_id", "text", name).collect()}
    assert got[2] == got[3] == [] and len(got[1]) >= 4
    with pytest.raises(ValueError):
        tok.load("none")


def test_best_fit_fills_and_never_splits():
    rng = random.Random(4)
    for _ in range(50):
        items = [(k, rng.randint(1, 100)) for k in range(rng.randint(0, 60))]
        out = packing.best_fit(items, 100)
        assert sorted((i, n) for _, i, n in out) == sorted(items)
        boxes = {}
        for b, _, n in out:
            boxes[b] = boxes.get(b, 0) + n
        assert all(v <= 100 for v in boxes.values())
        if items:  # no two containers at most half full
            assert sum(v <= 50 for v in boxes.values()) <= 1


def items(spark, seed=5, n=3000):
    rng = random.Random(seed)
    rows = [(i, "hot" if rng.random() < 0.4 else f"s{rng.randrange(40)}", rng.choice([1, 5, 40, 300, 900])) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, source string, n_tokens bigint"), rows


def test_packing_places_every_token_once(spark):
    df, rows = items(spark)
    out = packing.pack(df, [packing.Spec(1, 64), packing.Spec(2, 1000)], window_tokens=50_000).collect()
    for spec, capacity in ((1, 64), (2, 1000)):
        mine = [r for r in out if r.spec_id == spec]
        spans = {}
        for r in mine:
            spans.setdefault(r.id, []).append((r.start, r.length))
        for i, _, n in rows:
            at = 0
            for start, length in sorted(spans[i]):
                assert start == at
                at += length
            assert at == n and (n > capacity or len(spans[i]) == 1)
        boxes = {}
        for r in mine:
            boxes[r.window, r.slot] = boxes.get((r.window, r.slot), 0) + r.length
        assert max(boxes.values()) <= capacity
        assert sum(boxes.values()) / (len(boxes) * capacity) > 0.9


def test_windows_hold_the_sources_in_proportion(spark):
    df, rows = items(spark)
    total = sum(r[2] for r in rows)
    planned = packing.schedule(df, window_tokens=total // 10).groupBy("window").agg(F.sum("n_tokens").alias("n"), F.sum(F.when(F.col("source") == "hot", F.col("n_tokens"))).alias("hot")).collect()
    share = sum(r[2] for r in rows if r[1] == "hot") / total
    assert len(planned) in (10, 11)
    for w in planned:
        assert abs(w.hot / w.n - share) < 0.05 and abs(w.n - total / len(planned)) < 0.1 * total / len(planned) + 40 * 900 / 2


def test_targets_set_the_mixture(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", 10) for i in range(2000)], "id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.75), ("b", 0.25)], "source string, share double")
    first = packing.schedule(df, 1000, targets).filter("window < 10").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.source: r.n for r in first} == {"a": 7500, "b": 2500}


def test_no_item_is_lost_whatever_the_targets(spark):
    df, rows = items(spark)
    for given in ([("hot", 0.9)], [("hot", 3.0), ("s1", 1.0), ("absent", 5.0)], [("s1", None), ("s2", 0.0), ("s3", float("nan")), ("s4", -1.0)], []):
        targets = spark.createDataFrame(given, "source string, share double")
        planned = packing.schedule(df, 20_000, targets)
        assert sorted((r.id, r.n_tokens) for r in planned.collect()) == sorted((i, n) for i, _, n in rows)
        full = planned.groupBy("window").agg(F.sum("n_tokens").alias("n")).collect()
        total = sum(n for _, _, n in rows)
        assert len(full) == -(-total // 20_000) and all(abs(w.n - total / len(full)) < 41 * 900 for w in full)


def test_a_dry_source_leaves_its_share_to_the_others(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], 10) for i in range(3000)], "id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 3.0), ("b", 1.0), (None, 1.0), ("c", None)], "source string, share double")
    got = {(r.window, r.source): r.n for r in packing.schedule(df, 1000, targets).groupBy("window", "source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert {w for w, _ in got} == set(range(30)) and all(abs(got[w, "a"] - 500) <= 10 and abs(got[w, "b"] - 167) <= 10 for w in range(20))
    assert all((w, "a") not in got and abs(got[w, "b"] - 333) <= 10 for w in range(20, 25)) and all(got[w, "b"] == 1000 for w in range(25, 30))


def test_packing_checks(spark):
    df, rows = items(spark, n=200)
    specs = spark.createDataFrame([(1, 64), (2, 1000)], "spec_id bigint, capacity bigint")
    packed = packing.pack(df, [packing.Spec(1, 64), packing.Spec(2, 1000)], 5000)
    assert sorted(tuple(r) for r in packing.checks(df, packed, specs).collect()) == [(1, 200, 0, 0, 0), (2, 200, 0, 0, 0)]
    lost = packing.checks(df, packed.filter("id <> 3"), specs).collect()
    assert {r.n_items for r in lost} == {199} and all(r.n_tokens_lost == rows[3][2] for r in lost)
    mix = packing.mixture(packing.schedule(df, 5000), spark.createDataFrame([("hot", 1.0), (None, 3.0)], "source string, share double")).collect()
    assert sum(r.n_items for r in mix) == 200 and {r.source: r.target for r in mix}["hot"] == 0.25


def test_packing_of_nothing_nulls_and_repeats(spark):
    schema = "id bigint, source string, n_tokens bigint"
    specs = [packing.Spec(7, 10)]
    assert packing.pack(spark.createDataFrame([], schema), specs).collect() == []
    out = packing.pack(spark.createDataFrame([(None, "s", 4), (1, "s", 4), (1, "s", 4), (2**60 + 1, "s", 25)], schema), specs).collect()
    assert sum(r.length for r in out) == 37 and max(r.id for r in out if r.id) == 2**60 + 1
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], schema), [packing.Spec(1, 0)])


@needs_files
def test_sizes_skip_texts_without_tokens(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "", "s"), (3, None, "s")], "doc_id bigint, text string, source string")
    assert [tuple(r) for r in packing.sizes(df, "doc_id", "text", "source", NAME).collect()] == [(1, "\x00", 2)]


GENUINE = "The loader skips blank lines and counts them as rejected, which surprised the team at the harbour."


@pytest.mark.parametrize(
    "text",
    [
        "\n".join(f"cheap schema designer Place{i}" for i in range(12)), " | ".join(["sql trainer", "best sql trainer", "free sql trainer"] * 12), "\n".join(f"#BestTool{i}" for i in range(20)),
        "\n".join(f'<a href="https://x{i}.example/tool">Place{i} query tool</a>' for i in range(10)), " ".join(f"https://x{i}.example/a?id={i}" for i in range(12)),
        " ".join(f"Looking for sql course? Our sql course is the best sql course in Place{i}." for i in range(8)), GENUINE + "\n\n" + ", ".join(f"report builder Place{i}" for i in range(40)),
        "\n".join(f"Place{i} mug {i}.50 | tags: base de données pas cher, meilleur, générateur de requêtes" for i in range(8)), "\n".join(["base de données pas cher", "gratuit base de données pas cher", "formation SQL"] * 8), "SQL - sql - SELECT - JOIN - dataset - AI - " * 20,
    ],
)
def test_spam(text):
    assert spam.judge(text)[0]


@pytest.mark.parametrize(
    "text",
    [
        None, "", "  \n ", GENUINE, "# Notes\n\nhttps://x.example/a\n" + f"{GENUINE} " * 2, "SELECT a, b FROM t WHERE c IN ('x', 'y') AND d = 3;\n" * 5, "CREATE TABLE t (\n  id INTEGER PRIMARY KEY,\n  a TEXT,\n  b TEXT\n);",
        "| model | score |\n|---|---|\n" + "\n".join(f"| m{i} | {i} | 0.{i} |" for i in range(20)), '{"nl": "Find the rows", "sql": "SELECT 1"}\n' * 6, "教師モデルは二度出ると混乱しやすい。質問は手作業で書かれました。" * 4,
        "- " + GENUINE + "\n- In der Regel dauert die Prüfung ungefähr 48 Minuten und läuft über Nacht.", "Title only",
    ],
)
def test_no_spam(text):
    assert not spam.judge(text)[0]


@pytest.mark.parametrize(
    "text",
    [
        "数据库查询、数据库查询、数据库查询、数据库查询\n" * 6, "数据库 查询 模型 训练 下载 教程\n免费下载 优惠 折扣 数据库 软件\n" * 5, "#数据库查询 #模型训练 #数据标注 #免费下载\n" * 6, "数据库查询教程下载\n" * 12,
        "データベース検索、機械学習、モデル訓練、無料ダウンロード、質問応答\n" * 6, "データベース検索 データベース検索 データベース検索\n" * 6, "無料ダウンロード｜検索モデル｜学習データ｜質問応答｜価格比較\n" * 6,
        "데이터베이스 쿼리, 모델 학습, 무료 다운로드, 가격 비교, 할인 쿠폰\n" * 6, "무료 다운로드 무료 다운로드 무료 다운로드 무료 다운로드\n" * 6,
        "数据库查询、数据库查询、数据库查询、数据库查询\n" * 6 + "质量检查是手工完成的，结果也写在报告里。",
    ],
)
def test_spam_in_chinese_japanese_and_korean(text):
    assert spam.judge(text)[0]


@pytest.mark.parametrize(
    "text",
    [
        "我们把问题和查询放在一起检查，发现有些答案不对。\n训练数据由人工编写，并且经过两次审核\n" * 3, "問題的答案與資料庫裡的紀錄不一致，所以我們重新寫了這個查詢\n" * 3, "質問と答えを二人で確認し、間違いがあれば書き直します\nデータは手作業で集めたものです。" * 3,
        "질문은 사람이 직접 작성했고, 답은 두 번 확인했다.\n데이터베이스에서 가져온 결과를 모델의 출력과 비교한다.\n" * 3, "颜色、大小、形状、重量和价格都是在表里的列，也可以从别的表中取出。\n" * 3,
        "数据库查询、数据库查询、数据库查询、数据库查询\n" + "我们把问题和查询放在一起检查，发现有些答案不对，于是重新写了一遍。\n" * 4,
    ],
)
def test_no_spam_in_chinese_japanese_and_korean(text):
    assert not spam.judge(text)[0]


# Prose of languages whose function words the rules don't hold.
FOREIGN = [
    "De gemeente heeft vorige week besloten dat het nieuwe zwembad pas volgend jaar open gaat. Volgens de wethouder duurt het werk langer omdat de fundering niet sterk genoeg bleek te zijn. Bewoners reageerden teleurgesteld op het bericht, maar begrijpen dat veiligheid voorop staat.",
    "Вчера городской совет объявил, что новая библиотека откроется только осенью. По словам директора, строительство задержалось из-за плохой погоды и нехватки материалов. Жители района надеются, что открытие больше не будут переносить.",
    "Rada miasta ogłosiła wczoraj, że nowa biblioteka zostanie otwarta dopiero jesienią. Według dyrektora budowa opóźniła się z powodu złej pogody. Mieszkańcy mają nadzieję, że termin nie zostanie ponownie przesunięty.",
    "Kaupunginvaltuusto ilmoitti eilen, että uusi kirjasto avataan vasta syksyllä ensi vuonna. Johtajan mukaan rakentaminen viivästyi huonon sään ja materiaalipulan vuoksi. Asukkaat toivovat, ettei avajaisia enää siirretä.",
    "Belediye meclisi dün yeni kütüphanenin ancak sonbaharda açılacağını duyurdu. Müdüre göre inşaat kötü hava ve malzeme eksikliği nedeniyle gecikti. Mahalle sakinleri açılışın bir daha ertelenmeyeceğini umuyor.",
]


@pytest.mark.parametrize("text", FOREIGN)
def test_prose_of_any_language_is_no_spam(text):
    assert not spam.judge(text)[0] and not spam.judge(text + "\n\n" + text)[0]
    assert spam.judge("\n".join(f"goedkoop zwembad Plaats{i}, zwembad kopen Plaats{i}" for i in range(30)) + "\n" + text[:80])[0]
    assert spam.judge(" ".join(f"Zoek een zwembad cursus? Onze zwembad cursus blijft beste zwembad cursus binnen Plaats{i}." for i in range(8)))[0]


def test_many_kinds_of_spam_shapes_do_not_hide_it():
    kinds = [" | ".join(["best tool"] * k) + f" {'x ' * (k % 5)}#tag{k}" for k in range(2, 14)] + [", ".join(["Cheap Query"] * k) for k in range(2, 9)] + [" - ".join(["free schema maker"] * k) for k in range(2, 9)]
    assert spam.judge("\n".join(kinds))[0]


def test_pages_table(spark):
    df = spark.createDataFrame([(1, "#A #B " * 20_000), (1, "#A #B " * 20_000), (None, None), (3, GENUINE)], "doc_id bigint, text string").withColumn("shape", F.lit(1))
    got = spam.judged_pages(df, "doc_id", "text").collect()
    assert [r.spam for r in got] == [True, True, False, False]
    assert spam.shape_report(spam.judged_pages(df, "doc_id", "text")).agg(F.sum("n_spam")).head()[0] == 2
    assert spam.judged_pages(df.limit(0), "doc_id", "text").collect() == []


def collapse(rows, key):
    groups = {}
    for i, k in rows:
        groups.setdefault(key(k), []).append(i)
    return groups


@pytest.mark.parametrize("limit", [1 << 25, 40])
def test_format_copies_equal_brute_force(spark, limit):
    rng = random.Random(8)
    base = [rng.choice(["select a_b from t", "Été 1", "x", "", "find the rows of the table that holds more than thirty two bytes"]) + rng.choice(["", " q", " r"]) for _ in range(12)]
    rows = [(i, rng.choice(base)) for i in range(300)]
    noisy = [(i, "".join(c.upper() if rng.random() < 0.3 else c for c in t).replace(" ", rng.choice([" ", "  ", "_", "-\t"])), None) for i, t in rows]
    df = spark.createDataFrame(noisy, "id bigint, a string, b string").repartition(6)
    done = formatdup.FormatDuplicates(formatdup.canonical(df, "t", "id", ["a", "b"]), bucket_bytes=limit)
    want = collapse(rows, lambda t: "".join(c for c in t.lower() if c.isalnum()))
    copies = [tuple(r) for r in done.copies().collect()]
    assert sorted(copies) == sorted(("t", min(g), i) for g in want.values() for i in g if i != min(g))
    assert sorted((r.keep_id, r.n_copies) for r in done.counts().collect()) == sorted((min(g), len(g)) for g in want.values())


def test_format_copies_fields_tables_repeats(spark):
    schema = "id bigint, a string, b string"
    one = formatdup.canonical(spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc"), (3, None, ""), (4, "", None), (5, "AB", "C"), (5, "AB", "C"), (None, "ab", "c")], schema), "x", "id", ["a", "b"])
    two = formatdup.canonical(spark.createDataFrame([(9, "ab", "c")], schema), "y", "id", ["a", "b"])
    done = formatdup.FormatDuplicates(one.unionByName(two))
    assert sorted(tuple(r) for r in done.copies().distinct().collect()) == [("x", 1, 5), ("x", 3, 4)]
    assert {(r.table_name, r.keep_id): r.n_copies for r in done.counts().collect()} == {("x", 1): 3, ("x", 2): 1, ("x", 3): 2, ("y", 9): 1}
    empty = formatdup.FormatDuplicates(one.limit(0))
    assert empty.copies().collect() == [] and empty.counts().collect() == []


def test_a_key_in_many_map_tasks_needs_no_depth(spark):
    df = spark.range(40, numPartitions=40).select(F.col("id"), F.lit("k" * 1000).alias("a"))
    records = formatdup.canonical(df, "t", "id", ["a"])
    local = records.mapInArrow(formatdup._fold, "table_name string, id bigint, local_keep bigint, canon binary, n_local bigint")
    heads = local.withColumn("digest", F.md5("canon"))
    depths, most = formatdup.bucket_depths(heads, 20_000)
    assert heads.count() == 40 and most == 1 and [r.depth for r in depths.collect()] == [1]
    assert [tuple(r) for r in formatdup.FormatDuplicates(records, bucket_bytes=20_000).counts().collect()] == [("t", 0, 40)]


def test_only_oversized_buckets_are_split(spark):
    rows = [("t", f"{k:02x}" + "0" * 30, bytes(50)) for k in range(4)] + [("t", "ff" + f"{k:02x}" + "0" * 28, bytes(50)) for k in range(200)] + [("u", "ff" + "0" * 30, bytes(5000))]
    heads = spark.createDataFrame(rows, "table_name string, digest string, canon binary")
    depths, most = formatdup.bucket_depths(heads, 100)
    got = {(r.table_name, r.prefix): r.depth for r in depths.collect()}
    assert most == 2 and {d for (t, p), d in got.items() if t == "t" and p[:2] != "ff"} == {1}
    assert {d for (t, p), d in got.items() if t == "t" and p[:2] == "ff"} == {2} and {d for (t, _), d in got.items() if t == "u"} == {2}


def test_parsed_lines(spark):
    lines = ['{"sql": "S", "nl": "q"}', '{"natural_language": null, "nl": "r", "sql": 3}', "[1]", "null", "", None, "{bad", '{"a": 1} x', '{"sql": "\\u00e9"}']
    df = spark.createDataFrame(list(enumerate(lines)), "line_id bigint, line string")
    got = sorted(tuple(r) for r in formatdup.parsed_lines(df, "line_id", "line", {"q": ["natural_language", "nl"], "s": ["sql"]}).collect())
    assert got == [(0, "q", "S"), (1, "r", "3"), (8, None, "é")]


def test_trie_equals_a_dictionary():
    rng = random.Random(9)
    trie, plain = formatdup.Trie(), {}
    for _ in range(2000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 31, 32, 33, 64, 65])))
        if rng.random() < 0.5 and plain:
            key = rng.choice(list(plain))[: rng.randint(0, 70)]
        trie.add(key).append(1)
        plain[key] = plain.get(key, 0) + 1
    assert all(len(trie.add(k)) == n for k, n in plain.items())
