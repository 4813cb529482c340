import random

import pytest
from pyspark.sql import functions as F

from pairloom.functions import chat, metrics, porter, responses, text, tokens


def one(spark, column, **values):
    kinds = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], kinds).select(column).head()[0]


def test_tokens_are_unicode_words(spark):
    assert one(spark, text.tokens(F.col("t")), t="Été à_la 3 fois, non?") == ["été", "à_la", "3", "fois", "non"]
    assert one(spark, text.tokens(F.col("t")), t=None) == []


def test_normal_forms(spark):
    assert one(spark, text.normalize_sql(F.col("t")), t="  SELECT  a -- note\n FROM t /* x */ WHERE b = '--no' ;; ") == "select a from t where b = '--no'"
    assert one(spark, text.normalize_text(F.col("t")), t=" A \n\t b ") == "a b"
    assert one(spark, text.first_line(F.col("t")), t="\n SELECT 1 \nmore") == "SELECT 1"
    assert one(spark, text.slug(F.col("t")), t="  My Model/8B ") == "my-model-8b"
    assert one(spark, text.slug(F.col("t")), t="--") == "model"


@pytest.mark.parametrize(
    ("response", "score"),
    [('{"score": 4, "reason": "ok"}', 4.0), ("I would give it a 5 out of 5", 5.0), ('```json\n{"score": 10}\n```', 5.0), ('{"score": -2}', 1.0), ("4", 3.0), ("no idea", 3.0), ('{"reason": "x"}', 3.0)],
)
def test_quality_score(spark, response, score):
    assert one(spark, responses.quality_score(F.col("t")), t=response) == score


def test_judgement(spark):
    got = one(spark, responses.judgement(F.col("t")), t='```json\n{"score": 4, "overall": "fine",}\n```')
    assert got.score == 4 and got.overall == "fine" and got.correctness == ""
    for bad in ('{"score": 9}', "[]", "4", "nonsense", '{"overall": "x"}'):
        assert one(spark, responses.judgement(F.col("t")), t=bad) is None


def test_examples_from_responses(spark):
    made = responses.kept_examples(F.col("t"), "medium", "seed")
    got = one(spark, made, t='Sure:\n[{"natural_language": " a ", "sql": "SELECT 1",}, {"natural_language": "", "sql": "x"},]')
    assert [tuple(r) for r in got] == [("a", "SELECT 1", "medium", "", "seed")]
    got = one(spark, made, t='{"natural_language": "b", "sql": "SELECT 2"} and {broken} and {"natural_language": "c", "sql": "SELECT 3", "difficulty": "hard"}')
    assert [r.natural_language for r in got] == ["b", "c"]
    assert one(spark, made, t="nothing") == []


def test_sql_cleaning(spark):
    assert one(spark, responses.extracted_sql(F.col("t")), t="Here: ```SQL\nSELECT 1\n``` done") == "SELECT 1"
    assert one(spark, responses.extracted_sql(F.col("t")), t="Query - SELECT 2") == "SELECT 2"
    assert one(spark, responses.served_sql(F.col("t")), t="```sql\nSELECT 1\n```") == "SELECT 1;"
    assert one(spark, responses.served_sql(F.col("t")), t="  ") == ""


def turns(spark, data):
    return spark.createDataFrame([(data,)], "turns array<struct<role:string,content:string>>")


def mistral(data):
    parts, system, user = ["<s>"], None, None
    for role, content in data:
        if role == "system":
            system = content
        elif role == "user":
            user = f"{system}\n\n{content}" if system is not None else content
            system = None
        elif role == "assistant":
            parts.append((f"[INST] {user} [/INST]" if user is not None else "") + f"{content}</s>")
            user = None
    return "".join(parts) + (f"[INST] {user} [/INST]" if user is not None else "")


def test_mistral_fold_equals_the_sequential_rules(spark):
    rng = random.Random(2)
    for _ in range(8):
        data = [(rng.choice(["system", "user", "assistant", "tool"]), f"t{i}") for i in range(rng.randint(0, 7))]
        assert turns(spark, data).select(chat.render(F.col("turns"), " Mixtral ")).head()[0] == mistral(data)


def test_other_families_and_layouts(spark):
    df = turns(spark, [("user", "q"), ("assistant", "a"), ("tool", "x")])
    assert df.select(chat.llama(F.col("turns"))).head()[0] == "<|begin_of_text|>" + "".join(f"<|start_header_id|>{r}<|end_header_id|>\n\n{c}<|eot_id|>" for r, c in (("user", "q"), ("assistant", "a"), ("tool", "x")))
    assert df.select(chat.phi(F.col("turns"))).head()[0] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|tool|>\nx<|end|>"
    assert [r["from"] for r in df.select(chat.shared_turns(F.col("turns"))).head()[0]] == ["human", "gpt", "tool"]
    with pytest.raises(ValueError):
        chat.family("gpt")


def test_user_content(spark):
    c = chat.user_content(F.col("nl"), F.col("s"), F.col("d"))
    assert one(spark, c, nl="q", s="T", d="easy") == "Schema:\nT\n\nq\n\n[Difficulty: easy]"
    assert one(spark, c, nl="q", s="", d=None) == "q"


def test_few_shot_styles(spark):
    df = spark.createDataFrame([([("q", "SELECT 1", "easy"), ("r", "SELECT 2", None)],), ([],), (None,)], "e array<struct<natural_language:string,sql:string,difficulty:string>>")
    got = [r[0] for r in df.select(chat.few_shot(F.col("e"))).collect()]
    assert got[0] == "Example 1:\n  Question: q\n  SQL: SELECT 1\n  Difficulty: easy\n\nExample 2:\n  Question: r\n  SQL: SELECT 2"
    assert got[1] == got[2] == "(No few-shot examples available.)"


def test_bleu_and_rouge():
    same = "select a from t where b"
    assert metrics.bleu(same, same) == pytest.approx(1.0)
    assert metrics.bleu("x y z", "a b c") == 0.0
    assert metrics.bleu("", "") == 1.0 and metrics.bleu("a", "") == 0.0 and metrics.bleu("", "a") == 0.0
    assert metrics.rouge(same, same) == (1.0, 1.0, 1.0)
    assert metrics.rouge("running dogs", "run dog", stemmed=True)[0] == pytest.approx(1.0)
    assert metrics.rouge("running dogs", "run dog", stemmed=False)[0] == 0.0
    assert metrics.rouge("", "a") == (0.0, 0.0, 0.0)


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence_equals_the_table():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert metrics._common(a, b) == longest(a, b)


def test_stemmer():
    words = {"caresses": "caress", "ponies": "poni", "running": "run", "relational": "relat", "hopping": "hop", "happy": "happi", "generalizations": "gener", "agreed": "agre", "controlling": "control", "sky": "sky", "adjustment": "adjust"}
    assert {w: porter.stem(w) for w in words} == words


def test_metric_columns(spark):
    df = spark.createDataFrame([("SELECT 1;", "select  1"), ("a", "b"), (None, None)], "p string, t string")
    got = df.select(metrics.exact_match(F.col("p"), F.col("t")), metrics.bleu_score(F.col("p"), F.col("t")), metrics.rouge_scores(F.col("p"), F.col("t"))["rougeL"]).collect()
    assert got[0][0] == 1.0 and got[1][0] == 0.0 and got[2][0] == 1.0
    assert got[0][2] == 1.0
    with pytest.raises(ValueError):
        metrics.metric("execution_accuracy")


def test_chunks(spark):
    df = spark.createDataFrame([(1, [str(i) for i in range(10)]), (2, ["a"]), (3, [])], "id int, ids array<string>")
    got = sorted((r.id, r.chunk, r.ids) for r in tokens.chunked(df, "ids", 6, 3).collect())
    ten = [str(i) for i in range(10)]
    assert got == [(1, 0, ten[:6]), (1, 1, ten[3:9]), (1, 2, ten[6:]), (1, 3, ten[9:]), (2, 0, ["a"]), (3, 0, [])]
    assert sorted(r.id for r in tokens.chunked(df, "ids", 6, strategy="drop").collect()) == [2, 3]
    assert max(len(r.ids) for r in tokens.chunked(df, "ids", 6, strategy="truncate").collect()) == 6
    with pytest.raises(ValueError):
        tokens.chunked(df, "ids", 6, strategy="cut")


def test_record_text_layouts(spark):
    df = spark.createDataFrame([("q", "a")], "prompt string, completion string")
    assert df.select(tokens.record_text(df)).head()[0] == "q\na"
    out = tokens.with_text(df, F.lit("z")).head()
    assert tuple(out) == ("z", "")
    with pytest.raises(ValueError):
        tokens.record_text(df.drop("prompt"))


def test_token_stats_interpolate(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "n int")
    got = tokens.token_stats(df, F.col("n")).head()
    assert (got.n, got.min_tokens, got.max_tokens, got.mean_tokens, got.median_tokens, got.p90) == (10, 1, 10, 5.5, 5.5, 9.1)
    assert tokens.length_report(df, F.col("n"), 8).head().pct_over == 20.0
    assert tokens.length_report(df.limit(0), F.col("n"), 8).head().pct_over == 0.0
