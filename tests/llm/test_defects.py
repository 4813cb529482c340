import random

import pytest

from pairloom.llm import defects as D

ASKED = "Show the printed label of ferry bins whose lead depot is Aldan, Brevik or Corlan and a net cost from 1200 to 3400"
SOUND = "SELECT printed_label FROM ferry_bins WHERE lead_depot IN ('Aldan', 'Brevik', 'Corlan') AND net_cost BETWEEN 1200 AND 3400;"


@pytest.mark.parametrize("answer", [None, "", "  \t\n", "​", "\xa0", "```\n\n```", "```sql\n```", "/* */", "--", "-- TODO", "N/A", "null", "None", "{}", '""', ";", " ; ", "(empty)", "-"])
def test_empty(answer):
    assert D.defect(ASKED, answer) == "empty_answer"


@pytest.mark.parametrize(
    "answer",
    [
        "I'm sorry, but I can't help with that: it goes against my guidelines.",
        "I’d rather not generate this statement since the schema has no rated_margin.",
        '{"error": "declined", "detail": "I have no access to marina_workorders"}',
        "/* Request declined: the request is unclear */",
        "```\nRefused: the schema has no gross_balance\n```",
        "-- I can't answer this, I have no access to ferry_bins",
        "SELECT 'Sorry, I cannot assist, ferry bins looks private' AS message;",
        "As an AI assistant I am not able to produce SQL here.",
    ],
)
def test_refusals(answer):
    assert D.defect(ASKED, answer) == "refusal"


OPENINGS = ["It would not be appropriate for me to answer", "It wouldn't be appropriate for me to answer", "It isn't appropriate for me to answer", "It would be inappropriate to answer", "I must pass on this one", "No query can be given"]
REASONS = ["the schema has no rated_quota for Aldan", "Aldan may be a person", "the request about Aldan is unclear", "ferry bins looks private"]


@pytest.mark.parametrize("wrap", ["{}.", "-- {}", "```\n{}\n```", "/* {} */", "SELECT '{}' AS message;"])
@pytest.mark.parametrize("opening", OPENINGS)
@pytest.mark.parametrize("reason", REASONS)
def test_refusals_by_opening_and_reason(opening, reason, wrap):
    said = f"{opening}: {reason}"
    assert D.defect(ASKED, wrap.format(said.replace("'", "''") if wrap.startswith("SELECT") else said)) == "refusal"


@pytest.mark.parametrize("wrap", ["{}", "SQL: {}", "Question: {}", "```\n{}\n```", "-- {}", "SELECT '{}' AS answer"])
def test_copies(wrap):
    assert D.defect(ASKED, wrap.format(ASKED)) == "copied_question"
    assert D.defect(ASKED, wrap.format(ASKED.lower())) == "copied_question"


@pytest.mark.parametrize("wrap", ["{}", "SQL: {}", "Question: {}", "```\n{}\n```", "-- {}", "SELECT '{}' AS answer"])
@pytest.mark.parametrize("asked", ["Revenue?", "Total sales", "List all depots", "列出净成本超过一千的所有渡轮箱子", "純費用が千を超える箱を表示してください", "Show 渡轮箱子"])
def test_copies_of_short_and_unblanked_questions(asked, wrap):
    assert D.defect(asked, wrap.format(asked)) == "copied_question"
    assert D.defect(asked, SOUND) is None and D.defect(asked, "SELECT revenue FROM depots WHERE total = 3") is None
    assert D.defect(asked, "db.ferry_bins.find({lead_depot: 1})") == "wrong_language" and D.defect(asked, "从 ferry_bins 表中取出 lead_depot 为 Aldan 的记录。") == "wrong_language"


@pytest.mark.parametrize(
    "answer",
    [
        "Nimm aus ferry_bins alle Zeilen, in denen lead_depot Aldan oder Brevik lautet.", "SÉLECTIONNER printed_label DEPUIS ferry_bins OÙ net_cost < 17795;",
        "db.ferry_bins.find({lead_depot: {$in: ['Aldan']}}, {printed_label: 1})", "ferry_bins[(ferry_bins.net_cost > 49859)].printed_label",
        "从 ferry_bins 表中取出 lead_depot 为 Aldan 的记录。", "Z tabeli ferry_bins wybierz wiersze, gdzie lead_depot to Aldan albo Brevik.",
    ],
)
def test_other_languages(answer):
    assert D.defect(ASKED, answer) == "wrong_language"


@pytest.mark.parametrize(
    "answer",
    [
        "SELECT printed_label FROM ferry_bins WHERE lead_depot IN ('Aldan', 'Bre", "SELECT printed_label FROM ferry_bins WHERE net_cost BETWEEN 1200 AND",
        "SELECT printed_label FROM ferry_bins WHERE net_cost BETWEEN 1200", "SELECT printed_label,", "SELECT printed_label", "UPDATE ferry_bins SET", "INSERT INTO ferry_bins (a, b)",
        "SELECT printed_label FROM ferry_bins WHERE lead_depot IN [cut]", "SELECT printed_label, COUNT(*) FROM...", "```sql\nSELECT a FROM ferry_bins WHERE lead_depot =\n```",
        "SELECT a.x, b.y FROM p a JOIN q b ON a.id = b.", "SELECT a, COUNT(*) FROM t WHERE x > 1 GROUP BY", "WITH s AS (SELECT a FROM t WHERE x = 1)", "SELECT a FROM t WHERE b = 3 AND lot_code",
        "SELECT a FROM t WHERE lead_depot IN ('Aldan', 'Brevik' -- (continued", "SELECT a FROM t /* more",
    ],
)
def test_truncated(answer):
    assert D.defect(ASKED, answer) == "truncated"


@pytest.mark.parametrize(
    "answer",
    [
        SOUND, SOUND[:-1], SOUND.lower(), f"```sql\n{SOUND}\n```", f"`{SOUND}`", f"({SOUND})", f"-- ferry_bins check\n{SOUND}", f"/* draft */ {SOUND}", f"-- ferry_bins check {SOUND}",
        SOUND.replace("'", '"'), SOUND.replace("'", "`"), SOUND.replace(" ", "  "), "SELECT a FROM t WHERE b LIKE 'Aldan...%'", "SELECT a FROM t WHERE c = 'I cannot open Aldan'",
        "SELECT a FROM t WHERE c NOT LIKE '%sorry Aldan%';", "DELETE FROM t WHERE a <> 'x-1' AND b >= '2023-08-14' AND c BETWEEN 1 AND 2", "SELECT a, COUNT(*) FROM t GROUP BY a HAVING COUNT(*) > 24 ORDER BY 1",
        "SELECT a FROM t ORDER BY a DESC LIMIT 5", "SELECT a FROM t WHERE x > (SELECT AVG(x) FROM t WHERE b = 'it''s')", "WITH s AS (SELECT a FROM t) SELECT a FROM s WHERE a > 3",
        "INSERT INTO t (a, b) VALUES ('x', 1), ('y', 2)", "UPDATE t SET a = 'x' WHERE b IN ('q')", "SELECT a, RANK() OVER (PARTITION BY b ORDER BY c DESC) AS pos FROM t",
    ],
)
def test_sound(answer):
    assert D.defect(ASKED, answer) is None
    assert D.defect(None, answer) is None


def test_suffix_automaton_equals_a_plain_search():
    rng = random.Random(7)
    for _ in range(200):
        prompt = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        answer = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        runs = {tuple(prompt[i:j]) for i in range(len(prompt)) for j in range(i + 3, len(prompt) + 1)}
        hit = {k for i in range(len(answer)) for j in range(i + 3, len(answer) + 1) if tuple(answer[i:j]) in runs for k in range(i, j)}
        assert D.SuffixAutomaton(prompt).covered(answer, 3) == len(hit)


def test_table_with_nulls_repeats_and_long_texts(spark):
    rows = [(1, ASKED, SOUND), (1, ASKED, SOUND), (2, None, None), (None, ASKED, "N/A"), (3, ASKED, SOUND * 3000), (4, "x " * 50_000, "x " * 50_000), (5, ASKED, "( " * 20_000)]
    df = spark.createDataFrame(rows, "id bigint, prompt string, answer string")
    got = sorted((r.id or 0, r.defect_type) for r in D.flagged(df, "id", "prompt", "answer").collect())
    assert got[:2] == [(0, "empty_answer"), (2, "empty_answer")] and (4, "copied_question") in got
    assert D.flagged(df.limit(0), "id", "prompt", "answer").collect() == []
