from pairloom.operators import gate, pipeline


def test_pairs_through_all_stages(spark):
    users = spark.createDataFrame([(1, "Ann"), (2, "Bo")], "id int, name string")
    rows = [
        (1, "What are the names of all users?", "SELECT name FROM users", {"target_sql": "SELECT name FROM users"}),
        (2, "How many users are there in all?", "SELECT count(nope) FROM users", None),
        (3, "Hi", "nope", {}),
        (4, "Which users have the id of seven?", "SELECT name FROM users WHERE id = 7", {"k": "v"}),
    ]
    pairs = spark.createDataFrame(rows, "id bigint, natural_language string, sql string, metadata map<string,string>")
    fix = lambda sql, r: sql.replace("nope", "*")
    out = pipeline.run(pairs, gate.Gate(spark, {"users": users}, timeout=60), fix, max_attempts=2)
    got = {r.id: (r.sql, dict(r.metadata)) for r in out.accepted().collect()}
    assert set(got) == {1, 2}
    assert got[2][0] == "SELECT count(*) FROM users"
    assert got[2][1]["original_sql"] == "SELECT count(nope) FROM users" and got[2][1]["was_repaired"] == "true"
    assert got[1][1]["was_repaired"] == "false" and "original_sql" not in got[1][1]
    bad = {r.id: dict(r.metadata) for r in out.rejected().collect()}
    assert set(bad) == {4} and bad[4]["gate_status"] == "empty_result" and bad[4]["k"] == "v"
    t = out.totals().head()
    assert (t.generated, t.passed_quality, t.passed_gate, t.repaired, t.rejected) == (4, 3, 2, 1, 2)
    none = pipeline.run(pairs.limit(0), gate.Gate(spark, {"users": users}))
    assert none.accepted().collect() == [] and none.totals().head().generated == 0
