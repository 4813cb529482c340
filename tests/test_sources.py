import json

import pytest
from pyspark.sql import functions as F

from pairloom.sources import records


def test_seed_lines(spark, tmp_path):
    lines = ['{"natural_language": " q ", "sql": "SELECT 1", "category": "c", "schema": "s"}', "", "{broken", '{"natural_language": "", "sql": "x"}', "[1]", '{"natural_language": "r", "sql": " SELECT 2 ", "difficulty": "hard"}']
    path = tmp_path / "seeds.jsonl"
    path.write_text("\n".join(lines), encoding="utf-8")
    got = sorted((r.natural_language, r.sql, r.difficulty, r.category, dict(r.metadata)) for r in records.read_seeds(spark, str(path)).collect())
    assert got == [("q", "SELECT 1", "medium", "c", {"schema": "s"}), ("r", "SELECT 2", "hard", "", {})]
    with pytest.raises(FileNotFoundError):
        records.read_seeds(spark, str(tmp_path / "none.jsonl"))


def test_strict_lines_fail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert records.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a int").count() == 2
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a int").collect()


def test_formatted_lines(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"text": "a"}\n"b c"\n{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}\n{"x": 1}\n')
    assert sorted(r.text for r in records.read_formatted(spark, str(tmp_path / "f.jsonl")).collect()) == ["a", "b c", "q\nr"]
    (tmp_path / "g.jsonl").write_text('{"x": 1}\n')
    with pytest.raises(ValueError):
        records.read_formatted(spark, str(tmp_path / "g.jsonl"))


def test_reports(spark, tmp_path):
    folder = str(tmp_path / "reports")
    assert records.read_reports(spark, folder).collect() == []
    path = records.write_report({"model": "Ä", "n": 1}, folder, "My Model", "20240101")
    assert path.endswith("my-model_20240101.json")
    (tmp_path / "reports" / "bad.json").write_text("{nope")
    got = records.read_reports(spark, folder).collect()
    assert [r.filename for r in got] == ["my-model_20240101.json"] and json.loads(got[0].report)["model"] == "Ä"
    assert records.report_path(folder, "my-model_20240101.json").is_file()
    for bad in ("../x.json", "a/b.json", "x.txt"):
        with pytest.raises(ValueError):
            records.report_path(folder, bad)
    with pytest.raises(FileNotFoundError):
        records.report_path(folder, "none.json")


def test_split_and_acceptance_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "train", {"a": "b"}), (2, None, "test", {}), (3, "z", "train", None)], "id int, t string, split string, metadata map<string,string>")
    paths = records.write_splits(df.drop("metadata"), str(tmp_path / "s"))
    assert set(paths) == {"train", "test"}
    assert spark.read.json(paths["train"]).count() == 2
    out = records.write_accepted(df, F.col("id") < 2, str(tmp_path / "g"))
    assert spark.read.json(out["rejected"]).count() == 2 and "metadata" not in spark.read.json(out["rejected"]).columns
    assert records.write_accepted(df, F.lit(True), str(tmp_path / "h"))["rejected"] is None


def test_metric_table_appends(spark, tmp_path):
    df = spark.createDataFrame([("r", 1, "m", 0.5)], "run_id string, step int, metric string, value double")
    for _ in range(2):
        records.append_metrics(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_ddl_views(spark):
    made = records.register_ddl(spark, "-- x\nCREATE TABLE a_t (id INTEGER PRIMARY KEY, price DECIMAL(10, 2), note TEXT, FOREIGN KEY (id) REFERENCES b(id));\ncreate table b_t (d DATE);")
    assert made == ["a_t", "b_t"]
    assert spark.table("a_t").dtypes == [("id", "bigint"), ("price", "decimal(10,2)"), ("note", "string")]


def test_settings(tmp_path):
    defaults = {"n": 3, "llm": {"model": "m", "temperature": 0.0}}
    (tmp_path / "c.json").write_text('{"n": 5, "llm": {"model": "x"}, "other": 1}')
    assert records.read_settings(str(tmp_path / "c.json"), defaults) == {"n": 5, "llm": {"model": "x", "temperature": 0.0}, "extra": {"other": 1}}
    assert records.read_settings(str(tmp_path / "none.json"), defaults) == defaults
