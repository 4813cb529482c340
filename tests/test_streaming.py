import json
import os

from pairloom.streaming import live


def _stream(spark, tmp_path, schema, files):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, rows in enumerate(files):
        path = folder / f"{k}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (1_700_000_000 + k * 10,) * 2)  # files are taken in the order of their times
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def _run(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name).collect()


def test_dedup_within_watermark(spark, tmp_path):
    files = [[{"ts": "2024-01-01T00:00:00", "a": "x"}, {"ts": "2024-01-01T00:01:00", "a": "x"}], [{"ts": "2024-01-01T00:02:00", "a": "x"}, {"ts": "2024-01-01T00:02:00", "a": "y"}]]
    df = _stream(spark, tmp_path, "ts timestamp, a string", files)
    assert sorted(r.a for r in _run(spark, live.dedup_stream(df, ["a"], "ts"), "dedup_out")) == ["x", "y"]


def test_windowed_means_drop_late_rows(spark, tmp_path):
    files = [[{"ts": "2024-01-01T00:01:00", "k": "a", "v": 1.0}, {"ts": "2024-01-01T00:02:00", "k": "a", "v": 3.0}], [{"ts": "2024-01-01T01:00:00", "k": "a", "v": 9.0}], [{"ts": "2024-01-01T01:01:00", "k": "a", "v": 9.0}], [{"ts": "2024-01-01T00:03:00", "k": "a", "v": 100.0}, {"ts": "2024-01-01T02:00:00", "k": "a", "v": 1.0}]]
    df = _stream(spark, tmp_path, "ts timestamp, k string, v double", files)
    got = {r.window_start.hour: (r.n, r["mean"]) for r in _run(spark, live.windowed_means(df, "ts", ["k"], "v"), "means_out")}
    assert got[0] == (2, 2.0)


def test_overfitting_state(spark, tmp_path):
    row = lambda m, s, v: {"run_id": "r", "metric": m, "step": s, "value": v}
    files = [[row("train_loss", 1, 1.0)], [row("eval_loss", 2, 1.5)], [row("train_loss", 3, 1.45), row("eval_loss", 4, 1.5)]]
    df = _stream(spark, tmp_path, "run_id string, metric string, step bigint, value double", files)
    got = sorted((r.step, r.gap, r.flagged) for r in _run(spark, live.overfitting_stream(df), "overfit_out"))
    assert got == [(2, 0.5, True), (4, 0.05, False)]
