"""Readers and writers of JSON lines, reports and configurations."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.responses import is_json
from pairloom.functions.text import strip
from pairloom.runtime import col

KNOWN = ("natural_language", "sql", "difficulty", "category")


def parsed_seeds(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Seed pairs from JSON lines: blank and malformed lines and pairs with an empty text are left out, both texts are
    stripped, difficulty defaults to medium and category to empty, what else a line holds goes to metadata as text."""
    text = strip(col(line_col))
    fields = F.from_json(text, "map<string,string>")
    valid = lines.filter((F.coalesce(text, F.lit("")) != "") & text.startswith("{") & is_json(text))
    made = valid.select(*[col(k) for k in keep], fields.alias("f")).filter("f is not null")
    out = made.select(
        *[col(k) for k in keep],
        strip(F.col("f")["natural_language"]).alias("natural_language"),
        strip(F.col("f")["sql"]).alias("sql"),
        F.coalesce(F.col("f")["difficulty"], F.lit("medium")).alias("difficulty"),
        F.coalesce(F.col("f")["category"], F.lit("")).alias("category"),
        F.map_filter("f", lambda k, _: ~k.isin(*KNOWN)).alias("metadata"),
    )
    return out.filter("coalesce(natural_language, '') <> '' and coalesce(sql, '') <> ''")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return parsed_seeds(spark.read.text(path))


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines of a known schema; blank lines are skipped, a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """(text) of lines that hold {"text"}, {"messages"} or a bare JSON string; other lines are skipped, none at all is an error."""
    raw = spark.read.text(path).select(strip(F.col("value")).alias("v")).filter("v <> ''")
    messages = F.from_json(F.get_json_object("v", "$.messages"), "array<struct<role:string,content:string>>")
    bare = F.when(F.col("v").startswith('"'), F.from_json(F.concat(F.lit('{"s":'), F.col("v"), F.lit("}")), "s string")["s"])
    text = F.coalesce(F.get_json_object("v", "$.text"), F.array_join(F.transform(messages, lambda m: m["content"]), "\n"), bare)
    out = raw.select(text.alias("text")).filter("text is not null")
    if out.isEmpty():
        raise ValueError(f"no usable rows in {path}")
    return out


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, report) of the *.json files of a folder that hold JSON objects, by file name; empty without the folder."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], "filename string, report string")
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json")
    named = files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("filename"), strip(F.col("value")).alias("report"))
    return named.filter(F.col("report").startswith("{") & is_json(F.col("report"))).orderBy("filename")


def report_path(folder: str, name: str) -> Path:
    """The file of a report's name within a folder; a name that leaves the folder or isn't JSON is refused."""
    if not name.endswith(".json") or "/" in name or "\\" in name or ".." in name:
        raise ValueError("invalid report name")
    path = (Path(folder) / name).resolve()
    if path.parent != Path(folder).resolve():
        raise ValueError("invalid report name")
    if not path.is_file():
        raise FileNotFoundError(name)
    return path


def write_report(report: dict, folder: str, slug: str, stamp: str, spark: SparkSession | None = None) -> str:
    """Write a report as <slug>_<stamp>.json; returns the path. With a session, to any file system that Spark knows; else
    to this machine's."""
    name = re.sub("[^a-z0-9]+", "-", slug.lower()).strip("-") or "model"
    path = f"{folder}/{name}_{stamp}.json"
    text = json.dumps(report, ensure_ascii=False, indent=2)
    if spark is None:
        os.makedirs(folder, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")
        return path
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return path


def write_splits(df: DataFrame, folder: str, split_col: str = "split", single_file: bool = False) -> dict[str, str]:
    """Write each split's rows as JSON lines into <folder>/<split_col>=<name>; returns the folders by name.

    single_file gives one file to a split: a split goes to one task, different splits to different ones. The names are those
    of the folders written, so the rows are computed once; a null split is named by Hive's default.
    """
    out = df.repartition(col(split_col)) if single_file else df
    out.write.mode("overwrite").partitionBy(split_col).option("ignoreNullFields", "false").json(folder)
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = [f.getPath().getName().split("=", 1)[1] for f in found if "=" in f.getPath().getName()]
    return {n: f"{folder}/{split_col}={n}" for n in names}


def write_accepted(df: DataFrame, accepted: Column, folder: str) -> dict[str, str | None]:
    """Write accepted and rejected rows as JSON lines without null fields and empty metadata; an empty side gives no path."""
    if "metadata" in df.columns:
        df = df.withColumn("metadata", F.when(F.size("metadata") > 0, F.col("metadata")))
    out: dict[str, str | None] = {}
    for name, keep in (("accepted", F.coalesce(accepted, F.lit(False))), ("rejected", ~F.coalesce(accepted, F.lit(False)))):
        part = df.filter(keep)
        if part.isEmpty():
            out[name] = None
            continue
        out[name] = f"{folder}/{name}"
        part.write.mode("overwrite").option("ignoreNullFields", "true").json(out[name])
    return out


def append_metrics(df: DataFrame, path: str) -> None:
    """Append (run_id, step, metric, value) rows to a metric table."""
    df.select("run_id", "step", "metric", "value").write.mode("append").parquet(path)


def register_ddl(spark: SparkSession, ddl: str) -> list[str]:
    """Empty temporary views for the tables of a DDL script; returns their names. Constraints are not enforced."""
    kinds = {"integer": "bigint", "int": "int", "text": "string", "datetime": "timestamp", "date": "date", "real": "double", "json": "string", "boolean": "boolean"}
    made = []
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", "", ddl, flags=re.S)
    for name, body in re.findall(r"create\s+table\s+(?:if\s+not\s+exists\s+)?[\"`\[]?(\w+)[\"`\]]?\s*\((.*?)\)\s*(?:;|$)", bare, flags=re.I | re.S):
        fields = []
        for part in re.split(r",(?![^(]*\))", body):
            m = re.match(r"\s*[\"`\[]?(\w+)[\"`\]]?\s+(\w+)\s*(\([\d\s,]+\))?", part)
            if not m or m[1].lower() in ("primary", "foreign", "unique", "check", "constraint"):
                continue
            kind = m[2].lower()
            fields.append(f"`{m[1]}` " + (f"decimal{m[3] or '(10,2)'}" if kind in ("decimal", "numeric") else "string" if kind in ("varchar", "char") else kinds.get(kind, "string")))
        spark.createDataFrame([], ", ".join(fields)).createOrReplaceTempView(name)
        made.append(name)
    return made


def read_settings(path: str, defaults: dict) -> dict:
    """JSON or, where a YAML parser is installed, YAML settings over nested defaults; unknown keys go to extra, an unreadable
    file gives the defaults."""
    try:
        text = Path(path).read_text(encoding="utf-8")
        given = _yaml(text) if path.endswith((".yaml", ".yml")) else json.loads(text)
    except (OSError, ValueError):
        given = {}
    return _over(defaults, given if isinstance(given, dict) else {})


def _yaml(text: str) -> object:
    try:
        import yaml
    except ImportError as e:
        raise ValueError("no YAML parser") from e
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ValueError("no YAML") from e


def _over(defaults: dict, given: dict) -> dict:
    out = {k: _over(v, given.get(k) or {}) if isinstance(v, dict) else given.get(k, v) for k, v in defaults.items()}
    extra = {k: v for k, v in given.items() if k not in defaults}
    return out | ({"extra": extra} if extra else {})


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
