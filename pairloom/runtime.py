"""Session, shared storage and naming helpers that every operator uses."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "pairloom", cpus: str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once for an application; they may lack it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pairloom-code-")
    archive = os.path.join(folder, "pairloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's setting, or one of our own where it is unset and all runs on one machine."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='pairloom-')}"
        spark.conf.set(CHECKPOINT_KEY, folder)
        spark.sparkContext.setCheckpointDir(folder)
        atexit.register(shutil.rmtree, urlparse(folder).path, ignore_errors=True)
    return folder


def materialize(df: DataFrame, name: str, dictionary: bool = True) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage with a copy that outlives any executor, and lets several readers prune columns of it.
    The tables of a session go when release() is called or the process ends. dictionary=False suits columns of hashes.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.option("compression", "zstd").option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes as materialize() says."""
    ship(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_release_all)
    _written.append((spark, path))
    return path


def release(spark: SparkSession) -> int:
    """Delete every table that materialize() wrote in this session; DataFrames built on them can't be read afterwards."""
    mine = [path for owner, path in _written if owner is spark]
    for path in mine:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _written[:] = [x for x in _written if x[0] is not spark]
    return len(mine)


def _release_all() -> None:
    """At the end of the process: through Hadoop's file system where the session still runs, else what is on this machine."""
    for spark, path in _written:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session was stopped
            if urlparse(path).scheme in ("", "file"):
                shutil.rmtree(urlparse(path).path, ignore_errors=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Columns of a table for work that is heavy for each row: a scan of fewer parts than there are cores is spread over them.

    A table of many files is left as it is; the number of parts is known from the plan, without a job.
    """
    scan = read_table(spark, sf_dir, name).select(*[col(c) for c in columns])
    cores = spark.sparkContext.defaultParallelism
    return scan if scan._jdf.queryExecution().toRdd().getNumPartitions() >= cores else scan.repartition(cores)


def col(name: str) -> Column:
    """A column by its plain name, whatever dots or blanks the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, so that a helper column never clashes with one of the caller's."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
