"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_OWN_DIRS: dict[str, str] = {}
_MARKED: set[str] = set()


def session_settings(environ: Mapping[str, str]) -> dict[str, str]:
    """The settings the operators count on (UTC, AQE with skew splitting), a bound on what may come to the driver, and sizes where the environment gives them; a cluster's own hold otherwise."""
    sized = {"spark.driver.memory": "TIDEMARK_DRIVER_MEMORY", "spark.sql.shuffle.partitions": "TIDEMARK_SHUFFLE_PARTITIONS", "spark.sql.files.maxPartitionBytes": "TIDEMARK_SCAN_BYTES"}
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.maxResultSize": environ.get("TIDEMARK_MAX_RESULT", "1g"),
        **{k: environ[v] for k, v in sized.items() if environ.get(v)},
    }


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    settings = session_settings(os.environ) | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder of the driver serves local masters only; a cluster
    without the setting is refused, since its executors couldn't read a driver's folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _OWN_DIRS[app]


def work_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder. It goes when the driver's JVM ends, or earlier by ``clean``."""
    path = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if path not in _MARKED:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _MARKED.add(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for what only this application reads."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Deletes everything under ``new_path``. Frames that read from there can't be evaluated any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _MARKED.discard(work_dir(spark))


def materialise(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Cuts lineage: writes ``df`` to the shared folder and reads it again, so that lost executors cost no recomputation.

    With ``partition``, a column of few values, a later filter on it reads only its files.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    schema = T.StructType([*(f for f in df.schema if f.name != partition), *(f for f in df.schema if f.name == partition)])
    return spark.read.schema(schema).parquet(path)
