"""Session construction and the folder that driver and executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = 1024


def build(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and ANSI on; further settings by keyword."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset, a local one, for a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = getattr(spark.sparkContext, "_tidegrid_dir", None)
    if path is None:
        path = "file://" + tempfile.mkdtemp(prefix="tidegrid-")
        spark.sparkContext._tidegrid_dir = path
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: it cuts the lineage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidegrid_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``written`` stored for ``df``, once nothing reads it any more."""
    path = getattr(df, "_tidegrid_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def workers_see(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, and give them batches that long texts don't swell."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [root, *known] if x)
