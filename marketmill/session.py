"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marketmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Where neither is set a local session makes a temporary folder; on a cluster that would be
    a folder of one machine, so it raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marketmill-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "part") -> DataFrame:
    """Write an intermediate that is read more than once, and read it back.

    It lands as Parquet in the shared folder, so it survives lost executors,
    keeps column pruning, and gives the planner its real size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles_dropped(operator: Callable) -> Callable:
    """The operator, whose first argument is a DataFrame, with the shuffle files of each job it runs removed when that job ends.

    Otherwise they lie on the executors until the driver collects its garbage, those of all intermediates at once.
    The session's setting is put back; a DataFrame that is executed again makes its files anew.
    """

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **kwargs):
        conf = df.sparkSession.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")
        try:
            return operator(df, *args, **kwargs)
        finally:
            conf.set(_CLEANUP, before)

    return run
