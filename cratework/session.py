"""Session helpers: builder, reliable checkpoints and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "cratework", **conf: str) -> SparkSession:
    """A session with the settings that the engine relies on; ``conf`` overrides them (``_`` stands for ``.``)."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    base.update({k.replace("_", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in base.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the cluster's ``spark.checkpoint.dir``; only where that is unset on a single machine (a test) a temporary
    folder is taken. On a cluster without it, RuntimeError is raised.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cratework-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder.

    A checkpointed frame keeps the size that the optimizer estimated for its plan. In loops that join a frame with
    itself these estimates multiply into numbers of millions of digits; so the frame is rebuilt on the checkpointed
    rows without them, and sizes are measured at run time.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = shared_dir(spark)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    done = df.checkpoint(eager=True)
    rows = done._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, done._jdf.schema(), False), spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
