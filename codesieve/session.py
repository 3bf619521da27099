"""Session helpers: a tuned builder for our own runs, and durable cut points for long lineages."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "codesieve", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the transforms are designed for; ``conf`` overrides (``__`` means ``.``)."""
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Text is expanded to lines in memory: keep a scan task's share of it small.
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one the cluster names in ``spark.checkpoint.dir``, checkpoints included.

    Only a local session without that setting (a test) gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="codesieve-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut ``df``'s lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
