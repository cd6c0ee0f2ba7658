"""Session settings, and the shared folder for tables written between stages."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(app_name: str = "gistmill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package was tuned with; a cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="gistmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
