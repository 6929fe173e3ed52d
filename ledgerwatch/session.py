"""Session settings, and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerwatch", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC timestamps; anything else is left to the cluster or ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    # Sessions of one account are merged before they are shuffled, so a busy account is small by then.
    builder = builder.config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # Files of checkpoints that no frame refers to any more are removed.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local master without that setting (tests) gets a new temporary folder; a cluster
    without it is an error, because a folder of one machine is lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="ledgerwatch-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder: they are computed once, and later reads survive lost executors."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(frame.sparkSession))
    return frame.checkpoint()
