"""Session settings, checkpoints and size-checked broadcasts."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and has at most this many rows.
BROADCAST_ROWS = 50_000


def build_session(app: str = "worktally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; cluster settings given outside win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Checkpoints nobody can read any more are removed from the shared folder.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


class NoSharedFolder(RuntimeError):
    """A cluster without a shared folder for checkpoints."""


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir; a folder of our own only where all runs in one process.

    On a cluster a machine-local folder would be lost with its machine, so a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="worktally-checkpoint-")
    sc.setCheckpointDir(folder)


def tidy(spark: SparkSession) -> None:
    """Let go of what is no longer referred to: checkpoints of earlier rounds, their files and the memory of their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so that later jobs read it and a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``max_rows`` rows, else a plain side of a shuffled join."""
    kept = cut(df)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, for clusters on which it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_worktally_shipped", False):
        return
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parent
    made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='worktally-code-')}/worktally", "zip", root.parent, root.name)
    sc.addPyFile(made)
    sc._worktally_shipped = True
