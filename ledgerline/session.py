"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (source timestamps are NTZ and
# only DT6 converts zones explicitly), adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast demotion).
#
# On a cluster, size shuffles for the data rather than the cores: set
# ``spark.sql.shuffle.partitions`` to about (largest shuffle bytes / 128 MiB)
# (e.g. 4000-20000 at 100 TB) and let AQE coalesce small stages toward the
# advisory size; ``spark.sql.files.maxPartitionBytes`` (128 MiB) keeps scan
# tasks memory-sized.  ``spark.checkpoint.dir`` must name a shared file
# system folder (HDFS / object store), never a machine-local one.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "ledgerline",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEM", "16g"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system (unset is an
    error there).  Only a single-machine ``local[...]`` run without the
    setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store): "
                               "checkpoints must survive the loss of any one machine")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")  # single-machine runs only
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, stem: str) -> str:
    """A new folder's name in the shared checkpoint folder; the folder goes when this program ends.

    For what several steps or a result still to be computed read: every machine
    sees it, and a task that runs again finds it.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:  # noqa: BLE001  the session may be gone already; the folder is left to the checkpoint folder's owner
        pass


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that no frame refers to any more.

    Spark's cleaner learns of them when the driver collects garbage, by itself
    every half hour; a job of many steps calls this between two of them, after
    dropping its own references, so that finished steps do not fill the disks.
    """
    gc.collect()
    spark._jvm.System.gc()
