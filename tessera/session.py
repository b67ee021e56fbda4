"""Session helpers.

Library code never builds its own session; it takes the caller's.  The
builder here is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import time
import uuid

from pyspark.sql import SparkSession


# Settings for the cluster run (~100 TB of input, ~1000 executors x 8 cores).
# Scans: 1 GB splits give ~100k scan tasks (~12 waves of 8k slots).  The
# mart reads 15 of its transaction columns and keeps a fraction of the rows
# by rule before its first shuffle, so ~10 TB or less is shuffled: 40k
# shuffle partitions put ~250 MB in each reduce task (sort spills beyond
# memory), and AQE coalesces smaller ones.  100k map x 40k reduce tasks
# makes many small shuffle blocks, so push-based shuffle merges them where
# the cluster's external shuffle service supports it.  Partitions 5x over the
# median and over 512 MB are split by skew join.  Static broadcast stays at
# the Spark default; dimensions are broadcast only through the size
# check in ``operators.bounded_broadcast``.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.shuffle.push.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of size-checked dimensions go when their frame does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: Names in the shared folder: the library's scratch, and the lease in each application's part of it.
SCRATCH, LEASE = "tessera", "_lease"
#: Seconds after which a living driver renews its lease.
LEASE_SECONDS = 600
_LEASES: dict[str, _Lease] = {}
_LOCK = threading.Lock()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tessera") -> SparkSession:
    """A local session tuned like the cluster one: AQE with skew-join splitting,
    UTC session time, UI off, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture costs several JVM round trips per Column
        # call; jobs here build wide expressions, so it is off.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and written intermediates.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set on a ``local[...]`` master -- a test or a laptop
    -- a fresh temporary folder is created and installed as the checkpoint
    dir; on a cluster a machine-local folder would not survive executor loss,
    so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) "
                               "reachable from every executor")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the application's part of the shared folder (never reused between runs).

    The application's part is leased: it goes when the driver's JVM ends, and ``sweep`` removes those whose
    application ended without that."""
    root = f"{shared_dir(spark)}/{SCRATCH}/{spark.sparkContext.applicationId}"
    with _LOCK:
        if root not in _LEASES:
            _LEASES[root] = _Lease(spark, root)
    return f"{root}/{purpose}/{uuid.uuid4().hex}"


class _Lease:
    """A file in the application's scratch folder that is written again every few minutes while the driver lives."""

    def __init__(self, spark: SparkSession, root: str):
        self._path, self._fs = _file_system(spark, f"{root}/{LEASE}")
        self._renew()
        # done by the file system when the JVM ends in order, also without spark.stop()
        self._fs.deleteOnExit(self._path.getParent())
        threading.Thread(target=self._keep, daemon=True, name="tessera-lease").start()

    def _renew(self) -> None:
        self._fs.create(self._path, True).close()

    def _keep(self) -> None:
        while True:
            time.sleep(LEASE_SECONDS)
            try:
                self._renew()
            except Exception:           # the JVM is gone, and the folder with it or left to a sweep
                return


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def sweep(spark: SparkSession, idle_hours: float = 24) -> list[str]:
    """Remove the scratch folders, under the parent of this session's shared folder, whose lease was not renewed for
    ``idle_hours``: their applications were killed.  Folders without a lease are not the library's and stay.
    Returns what was removed."""
    parent = os.path.dirname(shared_dir(spark))         # Spark adds a folder of its own to spark.checkpoint.dir
    leases, fs = _file_system(spark, f"{parent}/*/{SCRATCH}/*/{LEASE}")
    removed = []
    for lease in fs.globStatus(leases):
        if time.time() - lease.getModificationTime() / 1000 > idle_hours * 3600:
            folder = lease.getPath().getParent()
            fs.delete(folder, True)
            removed.append(folder.toString())
    return removed
