"""Session settings and the shared scratch location.

Intermediate and published outputs of the registered queries and of the
benchmark go under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder, so a
lost executor or a driver restart finds them again.  Only a local session
(tests, laptop) that has no checkpoint folder gets one under the system
temp directory.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings that matter at scale; the tests use the same ones on local[*].
#  * AQE re-plans from real shuffle sizes: it coalesces the many small
#    post-aggregation partitions and splits skewed ones.
#  * 128 MB input splits keep one parse task's input and output bounded.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.files.openCostInBytes": str(1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


# Extra settings for a cluster session (not applied to local ones).
#  * Exact distinct counts and group-bys over a 100 TB table shuffle up to
#    terabytes of per-task-distinct keys; 200 reduce partitions would make
#    each one several GB.  AQE starts from this many and coalesces small
#    shuffles (a handful of weekday or status groups) down to a few tasks.
#  * FAIR scheduling shares executors between the analyses when they are
#    submitted as concurrent jobs (``run_analyses(parallel=...)``).
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}
CLUSTER_STATIC_CONF = {"spark.scheduler.mode": "FAIR"}


def get_session(
    master: str | None = None,
    app_name: str = "logstrata",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Builder with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is not None and master.startswith("local"):
        settings.setdefault("spark.ui.enabled", "false")
        settings.setdefault("spark.driver.memory", "8g")
    else:
        settings.update(CLUSTER_STATIC_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if not _is_local(spark):  # runtime settings: decided on the real master
        for key, value in CLUSTER_CONF.items():
            if key not in (conf or {}):
                spark.conf.set(key, value)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None) or ""
    if not master:
        try:
            master = spark.sparkContext.master
        except Exception:  # Spark Connect has no SparkContext
            master = ""
    return master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, read from the session.

    A local session without one gets a fresh folder (and it is registered
    as the checkpoint folder, so ``DataFrame.checkpoint`` works too).  A
    cluster session without one is a configuration error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not _is_local(spark) and configured.startswith(("/", "file:")):
            warnings.warn(f"spark.checkpoint.dir is {configured}: it must be a folder that all machines of the cluster share", stacklevel=2)
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
    except Exception:
        sc, current = None, None
    if current:
        # setCheckpointDir made a per-application sub-folder of the shared root.
        return current.rstrip("/")
    if _is_local(spark):
        root = os.path.join(tempfile.mkdtemp(prefix="logstrata-"), "checkpoints")
        if sc is not None:
            sc.setCheckpointDir(root)
            return sc.getCheckpointDir().rstrip("/")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # some sessions reject core settings at runtime
            pass
        return root
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS, object store) "
        "so outputs survive executor loss"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/logstrata/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in ``path``, on any file system Spark can reach; none if it does not exist."""
    files, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove an output this library wrote, such as a :func:`scratch_path` no longer needed."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written aside and renamed, so a reader finds all of it or none."""
    files, target = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_aside-{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(aside, target):
        files.delete(aside, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if it is not there (any more)."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    try:
        stream = files.open(target)
    except Py4JJavaError as gone:
        if "FileNotFoundException" in str(gone.java_exception.getClass()):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since ``path`` was last written, by the clock of the file system."""
    files, target = _file_system(spark, path)
    return time.time() - files.getFileStatus(target).getModificationTime() / 1000
