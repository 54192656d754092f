"""Spark session and run-wide settings.

One place decides the settings every job relies on: UTC session time,
ANSI mode on (division by zero raises, so operators use ``try_divide``),
adaptive execution with skew-join splitting, and Arrow for the grouped-map
kernels.  On a cluster the builder is called without ``master`` and the
cluster's own values win for anything set outside this module.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library assumes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # dynamic partition overwrite = replace only the partitions a write touches
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "costweave", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    # Spark runs a task per core; numpy in a task must not start threads for all of them
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, which need not have the
    repository on their path (a job submitted with ``--py-files`` needs no call)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        here = os.path.dirname(os.path.abspath(__file__))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="costweave-zip-"), "costweave_pkg"), "zip",
                                         os.path.dirname(here), os.path.basename(here)))


def local_spark(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, small shuffle width."""
    return get_spark(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                     extra={"spark.driver.memory": os.environ.get("COSTWEAVE_DRIVER_MEM", "8g")})


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder used to cut lineage.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is
    read from the session.  Only a local-mode session (tests, bench) with
    no setting gets a fresh folder under the temp directory, because a
    machine-local path is useless once executors live on other hosts.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="costweave-ckpt-")
    sc.setCheckpointDir(path)
    return path


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the shared checkpoint folder, remembered for
    ``clean_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete every intermediate this application wrote; returns how many there were.  For
    the end of a job: frames that still read one of them fail afterwards."""
    sc = spark.sparkContext
    paths = _scratch.pop(sc.applicationId, [])
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def cut_lineage(df):
    """Write an intermediate as a Parquet table under the session's shared
    checkpoint folder and continue from the written table.

    Used where a small intermediate (e.g. day x series sums) feeds several
    branches of a plan: the branches then read the written result instead of
    re-running the scan and joins, and a lost executor costs a re-read, not
    a replay of the lineage.  A columnar table (rather than an RDD
    checkpoint of serialized rows) is faster to write and lets later reads
    prune columns.  Never a local (executor-memory) checkpoint."""
    path = scratch_path(df.sparkSession, "tables")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
