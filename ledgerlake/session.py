"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library expects; applied only when building a session
# ourselves (tests, bench). A cluster session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Fixed value: codec of written tables.  Hashes in hex are half the bytes with it, and stay
#: whole with Parquet's default.
COMPRESSION = "zstd"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in spark.checkpoint.dir.

    Only a local session that names none (tests) gets a temporary one; elsewhere executors
    would write to their own disks, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlake-checkpoints-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir, for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application; how many there were.

    For callers that are done with all results read from them.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release_scratch(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for exchanges that are not to be merged."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df, name: str):
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, but computes the plan once and
    stores it columnar (a reliable RDD checkpoint recomputes the plan to write
    it).  The folder is on the cluster's shared storage, so a lost executor
    never loses the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlake`` importable in the Python workers (once per application).

    Operators that run Python on executors (the ledger fold) pickle functions by
    reference to this package; ``addPyFile`` distributes a zip of it to every
    executor, whatever directory the driver runs from.
    """
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-pkg-"), "ledgerlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)
