"""Session settings the library is designed for.

Nothing here is required: every operator works on any session.  The settings
make the large-cluster behaviour explicit (runtime re-planning, skew-join
splitting, small advisory partitions) and are applied only when this builder
creates the session.
"""
from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lanestride", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCRATCH: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a scratch folder serves a single machine (a ``local``
    master, as in tests); on a cluster that would be each executor's own disk,
    so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors of {master}")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _SCRATCH[app]


def stage_path(spark: SparkSession) -> str:
    """A new folder for staged rows, owned by this application: ``clear_stages`` deletes it, at exit at the latest."""
    app = spark.sparkContext.applicationId
    if app not in _STAGED:
        _STAGED[app] = []
        atexit.register(_clear_quietly, spark)
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    _STAGED[app].append(path)
    return path


def stage(rows: DataFrame) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    Used where several branches need the same expensive result: the lineage is
    cut, nothing is recomputed when an executor is lost, and each branch reads
    only the columns it uses.
    """
    path = stage_path(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clear_stages(spark: SparkSession) -> int:
    """Delete every folder this application has staged; call it when no frame built on them is used any more."""
    paths = _STAGED.get(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    done = len(paths)
    paths.clear()
    return done


def _clear_quietly(spark: SparkSession) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            clear_stages(spark)
    except Exception:  # noqa: BLE001  the session may have ended already
        pass
