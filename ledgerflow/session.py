"""Session set-up and the shared scratch folder.

Scratch data (written tables, streaming checkpoints, landed test drops) always goes under the
folder the cluster names in ``spark.checkpoint.dir``: it is shared storage on a cluster. Only
on a local master with nothing configured (tests) a local folder is created and registered; a
cluster without the setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins (broadcast when a side is measured small,
# skew split) and coalesces small shuffle partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with their frames
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ledgerflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/ledgerflow/{label}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def session_time_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")


def ship_with_tasks(module_name: str) -> None:
    """Functions of ``module_name`` that run in Python workers (archive members, batch functions)
    are pickled by value, so executors need no installed copy of this package."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
