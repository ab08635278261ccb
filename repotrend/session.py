"""Session construction and the shared work folder.

The pipeline's results depend on the session time zone (``to_date`` and
``hour`` of an instant), so it is pinned to UTC.  ANSI mode stays on; the
operators use ``try_*`` functions where malformed input must become NULL.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session running the pipeline needs, whatever the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "repotrend",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the pipeline's required settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so spark-submit's values apply (AQE then sizes
    shuffle partitions from the data).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for the functions that run there; they need no copy of their own."""
    here = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="repotrend-ship-"), "repotrend"), "zip", os.path.dirname(here), os.path.basename(here))
    spark.sparkContext.addPyFile(made)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Where neither is set, a session that runs in one
    process gets a private folder; on a cluster that is an error, as its
    machines would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", "")
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="repotrend-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder for written tables, below the shared checkpoint dir.

    Nothing here removes it: what is in it may be read lazily for as long as
    the caller likes.  The folder's owner clears it with the checkpoint dir.
    """
    leaf = name or uuid.uuid4().hex[:12]
    return f"{checkpoint_dir(spark)}/repotrend/{leaf}"
