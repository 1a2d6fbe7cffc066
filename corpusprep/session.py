"""Session helpers: building a local session for tests and bench, and lineage cuts.

Lineage is cut with reliable ``checkpoint()`` into the shared folder the cluster names
in ``spark.checkpoint.dir``.  A folder of our own is only set for a single-machine master without
one (tests, local runs); a cluster without the setting is an error, since a local folder is not
visible to its executors.  ``localCheckpoint`` is never used because an executor loss would
lose the checkpointed blocks.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session settings every job here assumes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "corpusprep") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSPREP_DRIVER_MEMORY", "16g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> str:
    """Sends this package to the executors as a zip file, for clusters where it is not installed; the functions
    that run in Python workers are pickled by module name and need it there.  Returns the file's path."""
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="corpusprep-ship-"), "corpusprep")
    path = shutil.make_archive(base, "zip", os.path.dirname(root), "corpusprep")
    spark.sparkContext.addPyFile(path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  When none is configured, a local master gets a temporary
    one (driver and executors share the machine); any other master must name a shared folder."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
