"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session comes from the platform; nothing here overrides its
settings.  ``scratch_root`` follows ``spark.checkpoint.dir`` (a folder every
executor can reach) and only invents a local folder when the session has none,
which is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", app: str = "frostline", **extra: str) -> SparkSession:
    """A local[N] session with the settings our tests and bench assume."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**_LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="frostline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged files: a sibling of the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return base


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared scratch root for one run."""
    path = os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
