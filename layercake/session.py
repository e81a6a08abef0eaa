"""Session and shared-folder helpers.

Library functions never change session settings; only :func:`local_session`
(used by tests and ``bench.py``) builds a configured session.  Intermediate and
published outputs of the registered queries go under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``), never under a machine-local
temporary folder, so a lost executor can always re-read them.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    app: str = "layercake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    task_retries: int = 0,
) -> SparkSession:
    """A local session for tests and benchmarks: AQE on, UI off, UTC.

    ``task_retries`` > 0 lets a failed task be retried, as on a cluster
    (local mode otherwise fails the job on the first task failure).
    """
    n = os.cpu_count() if cores == "*" else int(cores)
    master = f"local[{cores},{task_retries + 1}]" if task_retries else f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set in the cluster's configuration.  Only a local-mode session without
    one (a test) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor shares"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="layercake-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below :func:`shared_root` for one run of ``name``."""
    return f"{shared_root(spark)}/layercake/{name}-{uuid.uuid4().hex}"
