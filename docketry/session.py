"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "docketry", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    The shuffle partition number is left to adaptive execution on a cluster:
    start high and let it coalesce.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites of columns cost more than columns
    )
    if master:
        b = b.master(master)
    for key, value in conf.items():
        b = b.config(key, value)
    return b.getOrCreate()


@cache
def _local_root() -> str:
    """Folder of a local session, removed when the process ends."""
    root = tempfile.mkdtemp(prefix="docketry-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared checkpoint folder of the session.

    Only a local master may fall back to a machine-local folder; on a cluster
    executors would each see their own disk, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
