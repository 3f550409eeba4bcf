"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the cluster's shared folder.

    A machine-local folder is used only where that is unset and Spark runs in
    local mode, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="envlake-")
    return f"{base.rstrip('/')}/envlake/{label}-{uuid.uuid4().hex}"
