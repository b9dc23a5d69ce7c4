"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK: dict[str, str] = {}


def workspace(spark: SparkSession, name: str) -> str:
    """A new path for a table that later stages read.

    On a cluster the base is the shared folder of ``spark.checkpoint.dir``, or the one that
    ``SparkContext.setCheckpointDir`` was given. Only where neither is set, as in tests on one
    machine, a temporary folder of this machine is used, which goes when the program ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _FALLBACK.setdefault(app, "")
        if not base:
            base = _FALLBACK[app] = tempfile.mkdtemp(prefix="tripmart-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
