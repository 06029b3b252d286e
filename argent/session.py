"""Where the library may write intermediate data.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``;
it is read from the session. Only when the session names none (local runs
and tests) is a folder created here and registered with
``SparkContext.setCheckpointDir``; a configured folder is never replaced.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from argent.errors import ETLError

_CONF = "spark.checkpoint.dir"
_fallback: dict[int, str] = {}


def _configured(spark: SparkSession) -> str | None:
    try:
        d = spark.conf.get(_CONF, None)
    except Exception:
        d = None
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext access (e.g. remote sessions)
        return None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return False


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a fresh temp folder, set as
    the checkpoint dir, only when the session names none and runs in local
    mode (on a cluster, executors could not see a driver-local folder)."""
    d = _configured(spark)
    if not d:
        if not _is_local(spark):
            raise ETLError(
                "spark.checkpoint.dir is not set: name a folder on shared storage "
                "(HDFS, object store) for intermediate and staged data"
            )
        key = id(spark)
        d = _fallback.get(key)
        if d is None:
            d = tempfile.mkdtemp(prefix="argent-ckpt-")
            _fallback[key] = d
            try:
                spark.sparkContext.setCheckpointDir(d)
            except Exception:
                pass
    return d.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder (nothing is created)."""
    return f"{shared_dir(spark)}/argent/{label}-{uuid.uuid4().hex}"
