"""A session with the settings that the operators assume."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}
_OWN: list[str] = []


def session(app: str = "shotframe", master: str | None = None, **more: str) -> SparkSession:
    """more: further settings, with double underscores for dots."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder's name under spark.checkpoint.dir, which the driver and all executors see. Where that is unset, one in a
    temporary folder in local mode, and an error on a cluster."""
    top = spark.conf.get("spark.checkpoint.dir", "")
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="spark-shots-"))
        top = _OWN[0]
    return f"{top.rstrip('/')}/shots-{uuid.uuid4().hex}"
