"""A session with the settings that the operators expect, and the folder that its machines share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "sensorframe", **conf: object) -> SparkSession:
    """UTC, ANSI and adaptive execution; more settings as keywords with __ for dots."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), str(v))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, one beside the warehouse serves a session of one machine; on a cluster that is an error, as
    executors would write to disks of their own.
    """
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
