"""Names, schemas and introspection of the layered tables."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Layers and device types.
LAYERS = ("bronze", "silver", "gold")
DEVICES = ("air-1", "msr-2", "smart-plug-v2", "ag-one", "zigbee2mqtt", "sensibo")


def sanitised(name: str) -> str:
    """Lower case, anything but letters and digits as one underscore each run, none at the ends; an empty name is an error."""
    out = re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")
    if not out:
        raise ValueError(f"no usable characters in {name!r}")
    return out


def device_table(layer: str, device: str) -> str:
    """Table of a known device in a layer; other devices and layers are errors."""
    if layer not in LAYERS:
        raise ValueError(f"layer is one of {LAYERS}")
    if device not in DEVICES:
        raise KeyError(f"unknown device {device}")
    return f"{layer}.{device.replace('-', '_')}"


def pipeline_table(layer: str, pipeline: str, dataset: str) -> str:
    """Table of a pipeline's dataset in silver or gold."""
    if layer not in ("silver", "gold"):
        raise ValueError("layer is silver or gold")
    return f"{layer}.{sanitised(pipeline)}_{sanitised(dataset)}"


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def reset_layers(spark: SparkSession) -> None:
    """Drop everything in the layers and start anew."""
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    create_layers(spark)


#: Property of a table that is being moved: where from.
MOVING = "moved_from"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _take_over(spark: SparkSession, old: str, new: str) -> None:
    """Hand the files of a table to another of the same schema, which is empty: a rename of the folder, or a copy where the store cannot rename."""
    jvm = spark._jvm
    here, there = (jvm.org.apache.hadoop.fs.Path(_described(spark, t)["Location"]) for t in (old, new))
    files = here.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(here):  # else an earlier run has got as far as this
        try:
            files.delete(there, True)  # it is empty, or holds a copy that broke off
            files.mkdirs(there.getParent())
            renamed = files.rename(here, there)
        except Py4JJavaError:  # the two folders are in different stores
            renamed = False
        if not renamed:
            spark.table(old).write.insertInto(new, overwrite=True)


def migrate_flat(spark: SparkSession) -> list[str]:
    """Move flat tables such as bronze_air_1 of the current database to bronze.air_1, unless that is there.

    No row is read: the new table has the schema, format and partitions of the old, whose folder becomes its own; a table outside the warehouse stays where
    it is and only its name moves. Views are left alone. A move that broke off goes on when the function is called again.
    """
    moved = []
    for t in spark.catalog.listTables():
        for layer in LAYERS:
            if t.name.startswith(f"{layer}_") and t.tableType in ("MANAGED", "EXTERNAL"):
                new = f"{layer}.{t.name[len(layer) + 1 :]}"
                if spark.catalog.tableExists(new):
                    if f"{MOVING}={t.name}" not in _described(spark, new).get("Table Properties", "").strip("[]").split(","):
                        continue
                else:
                    outside = f" LOCATION '{_described(spark, t.name)['Location']}'" if t.tableType == "EXTERNAL" else ""
                    spark.sql(f"CREATE TABLE {new} LIKE {t.name} TBLPROPERTIES ('{MOVING}'='{t.name}'){outside}")
                if t.tableType == "MANAGED":
                    _take_over(spark, t.name, new)
                spark.catalog.refreshTable(new)
                if any(c.isPartition for c in spark.catalog.listColumns(new)):
                    spark.catalog.recoverPartitions(new)
                spark.sql(f"DROP TABLE {t.name}")
                spark.sql(f"ALTER TABLE {new} UNSET TBLPROPERTIES IF EXISTS ('{MOVING}')")
                moved.append(new)
    return moved


def available(spark: SparkSession, layer: str) -> list[str]:
    """Names of a layer's tables, without temporary views; none where the layer is not there."""
    return sorted(t.name for t in spark.catalog.listTables(layer) if not t.isTemporary) if spark.catalog.databaseExists(layer) else []


def row_count(spark: SparkSession, table: str) -> int:
    """0 for a missing table."""
    return spark.table(table).count() if spark.catalog.tableExists(table) else 0


def column_names(spark: SparkSession, table: str) -> list[str]:
    """[] for a missing table."""
    return spark.table(table).columns if spark.catalog.tableExists(table) else []


def read_or_empty(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The table, or an empty frame where it is missing; every other error is raised."""
    return spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], schema)
