"""What the operators of this subpackage share: tables, row hashes, gapless ranks, spread joins and intermediate tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_dir

#: Rows of a slice that one task ranks, about.
ROWS_A_SLICE = 1_000_000
#: Low bits of ``monotonically_increasing_id``: the place of a row in its partition.
PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It cuts lineage, survives the loss of executors and is columnar and compressed. The folder
    is unique to the call. Tables that rounds replace are discarded as they go; those that a result reads last as long as it does, and
    whoever owns the shared folder clears it.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete what :func:`materialise` has written, once nothing reads it any more; other frames are left alone."""
    for df in tables:
        if path := getattr(df, "_folder", None) if df is not None else None:
            jvm = df.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns c0, c1... and their names by the old ones, so that no column clashes with one an operator makes."""
    own = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*own.values()), own


def with_rows(docs: DataFrame, stored: bool) -> DataFrame:
    """The frame with ``_row``, a number for every row, repeated rows too.

    The number is the partition and the place in it. It has to be the same whenever the frame is computed: where ``stored`` says
    that the frame reads files as they are, it is; any other frame is written first.
    """
    return (docs if stored else materialise(docs, "rows")).withColumn("_row", F.monotonically_increasing_id())


def width(spark: SparkSession) -> int:
    """The number of partitions that the session's owner has set for shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the identifier as text, modulo ``mod``; a null identifier counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % mod


def uniform(*cols: Column, seed: int) -> Column:
    """A number in [0, 1) that depends only on the columns and the seed, so a lost task draws it again."""
    bits = F.xxhash64(F.lit(seed), *cols, F.lit(seed * 31 + 7))
    return F.shiftrightunsigned(bits, 11).cast("double") / float(1 << 53)


def ranked(df: DataFrame, cell: Column, groups: list[int], order: list[str], out: str) -> DataFrame:
    """Gapless rank from 0 within each group, by unique ``order``.

    A group is split into cells, numbered through all groups, that follow each other in the order; ``groups`` names the group of each cell, in turn. A cell is one
    task, so a group that holds a third of all rows is spread out. The driver sees a count a cell; the rows move once,
    to the task that their cell's number names.
    """
    spark = df.sparkSession
    celled = df.withColumn("_cell", cell.cast("int"))
    count = np.zeros(len(groups), dtype=np.int64)
    for r in celled.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect():
        count[r["_cell"]] = r["n"]
    before = np.cumsum(count) - count
    first = np.concatenate([[True], np.diff(groups) != 0])
    before -= before[np.maximum.accumulate(np.where(first, np.arange(len(groups)), 0))]
    offsets = spark.createDataFrame(pa.table({"_of": pa.array(np.arange(len(groups)), pa.int32()), "_before": pa.array(before, pa.int64())}))
    placed = celled.repartitionById(len(groups), F.col("_cell")).withColumn("_rank", F.row_number().over(Window.partitionBy("_cell").orderBy(*order)) - 1)
    # two numbers a cell
    return placed.join(F.broadcast(offsets), F.col("_cell") == F.col("_of")).withColumn(out, (F.col("_before") + F.col("_rank")).cast("long")).drop("_cell", "_of", "_before", "_rank")


def spread_join(rows: DataFrame, facts: DataFrame, key: str, count: str, by: str, most: int = 50_000) -> DataFrame:
    """Inner join of many rows with one fact a key, where some keys may have a large part of all rows.

    ``count`` of the facts tells how many rows a key has. A key of more than ``most`` rows, and more than one in 10,000 of all, is dealt
    into parts of so many by a hash of the column ``by``; there are 10,000 such keys at most, whose numbers of parts are broadcast.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    most = max(most, -(-total // 10_000))
    parts = F.ceil(F.col(count) / most).cast("int")
    hot = facts.where(F.col(count) > most).select(F.col(key).alias("_hot"), parts.alias("_parts"))
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    salted = salted.withColumn("_salt", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(by), F.lit(7)), F.col("_parts"))).cast("int")).drop("_hot", "_parts")
    copied = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), parts) - 1)))
    return salted.join(copied, [key, "_salt"]).drop("_salt")
