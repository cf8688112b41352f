"""Uniform shuffle into shards of exact size, planned by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLACE_BITS, ROWS_A_SLICE, materialise, numbered, ranked, table, uniform, width, with_rows


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows each block sends to each shard, as a uniform shuffle would.

    Rows sum to the sizes of the blocks and columns to the sizes of the shards, which differ by
    one at most. Each row is a draw without replacement from the places still free. It holds
    blocks x shards integers, however many rows there are.
    """
    total = sum(block_rows)
    free = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    rng = np.random.default_rng(seed)
    out = np.zeros((len(block_rows), shards), dtype=np.int64)
    for i, n in enumerate(block_rows):
        left, pool = n, int(free.sum())
        for s in range(shards):  # one hypergeometric draw a cell
            pool -= int(free[s])
            out[i, s] = rng.hypergeometric(free[s], pool, left) if left and free[s] and pool else min(left, free[s]) if not pool else 0
            left -= out[i, s]
        free -= out[i]
    return out


def with_place(docs: DataFrame) -> DataFrame:
    """The frame with ``_place``: the number of every row, from 0, in the order of the table.

    That is the order of the files by the number that Spark gave them, and of the rows in each. A frame that does not
    read files is written first. The driver sees a count of rows a file.
    """
    try:
        meta = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        docs = materialise(docs, "ordered")
        meta = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    files = meta.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.max("_index").alias("last"))
    part = lambda pattern: F.coalesce(F.regexp_extract("_file", pattern, 1).try_cast("long"), F.lit(-1))
    known = files.select("_file", "n", part(r"part-(\d+)[^/]*$").alias("a"), part(r"-c(\d+)[^/]*$").alias("b")).collect()
    known.sort(key=lambda r: (r["a"], r["b"], r["_file"]))
    count = np.array([r["n"] for r in known], dtype=np.int64)
    starts = pa.table({"_of": pa.array([r["_file"] for r in known], pa.string()), "_start": pa.array(np.cumsum(count) - count, pa.int64())})
    # a row a file
    return meta.join(F.broadcast(docs.sparkSession.createDataFrame(starts)), F.col("_file") == F.col("_of")).withColumn("_place", F.col("_start") + F.col("_index")).drop("_file", "_index", "_of", "_start")


def shard(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 17,
    rows_a_slice: int = ROWS_A_SLICE,
    in_order: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to every row.

    The law is ``rows``: counts of shards differ by one at most. The partitions of the table are the blocks: each is permuted where it
    is read and cut by its row of the matrix, the cuts are exchanged, and every shard is permuted again, in slices
    of about ``rows_a_slice`` rows. ``slot`` is gapless from 0 within a shard. With ``in_order`` a shard's rows are in the order of the
    table instead of a second permutation, so each shard is a uniform sample of the table in the table's order. Rows move once.
    The driver sees counts of blocks and slices, never rows. Under this law copies of a text are dealt as single rows: a text that
    more than one row in ``shards`` has could not stay together in shards of equal counts.

    ``stored`` says that ``docs`` reads files as they are; any other frame is written first, as its partitions have to be the same
    when they are counted and when they are dealt. Null text has size 8 and the checksum of no bytes; null identifiers and repeated rows are
    rows like others, drawn by their place. Columns of ``docs`` named like an added one are replaced by it. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    plain, own = numbered(docs if stored else materialise(docs, "shard-rows"))
    rows = with_rows(with_place(plain) if in_order else plain, True).withColumn("_block", F.shiftright("_row", PLACE_BITS).cast("int"))
    counts = {r["_block"]: r["n"] for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks, total = sorted(counts), sum(counts.values())
    ends = np.cumsum(communication_matrix([counts[b] for b in blocks], shards, seed), axis=1)
    plan = spark.createDataFrame(pa.table({"_of": pa.array(blocks, pa.int32()), "_ends": pa.ListArray.from_arrays(pa.array(np.arange(len(blocks) + 1) * shards, pa.int32()), pa.array(ends.ravel(), pa.int64()))}))
    data = F.coalesce(F.col(own[text_col]), F.lit("")).cast("binary")
    permuted = (
        rows.withColumn("_crc", F.crc32(data)).withColumn("_size", (F.octet_length(data) + 8).cast("long")).withColumn("_first", uniform(F.col("_row"), seed=seed))
        .sortWithinPartitions("_first", "_row").withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
    )
    cut = permuted.join(F.broadcast(plan), F.col("_block") == F.col("_of"))  # blocks x shards integers
    cut = cut.withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_at")))).drop("_ends", "_of", "_at", "_first", "_block")
    slices = max(1, -(-width(spark) // shards), -(-total // (shards * rows_a_slice)))
    along = F.col("_place") / max(total, 1) if in_order else uniform(F.col("_row"), seed=seed + 1)
    cut = cut.withColumn("_along", along)
    cell = F.col("shard") * slices + F.least(F.floor(F.col("_along") * slices), F.lit(slices - 1))
    placed = ranked(cut, cell, [s for s in range(shards) for _ in range(slices)], ["_along", "_row"], "slot")
    kept = [F.col(c).alias(name) for name, c in own.items() if name not in added]
    return placed.select(
        *kept, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 whose counts differ by one at most."""
    return shard(table(spark, sf_dir, "documents"), stored=True).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
