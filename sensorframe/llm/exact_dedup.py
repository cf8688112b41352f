"""Exact deduplication by content sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, numbered, table, width, with_rows

#: Characters of a text that splitters hold; rows of one text that a cell holds at least; cells of hot texts at most, about.
PREFIX, CELL_ROWS, HOT_CELLS = 64, 256, 10_000


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "min",
    partitions: int | None = None,
    cell_rows: int = CELL_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Group rows of equal normalised text and mark the one that stays.

    Sampled splitters (those of ``repartitionByRange``) deal the rows by the first characters of the normalised text, then a hash that
    stands for the rest, so that splitters stay short whatever the texts are, then a cell: a text that many rows share is split into
    cells of about ``cell_rows`` rows, or a share of 1 in 5,000 of all rows if that is more, by the number of the row. Each range is sorted externally by
    these and the whole text, so that equal texts are neighbours, and each row is compared with its neighbour in full.
    Rows move once; the windows keep to the ranges. The cells of a hot text (one row each, with its whole text) are
    then added up; hot cells have a proven bound, about ``HOT_CELLS``, and what they found is broadcast to their rows. No text gathers in one task.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256. Null text counts as
    empty. A row with a null identifier stays only where its group has no other. Of rows equal in text and identifier exactly one is
    kept. Other columns of ``docs`` are not read; an empty table gives an empty result. ``stored`` says that ``docs`` reads files as they are;
    any other frame is written first.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    plain, own = numbered(docs.select(id_col, text_col))
    text = F.coalesce(F.col("c1"), F.lit(""))
    rows = with_rows(plain, stored).select(F.col("c0").alias("_id"), "_row", (normalise(text) if normalise else text).alias("_t"))
    rows = rows.withColumn("_x", F.xxhash64("_t"))
    counts = rows.groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    most = max(cell_rows, -(-2 * total // HOT_CELLS))
    hot = counts.where(F.col("_n") > most).select(F.col("_x").alias("_hot"), F.ceil(F.col("_n") / most).cast("int").alias("_cells"))
    celled = rows.join(F.broadcast(hot), F.col("_x") == F.col("_hot"), "left")  # HOT_CELLS / 2 rows at most
    celled = celled.withColumn("_cell", F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_cells")), F.lit(0)).cast("int")).withColumn("_head", F.substring("_t", 1, PREFIX)).drop("_hot")
    dealt = celled.repartitionByRange(partitions or width(docs.sparkSession), "_head", "_x", "_cell")

    # the row that stays is the first of its cell
    first = (F.col("_id").desc_nulls_last() if keep == "max" else F.col("_id").asc_nulls_last(), F.col("_row"))
    line = Window.partitionBy("_head", "_x", "_cell", "_t").orderBy(*first)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = F.struct(F.col("_id"), F.col("_row"))
    sized = dealt.withColumns({"_at": F.row_number().over(line), "_n": F.count(F.lit(1)).over(whole), "_best": F.first(best).over(whole)})
    # one text a hot cell, else numbers and the digest: the sorted ranges are read twice, but sorted once
    sized = materialise(sized.select("_id", "_row", "_cells", "_n", "_best", F.sha2("_t", 256).alias("_sha"), F.when(F.col("_cells").isNotNull() & (F.col("_at") == 1), F.col("_t")).alias("_t")), "runs")
    place = F.struct(F.col("_best._id").isNull() if keep == "min" else F.col("_best._id").isNotNull(), F.col("_best._id").alias("_id"))
    found = sized.where("_t IS NOT NULL").groupBy("_t", "_sha").agg(
        F.sum("_n").alias("_total"), (F.min_by if keep == "min" else F.max_by)("_best", F.struct(place, (F.col("_best._row") if keep == "min" else -F.col("_best._row")))).alias("_stay")
    )
    # a row a hot text, without the text; equal hashes of unlike texts differ in the digest
    wide = found.select(F.col("_sha").alias("_of"), "_total", "_stay")
    joined = sized.drop("_t").join(F.broadcast(wide), (F.col("_sha") == F.col("_of")) & F.col("_cells").isNotNull(), "left")
    stay = F.coalesce("_stay", "_best")
    return joined.select(
        F.col("_id").alias(id_col), stay["_id"].alias("keep_id"), F.coalesce("_total", "_n").cast("long").alias("group_size"), (F.col("_row") == stay["_row"]).alias("kept"), F.col("_sha").alias("text_sha256")
    )


def op9_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: equal texts keep the row with the largest identifier."""
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max", stored=True)


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
