"""Reading and writing stores (S01-S07, S14-S17, S21). A base path may be of any store that Spark reads, s3a:// too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.windows import in_blocks, joined_within
from .parts import FEW_ROWS, PLAIN, local_folder, save_parts


def scan_raw(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet under a path, partition columns as they are written, columns by name (S01). Where the ``schema`` is known, files are not opened once more for it."""
    reader = spark.read.option("recursiveFileLookup", False)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(base)


def with_day(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Zero-padded year, month and day of each row."""
    return df.withColumns({"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")})


def save_by_day(df: DataFrame, base: str, ts: str = "timestamp", most_rows: int | None = None) -> None:
    """Append to the day partitions of each row (S02); ``most_rows`` bounds the rows of a file.

    Rows are dealt by day and a few slices of it, so a day is neither one task nor thousands of files, unless ``most_rows`` is small: such files have a writer of their own where the base is a local folder.
    """
    slices = F.pmod(F.xxhash64(ts), F.lit(4))
    days = ["year", "month", "day"]
    out = with_day(df, ts).repartition(*days, slices)
    if most_rows and most_rows <= FEW_ROWS and all(isinstance(f.dataType, PLAIN) for f in df.schema) and (folder := local_folder(df, base)):
        of_day = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.coalesce(c, F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in days))
        save_parts(out.sortWithinPartitions(*days).select(*(F.col(f"`{c}`") for c in df.columns if c not in days), of_day.alias("_folder")), folder, most_rows)
        return
    writer = out.write.mode("append").partitionBy(*days)
    (writer.option("maxRecordsPerFile", most_rows) if most_rows else writer).parquet(base)


def convert(spark: SparkSession, source: str, kind: str, base: str, ts: str = "timestamp", device: str = "air-1") -> None:
    """CSV or Parquet files of a device into its day-partitioned store (S03); each row goes to its own day, not that of its file's first row."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(source) if kind == "csv" else spark.read.option("mergeSchema", True).parquet(source)
    save_by_day(df.withColumn(ts, F.col(ts).cast("timestamp_ntz")), f"{base}/{device}", ts)


def build_bronze(table: DataFrame | None, scan: DataFrame, rebuild: bool = False) -> DataFrame:
    """The scan as it is on a rebuild or first build; else distinct rows of the table and the scan, by name."""
    return scan if rebuild or table is None else table.unionByName(scan, allowMissingColumns=True).distinct()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, _piece, number, value) for every line of text files, numbered from 1 in each file.

    Lines are numbered within the pieces that files are read in, and pieces by where they begin, from a row a piece; so a large file is not read by one task.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_piece"), F.monotonically_increasing_id().alias("_id"))
    pieces = lines.groupBy("file", "_piece").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(F.col("file").alias("_file"), F.col("_piece").alias("_of"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = lines.join(starts, (F.col("file") == F.col("_file")) & (F.col("_piece") == F.col("_of")))
    return own.select("file", "_piece", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("number"), "value")


#: A field in quotes from its beginning to the separator behind it: inside, a quote is written twice; what follows the closing one is part of the field.
QUOTED = r'''(^|,)"[^"]*+(?:""[^"]*+)*+"[^,]*+'''
#: The same with its parts: what stands behind the closing quote belongs to the value.
QUOTED_AND_MORE = r'''(^|,)"([^"]*+(?:""[^"]*+)*+)"([^,]*+)'''
#: Lines of a record that are put together.
RECORD_LINES = 10_000


def _open(text: Column) -> Column:
    """Whether a record that begins with this text is still within quotes at its end."""
    return F.regexp_replace(text, QUOTED, "$1").rlike('(^|,)"')


def csv_records(spark: SparkSession, path: str, most_lines: int = RECORD_LINES) -> DataFrame:
    """(file, number, lines, value) of every record of CSV files: one line, or several that a value in quotes spans; ``number`` is that of its last line, as CSV readers count.

    Each line says whether it ends within quotes if it begins outside them, and if it begins inside. Such pairs compose, so what state a line begins in is a prefix over the lines of a piece of a file and
    over the pieces: the last line that ends alike in both cases, and how many turn the state after it. Files are read in parallel, however large. A record of over ``most_lines`` lines, as an unclosed quote
    makes, is not put together: it has null as value.
    """
    lines = numbered_lines(spark, path).withColumns({"_o0": _open(F.col("value")), "_o1": _open(F.concat(F.lit('"'), "value"))})
    fixed, turns = F.col("_o0") == F.col("_o1"), (F.col("_o0") & ~F.col("_o1")).cast("int")
    line = Window.partitionBy("file", "_piece").orderBy("number")
    upto, earlier = line.rowsBetween(Window.unboundedPreceding, Window.currentRow), line.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"_turns": F.sum(turns).over(upto)}).withColumn("_fix", F.when(fixed, F.struct(F.col("_o0").alias("s"), F.col("_turns").alias("t"))))
    odd = lambda c: c % 2 == 1

    def after(entry: Column, fix: Column, turned: Column) -> Column:
        """The state behind lines that were entered in one state, whose last fixed line and turns are known."""
        return F.when(fix.isNotNull(), fix["s"] != odd(turned - fix["t"])).otherwise(entry != odd(turned))

    # pieces of a file: a row each
    pieces = lines.groupBy("file", "_piece").agg(F.max_by("_fix", F.when(F.col("_fix").isNotNull(), F.col("number"))).alias("_f"), F.max("_turns").alias("_t"))
    order = Window.partitionBy("file").orderBy("_piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_all", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    pieces = pieces.withColumn("_fixed", F.last(F.when(F.col("_f").isNotNull(), F.struct(F.col("_f.s").alias("s"), (F.col("_all") + F.col("_f.t")).alias("t"))), ignorenulls=True).over(before))
    entries = pieces.select(F.col("file").alias("_file"), F.col("_piece").alias("_of"), after(F.lit(False), F.col("_fixed"), F.col("_all")).alias("_entry"))
    inside = lines.join(entries, (F.col("file") == F.col("_file")) & (F.col("_piece") == F.col("_of"))).drop("_file", "_of")
    fix_before, turned_before = F.last("_fix", ignorenulls=True).over(earlier), F.coalesce(F.sum(turns).over(earlier), F.lit(0))
    inside = inside.withColumn("_in", after(F.col("_entry"), fix_before, turned_before)).withColumn("_out", F.when(F.col("_in"), F.col("_o1")).otherwise(F.col("_o0")))
    # the line that a record begins with, for those of several lines
    single = inside.where("NOT _in AND NOT _out").select("file", "number", F.lit(1).cast("long").alias("lines"), "value")
    several = inside.where("_in OR _out").withColumn("_start", F.last(F.when(~F.col("_in"), F.col("number")), ignorenulls=True).over(upto))
    last = several.groupBy("file", "_piece").agg(F.max("_start").alias("_s"))
    starts = last.select(F.col("file").alias("_file"), F.col("_piece").alias("_of"), F.last("_s", ignorenulls=True).over(before).alias("_carried"))
    several = several.join(starts, (F.col("file") == F.col("_file")) & (F.col("_piece") == F.col("_of"))).withColumn("_start", F.coalesce("_start", "_carried"))
    sizes = several.groupBy("file", "_start").agg(F.max("number").alias("_last"), F.count(F.lit(1)).alias("lines"))
    few = several.join(sizes.where(F.col("lines") <= most_lines).select(F.col("file").alias("_f2"), F.col("_start").alias("_s2")), (F.col("file") == F.col("_f2")) & (F.col("_start") == F.col("_s2")))
    whole = few.groupBy("file", "_start").agg(F.array_sort(F.collect_list(F.struct("number", "value"))).alias("_l")).select(F.col("file").alias("_f3"), F.col("_start").alias("_s3"), F.array_join("_l.value", "\n").alias("value"))
    joined = sizes.join(whole, (F.col("file") == F.col("_f3")) & (F.col("_start") == F.col("_s3")), "left").select("file", F.col("_last").alias("number"), "lines", "value")
    return single.unionByName(joined)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, skip: bool = False, most_lines: int = RECORD_LINES) -> tuple[DataFrame, DataFrame]:
    """Rows of the right width, and (file, number, width, line) of the records that are not (S07); unless ``skip``, any such record is an error.

    The first record of each file that is not blank is its header, whose width counts too; one that reads like a header elsewhere is a row. Values in double quotes may hold separators, quotes and line ends. A blank line is a record
    of width 0, wherever it is. A record that an unclosed quote makes longer than ``most_lines`` lines is of width null.
    """
    records = csv_records(spark, path, most_lines)
    width = F.when(F.col("value") == "", 0).otherwise(F.size(F.split(F.regexp_replace("value", QUOTED, "$1"), ",", -1)))
    sized = records.withColumn("width", width)
    heads = sized.where("width IS NULL OR width > 0").groupBy("file").agg(F.min("number").alias("_head")).withColumnRenamed("file", "_of")  # a row a file
    wanted = F.coalesce(F.col("width") == len(schema.names), F.lit(False))
    bad = sized.where(~wanted).select("file", "number", "width", F.col("value").alias("line"))
    if not skip and (first := bad.orderBy("file", "number").head(3)):
        raise ValueError(f"records of another width than {len(schema.names)}: {[(r['number'], r['width']) for r in first]}")
    whole = F.regexp_replace("value", QUOTED_AND_MORE, '$1"$2$3"')
    row = F.from_csv(whole, schema.simpleString()[len("struct<") : -1].replace(":", " "), {"mode": "PERMISSIVE", "multiLine": "true", "escape": '"'})
    good = sized.where(wanted).join(heads, F.col("file") == F.col("_of")).where(F.col("number") > F.col("_head")).withColumn("_row", row)
    return good.select(*(F.col(f"_row.`{c}`").alias(c) for c in schema.names)), bad


def labelled_snapshot(df: DataFrame, label: str = "occupied") -> tuple[DataFrame, DataFrame]:
    """Rows with a label, and their count, label counts and nulls by column."""
    rows = df.where(F.col(label).isNotNull())
    summary = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"), *(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns if c != label))
    return rows, summary


def write_snapshot(df: DataFrame, path: str, label: str = "occupied") -> DataFrame:
    """Write the labelled rows (S14); none is an error. Returns the summary."""
    rows, summary = labelled_snapshot(df, label)
    if rows.isEmpty():
        raise ValueError("no labelled rows")
    rows.write.mode("overwrite").parquet(path)
    return summary


def export_summary(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows, distinct times and range of an export."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(ts).alias("timestamps"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def newest_within_bytes(df: DataFrame, size: str, cap: int, keys: list[str], order: list[str]) -> DataFrame:
    """The newest rows of each key whose sizes add up to the cap at most.

    What a row and all newer ones add up to is the key's total less what is before it: sums within blocks of the series, and of the blocks before.
    """
    own = in_blocks(df, keys, order, 0)
    sums = own.groupBy(*keys, "_block").agg(F.sum(size).alias("_s"))
    line = Window.partitionBy(*keys).orderBy("_block")  # a row a block
    offsets = sums.select(*keys, "_block", F.coalesce(F.sum("_s").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_head"), F.sum("_s").over(Window.partitionBy(*keys)).alias("_all"))
    within = F.coalesce(F.sum(size).over(Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = joined_within(own.withColumn("_own", within), offsets, [*keys, "_block"])
    return placed.where(F.col("_all") - F.col("_head") - F.col("_own") <= cap).select(*(F.col(f"`{c}`") for c in df.columns))


def wide_export(grid: DataFrame, metrics: list[str], zones: list[int], ts: str = "timestamp", zone: str = "zone_id") -> DataFrame:
    """One row a slot with ``<metric>_s<zone>`` columns, by metric and then zone."""
    value = lambda m, z: F.max(F.when(F.col(zone) == z, F.col(m))).alias(f"{m}_s{z}")
    return grid.groupBy(ts).agg(*(value(m, z) for m in metrics for z in zones))


def check_width(df: DataFrame, metrics: list[str], zones: list[int]) -> DataFrame:
    """The frame, if its header is that of :func:`wide_export`; else an error."""
    if len(df.columns) != 1 + len(metrics) * len(zones):
        raise ValueError(f"{len(df.columns)} columns instead of {1 + len(metrics) * len(zones)}")
    return df
