"""Parquet files of few rows in local folders.

Hadoop's local file system, where it has no native library, starts a process (``chmod``) for every file that it creates, and one for the file's checksum; with 50 rows a file those are most of what a
store costs. Here tasks write the files by Arrow, into a folder of the attempt, and the driver moves them when all tasks are done, as Spark's own committer does. There are no checksum files; pages have theirs.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Rows of a file, above which Spark's own writer is as good.
FEW_ROWS = 10_000
#: Where Spark keeps the schema of a file, with what Parquet has no place for, as the metadata of columns.
SCHEMA_KEY = "org.apache.spark.sql.parquet.row.metadata"
#: Types that Arrow writes as Spark does.
PLAIN = (T.BooleanType, T.IntegralType, T.FractionalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass
class Attempt(WriterCommitMessage):
    """The folder that a task wrote."""

    folder: str


class PartsWriter(DataSourceArrowWriter):
    """Files of ``most_rows`` at most. The last column is the folder of a row below the base; rows of a folder follow each other within a partition."""

    def __init__(self, base: str, most_rows: int, schema: str):
        self.base, self.most_rows, self.job = base, most_rows, uuid.uuid4().hex
        self.footer = {SCHEMA_KEY: schema}
        self.drafts = f"{base}/_temporary-{self.job}"  # readers skip what begins with _

    def write(self, iterator: Iterator) -> Attempt:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        task = TaskContext.get()
        attempt = f"{self.drafts}/{task.taskAttemptId()}"
        name = f"part-{task.partitionId():05d}-{self.job}"
        written = 0

        def put(folder: str, rows: pa.Table) -> None:
            nonlocal written
            os.makedirs(f"{attempt}/{folder}", exist_ok=True)
            with pq.ParquetWriter(f"{attempt}/{folder}/{name}-{written:06d}.snappy.parquet", rows.schema, store_schema=False, write_page_checksum=True) as file:
                file.write_table(rows)
                file.add_key_value_metadata(self.footer)
            written += 1

        held = None  # the last folder and its rows that do not fill a file yet
        for batch in iterator:
            runs, start = pc.run_end_encode(batch.column(batch.num_columns - 1)), 0
            table = pa.Table.from_batches([batch.select(range(batch.num_columns - 1))])
            for folder, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                rows, start = table.slice(start, end - start), end
                if held and held[0] == folder:
                    rows = pa.concat_tables([held[1], rows])
                elif held:
                    put(*held)
                full = rows.num_rows - rows.num_rows % self.most_rows
                for at in range(0, full, self.most_rows):
                    put(folder, rows.slice(at, self.most_rows))
                held = (folder, rows.slice(full)) if full < rows.num_rows else None
        if held:
            put(*held)
        return Attempt(attempt)

    def commit(self, messages: list[Attempt | None]) -> None:
        for message in filter(None, messages):
            for folder, _, names in os.walk(message.folder):
                own = self.base + folder[len(message.folder) :]
                os.makedirs(own, exist_ok=True)
                for name in names:
                    os.rename(f"{folder}/{name}", f"{own}/{name}")
        self.abort(messages)
        open(f"{self.base}/_SUCCESS", "w").close()

    def abort(self, messages: list[Attempt | None]) -> None:
        shutil.rmtree(self.drafts, ignore_errors=True)


class Parts(DataSource):
    """The sink of :func:`save_parts`."""

    @classmethod
    def name(cls) -> str:
        return "sensorframe_parts"

    def writer(self, schema: T.StructType, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options["path"], int(self.options["most_rows"]), self.options["schema"])


def local_folder(df: DataFrame, base: str) -> str | None:
    """The folder that a base is on the machines' own file system, or None where it is of another store."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(path).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def save_parts(df: DataFrame, base: str, most_rows: int) -> None:
    """Append rows, whose last column names their folder, in files of ``most_rows`` at most to a local folder."""
    df.sparkSession.dataSource.register(Parts)
    schema = T.StructType(df.schema.fields[:-1]).json()  # what a writer is given lacks the metadata of columns
    df.write.format(Parts.name()).mode("append").options(most_rows=most_rows, schema=schema).save(base)
