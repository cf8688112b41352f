"""Tables of Parquet folders whose versions are manifests (S10, S13, X05, X07): a batch becomes visible as a whole, once, and touches only what it changes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Files:
    """Small files and folders of any store that Spark reaches."""

    def __init__(self, spark: SparkSession, base: str):
        self._gateway = spark.sparkContext._gateway
        self._jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        root = self.path(base)
        self.fs = root.getFileSystem(conf)
        self.context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        """What is in a folder; nothing where there is none."""
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """A file that is there as a whole or not at all; an error where it is there already."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.fs.create(self.path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        # without an option to overwrite, a name that is taken is an error
        no_options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self.context.rename(self.path(draft), self.path(name), no_options)
        except Exception:
            self.fs.delete(self.path(draft), False)
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass
class Version:
    """number, the folders of each part, and the last batch of each stream."""

    number: int = -1
    parts: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class VersionedTable:
    """Parquet folders under ``base/data`` and manifests under ``base/versions``; the manifest of the highest number says which folders are the table.

    A batch first writes folders of its own, then its manifest, which names them and the number of the batch in one step. Before that nothing reads the folders; after it the batch counts as done, and
    one that is played again changes nothing. So a crash anywhere loses and doubles nothing; it leaves folders that no manifest names, which :meth:`clean` deletes. Two writers cannot commit the same version: the second gets an error.

    ``part`` is an expression for the part that a row belongs to, its day for example; without it there is one part. The driver holds a line a folder. Merges replace the folders of the parts that a batch has rows
    of, and leave all others as they are.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, part: Column | None = None, keep: int = 10):
        self.spark, self.base, self.schema, self.keep = spark, base, schema, keep
        self.part = F.lit("all") if part is None else F.coalesce(part.cast("string"), F.lit("none"))
        self.files = Files(spark, base)

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.base}/versions") if n.endswith(".json")]

    def _manifest(self, number: int) -> Version:
        return Version(**json.loads(self.files.text(f"{self.base}/versions/{number:012d}.json")))

    def current(self) -> Version:
        numbers = self._numbers()
        return self._manifest(max(numbers)) if numbers else Version()

    def read(self, parts: list[str] | None = None, version: Version | None = None) -> DataFrame:
        """The rows of some parts, or of all."""
        version = version or self.current()
        folders = [f"{self.base}/data/{f}" for p in (version.parts if parts is None else parts) for f in version.parts.get(p, [])]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        """Folders by part."""
        own = uuid.uuid4().hex
        rows.select(*self.schema.names, self.part.alias("_part")).write.partitionBy("_part").parquet(f"{self.base}/data/{own}")
        return {unquote(n[len("_part=") :]): [f"{own}/{n}"] for n in self.files.names(f"{self.base}/data/{own}") if n.startswith("_part=")}

    def commit(self, old: Version, parts: dict[str, list[str]], stream: str, batch: int | None) -> Version:
        """Make ``parts`` the table, as the version after ``old``."""
        batches = old.batches | ({} if batch is None else {stream: batch})
        new = Version(old.number + 1, parts, batches)
        self.files.put_new(f"{self.base}/versions/{new.number:012d}.json", json.dumps(new.__dict__))
        return new

    def done(self, stream: str, batch: int | None) -> bool:
        """Whether a batch of a stream has been committed."""
        return batch is not None and self.current().batches.get(stream, -1) >= batch

    def append(self, rows: DataFrame, stream: str = "", batch: int | None = None) -> bool:
        """Add rows; whether they were added now, not before."""
        if self.done(stream, batch):
            return False
        old = self.current()
        parts = {p: list(f) for p, f in old.parts.items()}
        for p, folders in self._write(rows).items():
            parts.setdefault(p, []).extend(folders)
        self.commit(old, parts, stream, batch)
        return True

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], stream: str = "", batch: int | None = None) -> bool:
        """Put ``combine(old, new)`` in place of the parts that ``rows`` has rows of; whether it was done now. Rows must stay in their part."""
        if self.done(stream, batch):
            return False
        old = self.current()
        touched = [r[0] for r in rows.select(self.part.alias("_part")).distinct().collect()]  # parts of a batch: days
        new = self._write(combine(self.read([p for p in touched if p in old.parts], old), rows))
        self.commit(old, {p: f for p, f in old.parts.items() if p not in touched} | new, stream, batch)
        return True

    def clean(self) -> list[str]:
        """Delete manifests but the last ``keep`` and the folders that none of those names; run it while nothing writes. Returns the folders."""
        numbers = sorted(self._numbers())
        for n in numbers[: -self.keep]:
            self.files.delete(f"{self.base}/versions/{n:012d}.json")
        named = {f for n in numbers[-self.keep :] for folders in self._manifest(n).parts.values() for f in folders}
        gone = []
        for own in self.files.names(f"{self.base}/data"):
            for p in self.files.names(f"{self.base}/data/{own}"):
                if p.startswith("_part=") and f"{own}/{p}" not in named:
                    self.files.delete(f"{self.base}/data/{own}/{p}")
                    gone.append(f"{own}/{p}")
            if not any(f.startswith(f"{own}/") for f in named):
                self.files.delete(f"{self.base}/data/{own}")
        return gone
