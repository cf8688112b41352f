"""Fitting a text classifier on a bounded sample of labelled rows and scoring every row with it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnp
from .common import uniform

SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, id_col: str = "doc_id", rows: int = SAMPLE_ROWS, text_col: str = "text") -> DataFrame:
    """(_t, _y) for about ``rows`` labelled training rows at most, chosen by a hash of the identifier.

    ``train`` is a condition on the identifier. Rows whose label or identifier is null are left out; an identifier with
    several labels counts with the greatest.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    total = known.count()
    chosen = known.where(uniform(F.col(id_col), seed=5) < min(1.0, 0.97 * rows / max(total, 1)))
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return texts.join(F.broadcast(chosen), id_col).select("_t", F.col("_y").cast("double").alias("_y"))  # about ``rows`` rows of two numbers


Features = Callable[[np.ndarray, np.ndarray], np.ndarray]


def feature_rows(sample: DataFrame, features: Features, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The features and labels of a bounded sample, computed where the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                x = features(data, offsets).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * width), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([lists, batch.column(batch.schema.get_field_index("_y")).slice(i, j - i)], ["x", "y"])

    got = sample.mapInArrow(run, "x array<float>, y double").toArrow()
    y = got.column("y").to_numpy().astype(np.float64)
    x = got.column("x").combine_chunks()
    flat = x.flatten() if isinstance(x, pa.Array) else pa.chunked_array([c.flatten() for c in x.chunks]).combine_chunks()
    return np.asarray(flat, dtype=np.float64).reshape(len(y), width), y


def score_rows(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row, from the bytes and offsets of its whole text; the texts stay where they are."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score(data, offsets), pa.float64())], [id_col, "score"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_rows(docs: DataFrame, keep: Callable[[np.ndarray, np.ndarray], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, for which ``keep`` is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, text_col):
                yield batch.slice(i, j - i).filter(pa.array(keep(data, offsets)))

    return docs.mapInArrow(run, docs.schema)


def rows_of(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row."""
    return np.bincount(row, weights=values, minlength=rows)


def byte_sums(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row are flagged."""
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)
