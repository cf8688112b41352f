"""Quality by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbt, textnp
from .common import remainder, table
from .learned import SAMPLE_ROWS, byte_sums, feature_rows, labelled_sample, rows_of, score_rows

NAMES = [
    "log bytes", "log words", "mean word", "word spread", "capitals", "capital words", "digits", "signs", "sign runs", "pipes", "exclamations", "other bytes", "distinct words",
    "distinct shingles", "lines", "mean line", "distinct lines", "largest line share", "full stops", "commas", "short words", "long words", "brackets", "words before signs", "spaces", "lines that end",
]


def _share(value: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The share of distinct values in each row, and of the most frequent one; 1 and 0 without values."""
    v, r, n = textnp.distinct(value, row)
    total = np.bincount(row, minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, r, n)
    return np.where(total, np.bincount(r, minlength=rows) / np.maximum(total, 1), 1.0), most / np.maximum(total, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`NAMES` for each whole text; an empty text has none of anything."""
    rows = len(offsets) - 1
    code, row, start, end = textnp.words(data, offsets)
    count = rows_of(np.ones(len(row)), row, rows)
    n, size = np.maximum(count, 1), np.maximum(np.diff(offsets), 1)
    length = (end - start).astype(np.float64)
    mean = rows_of(length, row, rows) / n
    spread = np.sqrt(np.maximum(rows_of(length**2, row, rows) / n - mean**2, 0))
    caps = (data >= 65) & (data <= 90)
    cap_total = np.concatenate([[0], np.cumsum(caps)])
    shout = (cap_total[end] - cap_total[start] == end - start) & (end - start > 1)
    sign = textnp.SOLID[data] & ~textnp.WORD[data]
    runs = np.zeros(len(data), dtype=bool)
    runs[1:] = sign[1:] & sign[:-1]
    followed = np.zeros(len(data), dtype=bool)
    followed[1:] = sign[1:] & textnp.WORD[data[:-1]]
    first = offsets[:-1][np.diff(offsets) > 0]
    runs[first] = followed[first] = False  # no text has the neighbours of another
    not_line = np.ones(256, dtype=bool)
    not_line[10] = False
    line, line_row, line_start, line_end = textnp.words(data, offsets, not_line)
    lines = rows_of(np.ones(len(line_row)), line_row, rows)
    full = np.isin(data[line_end - 1], np.frombuffer(b".!?", dtype=np.uint8)) if len(line_end) else np.zeros(0, dtype=bool)
    distinct_lines, largest = _share(line, line_row, rows)
    bytes_of = lambda flag: byte_sums(flag, offsets) / size
    of = lambda text: np.isin(data, np.frombuffer(text, dtype=np.uint8))
    per = lambda flag: rows_of(flag.astype(np.float64), row, rows) / n
    return np.stack(
        [
            np.log1p(size), np.log1p(count), mean, spread, bytes_of(caps), per(shout), bytes_of((data >= 48) & (data <= 57)), bytes_of(sign), bytes_of(runs), bytes_of(data == 124),
            bytes_of(data == 33), bytes_of(data >= 128), _share(code, row, rows)[0], _share(*textnp.shingles(code, row), rows)[0], np.log1p(lines),
            rows_of((line_end - line_start).astype(np.float64), line_row, rows) / np.maximum(lines, 1), distinct_lines, largest, bytes_of(data == 46), bytes_of(data == 44),
            per(length <= 3), per(length >= 12), bytes_of(of(b"()[]{}<>")), byte_sums(followed, offsets) / n, bytes_of(data == 32), rows_of(full.astype(np.float64), line_row, rows) / np.maximum(lines, 1),
        ],
        axis=1,
    )


@dataclass
class QualityModel:
    trees: gbt.Trees

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.trees.score(features(data, offsets))


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on at most about ``sample_rows`` labelled rows that meet ``train``; statistics are computed where the texts are."""
    return QualityModel(gbt.fit(*feature_rows(labelled_sample(docs, labels, label_col, train, id_col, sample_rows, text_col), features, len(NAMES))))


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row.

    Null and empty texts score as texts without bytes; rows that repeat score alike; null ids are returned; other columns are not read. An empty
    table gives an empty result. Without labelled rows every text scores one half.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return score_rows(docs, lambda data, offsets: held.value.score(data, offsets), id_col, text_col)


def op5_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    scored = quality_scores(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
