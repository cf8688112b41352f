"""Toxicity by gradient-boosted trees over lexicon and style densities, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbt, textnp
from .common import materialise, remainder, table
from .learned import SAMPLE_ROWS, byte_sums, feature_rows, keep_rows, labelled_sample, rows_of, score_rows

#: Insults, threats and slights in four languages.
INSULTS = """idiot idiots moron morons stupid dumb fool loser losers scum trash garbage worthless pathetic disgusting clown ugly filthy vermin
idiota estupido estúpido imbecil imbécil basura asqueroso inutil inútil idiote stupide imbécile ordure minable ridicule débile
dumm dummkopf blöd blödmann trottel abschaum wertlos erbärmlich widerlich müll kill hate die shut""".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine deinem ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
NEAR, STEM_BYTES, LEXICON, FOLDS, WINDOW = 5, (4, 5, 6), 600, 3, 50
#: Look-alikes that hide letters.
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _LEET[_a] = _b
#: Each of the first is measured as a share of the words and as the logarithm of its count, so that long texts neither drown it nor pile it up.
COUNTED = ["insults", "learned words", "learned stems", "distinct learned", "hidden insults", "near second person", "sum of weights"]
NAMES = [f"{how} {c}" for c in COUNTED for how in ("share of", "log")] + ["second person", "best word", "densest window", "capitals", "capital words", "exclamations", "punctuation", "obfuscation", "digits", "words", "share of bad words"]


def _hashes(texts: list[str]) -> np.ndarray:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["t"])
    return np.unique(np.concatenate([textnp.words(data, offsets)[0] for _, _, data, offsets in textnp.chunks(batch, "t")]))


def _stems(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word's first bytes, for each of several lengths; shorter words hash to themselves."""
    code, out = np.zeros(len(start), dtype=np.uint64), []
    for j in range(max(STEM_BYTES)):
        at = np.minimum(start + j, max(len(data) - 1, 0))
        code = textnp.mix(code + (np.where(start + j < end, textnp.LOWER[data[at]].astype(np.uint64) + np.uint64(1), np.uint64(0)) if len(data) else np.uint64(0)))
        if j + 1 in STEM_BYTES:
            out.append(textnp.mix(code + np.uint64(j)))
    return out


def _weights(code: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The weight of each hash, 0 where it has none."""
    if not len(keys):
        return np.zeros(len(code))
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    return np.where(keys[at] == code, values[at], 0.0)


def _densest(flag: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The most flagged words among any :data:`WINDOW` words in turn of each row."""
    out = np.zeros(rows)
    if len(flag):
        total = np.concatenate([[0], np.cumsum(flag)])
        end = np.cumsum(np.bincount(row, minlength=rows))[row]
        np.maximum.at(out, row, total[np.minimum(np.arange(len(flag)) + WINDOW, end)] - total[:-1])
    return out


@dataclass
class ToxicityModel:
    """A learned lexicon (words and stems with their weights), trees and the calibration of their score."""

    words: np.ndarray
    word_weight: np.ndarray
    stems: np.ndarray
    stem_weight: np.ndarray
    trees: gbt.Trees | None = None
    calibration: gbt.Isotonic | None = None

    def __post_init__(self):
        self.insults, self.persons = _hashes(INSULTS), _hashes(SECOND_PERSON)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of :data:`NAMES` for each text."""
        rows = len(offsets) - 1
        code, row, start, end = textnp.words(data, offsets)
        n = np.maximum(rows_of(np.ones(len(row)), row, rows), 1)
        size = np.maximum(np.diff(offsets), 1)
        insult = np.isin(code, self.insults)
        word = _weights(code, self.words, self.word_weight)
        stem = np.max([_weights(x, self.stems, self.stem_weight) for x in _stems(data, start, end)], axis=0) if len(code) else np.zeros(0)
        plain = _LEET[data]
        masked = textnp.words(plain, offsets, textnp.SOLID)
        hidden = np.isin(masked[0], self.insults) | (_weights(masked[0], self.words, self.word_weight) > 0)
        bad = insult | (word > 0) | (stem > 0)
        person = np.isin(code, self.persons)
        near = np.zeros(len(code), dtype=bool)
        at = np.flatnonzero(person)
        for d in range(-NEAR, NEAR + 1):
            to = at + d
            ok = (to >= 0) & (to < len(code))
            ok[ok] &= row[to[ok]] == row[at[ok]]
            near[to[ok]] |= bad[to[ok]]
        _, kinds, _ = textnp.distinct(code[bad], row[bad])
        best = np.zeros(rows)
        np.maximum.at(best, row, np.maximum(word, stem))
        caps = (data >= 65) & (data <= 90)
        letters = caps | ((data >= 97) & (data <= 122))
        cap_total = np.concatenate([[0], np.cumsum(caps)])
        shout = (cap_total[end] - cap_total[start] == end - start) & (end - start > 1)
        symbol = textnp.SOLID[data] & ~textnp.WORD[data]
        inside = np.zeros(len(data), dtype=bool)  # a digit or sign between letters
        if len(data) > 2:
            odd = symbol | ((data >= 48) & (data <= 57))
            inside[1:-1] = odd[1:-1] & letters[:-2] & letters[2:]
            full = np.diff(offsets) > 0
            inside[offsets[:-1][full]] = inside[offsets[1:][full] - 1] = False  # no text has the neighbours of another
        dots = symbol & np.isin(data, np.frombuffer(b".,'-", dtype=np.uint8), invert=True)
        per = lambda flag: rows_of(flag.astype(np.float64), row, rows)
        hid = rows_of(hidden.astype(np.float64), masked[1], rows)
        counts = [per(insult), per(word > 0), per(stem > 0), np.bincount(kinds, minlength=rows), hid, per(near), per(np.maximum(word, stem))]
        return np.stack(
            [
                *(x for c in counts for x in (c / n, np.log1p(c))), per(person) / n, best, _densest(bad, row, rows) / np.minimum(n, WINDOW),
                byte_sums(caps, offsets) / size, per(shout) / n, byte_sums(data == 33, offsets) / size,
                byte_sums(dots, offsets) / size, byte_sums(inside, offsets) / n, byte_sums((data >= 48) & (data <= 57), offsets) / size, np.log1p(n), per(bad) / n,
            ],
            axis=1,
        )

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = self.trees.score(self.features(data, offsets))
        return np.clip(self.calibration(raw), 0.0, 1.0)


def _term_counts(sample: DataFrame) -> DataFrame:
    """(kind, code, texts, toxic): in how many texts of a sample each word and stem is, and in how many toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(batch.schema.get_field_index("_y")))
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                code, row, start, end = textnp.words(data, offsets)
                for kind, value in ((0, code), *((1, x) for x in _stems(data, start, end))):
                    v, r, _ = textnp.distinct(value, row)
                    u, at = np.unique(v, return_inverse=True)
                    y = np.bincount(at, label[i + r], len(u)).astype(np.int64) if len(u) else np.zeros(0, dtype=np.int64)
                    n = np.bincount(at, minlength=len(u)) if len(u) else np.zeros(0, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind), pa.int32()), pa.array(u.view(np.int64)), pa.array(n, pa.int64()), pa.array(y, pa.int64())], ["kind", "code", "n", "y"])

    return sample.mapInArrow(run, "kind int, code long, n long, y long").groupBy("kind", "code").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))


def _lexicon(sample: DataFrame, most: int) -> ToxicityModel:
    """The words and stems (``most`` of either) that toxic texts of a sample hold far more often than others do, with their log odds."""
    n, pos = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("_y"), F.lit(0.0))).first()
    odds = F.log(((F.col("y") + 0.1) / (pos + 0.2)) / ((F.col("n") - F.col("y") + 0.1) / (n - pos + 0.2)))
    terms = _term_counts(sample).where("y >= 3").withColumn("w", odds).where("w > 2.5")

    def table_of(kind: int) -> tuple[np.ndarray, np.ndarray]:
        pairs = terms.where(F.col("kind") == kind).orderBy(F.desc("y"), "code").limit(most).collect()
        code = np.array([r["code"] for r in pairs], dtype=np.int64).view(np.uint64)
        order = np.argsort(code)
        return code[order], np.array([r["w"] for r in pairs])[order]

    return ToxicityModel(*table_of(0), *table_of(1))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, lexicon: int = LEXICON) -> ToxicityModel:
    """Fit on at most about ``sample_rows`` labelled rows that meet ``train``, each text once; learn ``lexicon`` words and as many stems at most.

    The sample is dealt into two halves by a hash of the text. The lexicon that a half's texts are
    measured by is learned from the other half, so the trees do not learn to trust words that were memorised; the
    calibration is fitted to scores of trees that have not seen the row. The final lexicon and trees take the whole sample.
    """
    sample = labelled_sample(docs, labels, label_col, train, id_col, sample_rows, text_col).groupBy("_t").agg(F.max("_y").alias("_y"))
    sample = materialise(sample, "toxic-sample")
    half = F.pmod(F.xxhash64("_t", F.lit(3)), F.lit(2))
    parts = []
    for h in (0, 1):
        parts.append(feature_rows(sample.where(half == h), _lexicon(sample.where(half != h), lexicon).features, len(NAMES)))
    x, y = (np.concatenate(z) for z in zip(*parts, strict=True))
    order = np.lexsort((*x.T, y))  # the same folds however the rows arrive
    x, y = x[order], y[order]
    model = _lexicon(sample, lexicon)
    model.trees = gbt.fit(x, y)
    fold, unseen = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for f in range(FOLDS):
        unseen[fold == f] = gbt.fit(x[fold != f], y[fold != f]).score(x[fold == f])
    model.calibration = gbt.isotonic(unseen, y)
    return model


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row.

    Null and empty texts score as texts without words; rows that repeat score alike; null ids are returned; other columns are not read. An empty
    table gives an empty result. Without labelled rows every text scores the prior, one half.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return score_rows(docs, lambda data, offsets: held.value.score(data, offsets), id_col, text_col)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda data, offsets: held.value.score(data, offsets) < threshold, text_col)


def op1_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibrated toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    scored = toxicity_scores(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
