"""Token counts of whole texts by a public tokenizer, with a table of frequent pre-tokens and a cache in every worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import table

#: Pre-tokens of the broadcast table at most; rows, about, and files that it is learned from; probes of a look-up.
FREQUENT, SAMPLE_ROWS, SAMPLE_FILES, PROBES = 1 << 17, 4_000, 64, 4
#: Pre-tokens that a worker keeps, and the longest of those in bytes.
CACHE, CACHE_BYTES = 400_000, 64
#: Pre-tokens of a sampled task that reach the driver at most.
TASK_MOST = 1 << 16
LIMIT = 4096
#: What stands for a space in pieces.
SPACE = "▁"


class Splitter:
    """Cuts texts where no piece of the vocabulary can reach across, so that counts of the parts add up to the count of the whole.

    A part ends between two characters that are neighbours in no piece: merges make pieces only, so none crosses. Characters are
    judged by the last byte of the one and the first of the next, which cuts less often but never wrongly.
    """

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        probe = "  a ﬁＡ\t b "
        if self.model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that take texts as they are, with a space in front, can be counted in parts")
        joins = np.zeros((256, 256), dtype=bool)
        for i in range(self.model.get_piece_size()):
            if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i):
                continue
            chars = [c.encode() for c in self.model.id_to_piece(i).replace(SPACE, " ")]
            for a, b in zip(chars, chars[1:], strict=False):
                joins[a[-1], b[0]] = True
        alone = [b for b in range(128) if b != 32 and not joins[b].any() and not joins[:, b].any()]
        if not alone:
            raise ValueError("every character is a neighbour in some piece")
        joins[:, 0x80:0xC0] = True  # the bytes of a character stay together
        self.joins, self.front = joins, chr(alone[0])
        self.front_tokens = len(self.model.encode(self.front))

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a part begins at each byte but the first."""
        return ~self.joins[data[:-1], data[1:]]

    def count(self, parts: list[bytes]) -> list[int]:
        """Tokens of each part. What comes first in a text gets a space in front, so each part is read behind a character that joins nothing."""
        return [len(x) - self.front_tokens for x in self.model.encode([self.front + p.decode() for p in parts], num_threads=1)]


class Frequent:
    """Token counts of frequent pre-tokens by a hash of 64 bits and the length in bytes, at open addresses."""

    def __init__(self, parts: list[bytes], counts: list[int]):
        size = 1 << max(4, (4 * len(parts)).bit_length())
        self.keys, self.lengths, self.counts = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint16), np.zeros(size, dtype=np.uint16)
        for part, code, n in zip(parts, hashed(parts).tolist(), counts, strict=True):
            if len(part) >= 1 << 16 or n >= 1 << 16:
                continue
            for at in ((code + p) & (size - 1) for p in range(PROBES)):
                if not self.lengths[at]:
                    self.keys[at], self.lengths[at], self.counts[at] = code, len(part), n
                    break

    def find(self, code: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The count of each, or -1."""
        out = np.full(len(code), -1, dtype=np.int64)
        left = np.arange(len(code))
        for p in range(PROBES):
            at = ((code[left] + np.uint64(p)) & np.uint64(len(self.keys) - 1)).astype(np.int64)
            hit = (self.keys[at] == code[left]) & (self.lengths[at] == length[left])
            out[left[hit]] = self.counts[at[hit]]
            left = left[~hit & (self.lengths[at] > 0)]  # an empty place ends the search
            if not len(left):
                break
        return out


def hashed(parts: list[bytes]) -> np.ndarray:
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    return textnp.hashes(np.frombuffer(b"".join(parts), dtype=np.uint8), np.array([len(p) for p in parts], dtype=np.int64))


def segments(splitter: Splitter, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of bounded size: a long text is cut where a part begins, so memory does not grow with it."""
    if len(data) <= 2 * textnp.CHUNK_BYTES:
        yield 0, data, offsets
        return
    for row in range(len(offsets) - 1):
        at, stop = int(offsets[row]), int(offsets[row + 1])
        while at < stop:
            end = min(stop, at + textnp.CHUNK_BYTES)
            while end < stop:
                cut = np.flatnonzero(splitter.cuts(data[at:end]))
                if len(cut):
                    end = at + int(cut[-1]) + 1
                    break
                end = min(stop, end + textnp.CHUNK_BYTES)
            yield row, data[at:end], np.array([0, end - at])
            at = end


def parts_of(splitter: Splitter, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and length of every pre-token, and the pre-tokens themselves."""
    begins = np.ones(len(data), dtype=bool)
    begins[1:] = splitter.cuts(data)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(begins)
    ends = np.append(start, len(data))
    parts = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
    return np.searchsorted(offsets, start, side="right") - 1, np.diff(ends), parts


#: Of this worker: splitters by model, and the counts of pre-tokens met, which outlive a task.
_SPLITTERS: dict[bytes, Splitter] = {}
_CACHES: dict[bytes, dict[bytes, int]] = {}


def _worker(proto: bytes) -> tuple[Splitter, dict[bytes, int]]:
    if proto not in _SPLITTERS:
        _SPLITTERS[proto], _CACHES[proto] = Splitter(proto), {}
    return _SPLITTERS[proto], _CACHES[proto]


def _missed(splitter: Splitter, cache: dict[bytes, int], parts: pa.Array) -> np.ndarray:
    """Counts of pre-tokens from the worker's cache; those it lacks are encoded, each once."""
    coded = parts.dictionary_encode()
    own = coded.dictionary.to_pylist()
    fresh = [p for p in own if p not in cache]
    new = dict(zip(fresh, splitter.count(fresh), strict=True))
    counts = np.array([new[p] if p in new else cache[p] for p in own], dtype=np.int64)
    if len(cache) + len(new) > CACHE:
        cache.clear()
    if len(new) <= CACHE:
        cache.update((p, n) for p, n in new.items() if len(p) <= CACHE_BYTES)
    return counts[coded.indices.to_numpy()]


def _bytes_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As :func:`textnp.chunks`; the character that stands for a space in pieces counts as one."""
    for i, j, data, offsets in textnp.chunks(batch, column):
        if len(data) > 2 and ((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)).any():
            texts = [bytes(data[a:b]).replace(SPACE.encode(), b" ") for a, b in zip(offsets, offsets[1:], strict=False)]
            data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
        yield i, j, data, offsets


def frequent_pretokens(docs: DataFrame, proto: bytes, text_col: str = "text", most: int = FREQUENT, rows: int = SAMPLE_ROWS, files: int = SAMPLE_FILES) -> Frequent:
    """A table of the pre-tokens that are most frequent in about ``rows`` texts of about ``files`` files.

    It decides how fast counts are found, never what they are. Where the frame has no files to choose from, all texts are looked at for the sample.
    """
    total = docs.count()
    some, seen = docs, len(docs.inputFiles())
    if seen > files:
        try:
            some = docs.where(F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(-(-seen // files))) == 0)
        except AnalysisException:
            seen = 0
    share = rows * max(1.0, seen / files if files else 1.0) / max(total, 1)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = some.where(F.pmod(F.xxhash64(text, F.lit(41)), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20))).select(F.when(text != "", F.concat(F.lit(" "), text)).otherwise("").alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, _ = _worker(proto)
        met: list[pa.Table] = []
        for batch in batches:
            for _, _, data, offsets in _bytes_of(batch, "_t"):
                for _, piece, ends in segments(splitter, data, offsets):
                    if len(piece):
                        x = pc.value_counts(parts_of(splitter, piece, ends)[2].cast(pa.binary()))
                        met.append(pa.table({"part": x.field(0), "n": x.field(1)}))
        if met:
            sums = pa.concat_tables(met).group_by("part").aggregate([("n", "sum")])
            top = sums.take(pc.select_k_unstable(sums, k=min(TASK_MOST, sums.num_rows), sort_keys=[("n_sum", "descending")]))
            top = top.filter(pc.less_equal(pc.binary_length(top["part"]), CACHE_BYTES)).combine_chunks()
            counts = splitter.count(top["part"].to_pylist())
            yield from pa.table({"part": top["part"], "n": top["n_sum"], "tokens": pa.array(counts, pa.int32())}).to_batches()

    got = sample.mapInArrow(run, "part binary, n long, tokens int").toArrow()
    best = got.group_by("part").aggregate([("n", "sum"), ("tokens", "max")]).sort_by([("n_sum", "descending"), ("part", "ascending")]).slice(0, most)
    return Frequent(best["part"].to_pylist(), best["tokens_max"].to_pylist())


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, frequent: int = FREQUENT) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row, by the sentencepiece model in the file ``model``.

    Texts stay where they are and nothing is shuffled. A text is cut into pre-tokens that no piece can cross (:class:`Splitter`). Their counts come from a compact
    table of at most ``frequent`` pre-tokens, learned from a bounded sample and broadcast with the model; what it lacks is looked up in a cache of the worker, of at most
    :data:`CACHE` entries, and encoded where that lacks it too. Counts are those of the library for the whole text, without begin, end and added special tokens;
    the strings of special tokens inside texts are ordinary text. Long texts are cut into pieces of about a megabyte between pre-tokens.

    Null and empty texts have no bytes and no tokens; null and repeated identifiers and repeated rows are rows like others; other columns are not read;
    an empty table gives an empty result. ``model`` is read on the driver only. ``over_limit`` is whether there are more than ``limit`` tokens.
    """
    with open(model, "rb") as f:
        proto = f.read()
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((proto, frequent_pretokens(docs, proto, text_col, frequent)))  # at most 2 MB, and the model
    text = F.coalesce(F.col(text_col), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        proto, known = held.value
        splitter, cache = _worker(proto)
        for batch in batches:
            for i, j, data, offsets in _bytes_of(batch, "_t"):
                total = np.zeros(j - i, dtype=np.int64)
                for base, piece, ends in segments(splitter, data, offsets):
                    if not len(piece):
                        continue
                    row, length, parts = parts_of(splitter, piece, ends)
                    counts = known.find(textnp.hashes(piece, length), length)
                    if len(miss := np.flatnonzero(counts < 0)):
                        counts[miss] = _missed(splitter, cache, parts.take(pa.array(miss)))
                    total[base : base + len(ends) - 1] += np.bincount(row, weights=counts, minlength=len(ends) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(total)], ["_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.when(text != "", F.concat(F.lit(" "), text)).otherwise("").alias("_t"))
    out = rows.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document by the byte-fallback BPE model of 32,000 pieces."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
