"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import materialise, numbered, spread_join, table, with_rows

CONTAINMENT, COORDINATES, FILTER_BITS = 0.8, 64, 22
#: Shingles of a benchmark that workers hold as a whole; bits of a filter of a larger one, at most.
SHINGLES_A_BLOCK, MOST_FILTER_BITS = 2_000_000, 28
_FACTORS = textnp.mix(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)


def _part(size: np.ndarray) -> np.ndarray:
    """The partition of each item: those of up to L = 2, 4, 8... shingles that do not fit the one before."""
    return 1 << np.maximum(1, np.ceil(np.log2(np.maximum(size, 1)))).astype(np.int64)


def _least(value: np.ndarray, ends: np.ndarray, coordinates: int) -> np.ndarray:
    """The least value of every coordinate for each of several sets that are not empty."""
    return np.stack([np.minimum.reduceat(value * _FACTORS[j], ends[:-1]) for j in range(coordinates)], axis=1)


def _keyed(least: np.ndarray) -> np.ndarray:
    """The least values of each coordinate as keys of one index."""
    return (least ^ _FACTORS[None, : least.shape[1]]) * np.uint64(0x9E3779B97F4A7C15)


class Items:
    """Test items, partitioned by size, with an index of their MinHash values. Sets are sorted and not empty."""

    def __init__(self, ids: pa.Array, values: np.ndarray, ends: np.ndarray, coordinates: int):
        self.ids, self.values, self.ends, self.k = ids, values, ends, coordinates
        part = _part(np.diff(ends))
        keys = _keyed(_least(values, ends, coordinates)) if len(ids) else np.zeros((0, coordinates), dtype=np.uint64)
        self.parts = {}
        for p in np.unique(part).tolist():
            own = np.flatnonzero(part == p)
            key = keys[own].ravel()
            order = np.argsort(key, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[key >> np.uint64(64 - FILTER_BITS)] = True
            self.parts[p] = (key[order], np.repeat(own, coordinates)[order], bits)

    def set_of(self, item: int) -> np.ndarray:
        return self.values[self.ends[item] : self.ends[item + 1]]


def _windows(value: np.ndarray, row: np.ndarray, rows: int, sizes: list[int], coordinates: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each partition size the rows of all windows, and the windows' keys.

    Rows are cut into blocks as long as the smallest partition's items; a window of a partition
    spans its L shingles and one block more, and starts at every block, so a passage of an item lies within a
    window and the similarity of window and item does not fall with the length of the row.
    """
    step = min(sizes)
    count = np.bincount(row, minlength=rows)
    blocks = -(-count // step)
    first_block = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    if not total:
        return
    start = np.cumsum(count) - count
    of = np.repeat(np.arange(rows), blocks)
    # the last shingle of a row fills its last block up
    at = np.minimum((start[of] + (np.arange(total) - first_block[of]) * step)[None, :] + np.arange(step)[:, None], (start + count - 1)[of][None, :])
    cells = value[at]
    least = np.empty((coordinates, total), dtype=np.uint64)
    for j in range(coordinates):
        least[j] = (cells * _FACTORS[j]).min(axis=0)
    end = (first_block + blocks - 1)[of]
    span, window = 1, least
    for size in sorted(sizes):
        while span * step < size:
            window = np.minimum(window, window[:, np.minimum(np.arange(total) + span, end)])
            span *= 2
        yield size, of, _keyed(np.minimum(window, window[:, np.minimum(np.arange(total) + 1, end)]).T)


def _candidates(value: np.ndarray, row: np.ndarray, rows: int, items: Items) -> np.ndarray:
    """Pairs (row, item) that share a MinHash value in a window of the row as wide as the item's partition."""
    found = []
    for size, of, seen in _windows(value, row, rows, list(items.parts), items.k):
        keys, owner, bits = items.parts[size]
        hit = np.flatnonzero(bits[seen.ravel() >> np.uint64(64 - FILTER_BITS)])
        key = seen.ravel()[hit]
        lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
        n = hi - lo
        if n.sum():
            which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.unique(np.stack([np.repeat(of[hit // items.k], n), owner[which]], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)


def _matches(batch: pa.RecordBatch, column: str, items: Items, shingle: int, containment: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the batch, item and number of the item's shingles that the whole row has, where they are enough."""
    out = []
    for i, j, data, offsets in textnp.chunks(batch, column):
        code, row, _, _ = textnp.words(data, offsets)
        value, row = textnp.shingles(code, row, shingle)
        pairs = _candidates(value, row, j - i, items)
        edge = np.searchsorted(row, np.arange(j - i + 1))
        last, own = -1, value
        for r, item in pairs.tolist():
            if r != last:
                last, own = r, np.unique(value[edge[r] : edge[r + 1]])
            want = items.set_of(item)
            shared = int((own[np.minimum(np.searchsorted(own, want), len(own) - 1)] == want).sum())
            if shared >= containment * len(want):
                out.append((i + r, item, shared))
    return tuple(np.array(out, dtype=np.int64).reshape(-1, 3).T)


def _item_sets(benchmark: DataFrame, item_col: str, text_col: str, shingle: int) -> tuple[DataFrame, int]:
    """(_item, _set) for all items with words, written once, and how many shingles there are."""
    kind = benchmark.schema[item_col].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                code, row, _, _ = textnp.words(data, offsets)
                value, row, _ = textnp.distinct(*textnp.shingles(code, row, shingle))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), textnp.lists(value.view(np.int64), row, j - i, pa.int64())], ["_item", "_set"])

    rows = benchmark.select(F.col(item_col).alias("_item"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    done = materialise(rows.mapInArrow(sets, f"_item {kind}, _set array<long>").where(F.size("_set") > 0), "items")
    return done, done.agg(F.sum(F.size("_set"))).first()[0] or 0


def _arrays(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and ends of a column of lists."""
    return sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def _held(done: DataFrame, coordinates: int) -> Items:
    """The items with their index, for a benchmark of a checked size."""
    got = done.toArrow()
    ids, sets = (got.column(c).combine_chunks() for c in ("_item", "_set"))
    return Items(ids, *_arrays(sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets), coordinates)


def _filter(values: DataFrame, n: int) -> np.ndarray:
    """A bit for each of 16 times as many places as there are ``values`` (_v), 2^28 at most, set where one falls."""
    bits = min(MOST_FILTER_BITS, max(FILTER_BITS, int(np.ceil(np.log2(max(16 * n, 1))))))
    chunk = bits - 6  # 64 chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            for c in np.unique(at >> np.uint64(chunk)).tolist():
                own = held.setdefault(c, np.zeros(1 << chunk, dtype=bool))
                own[at[at >> np.uint64(chunk) == c] & np.uint64((1 << chunk) - 1)] = True
        for c, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())], ["chunk", "bits"])

    dealt = values.repartitionById(64, F.shiftrightunsigned("_v", 58).cast("int"))
    out = np.zeros((64, (1 << chunk) // 8), dtype=np.uint8)
    for r in dealt.mapInArrow(run, "chunk int, bits binary").toLocalIterator():
        out[r["chunk"]] |= np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out.ravel()


def _passes(value: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which values a filter lets through."""
    at = value >> np.uint64(64 - int(np.log2(len(held) * 8)))
    return (held[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1


def _part_key(key: np.ndarray, size: int) -> np.ndarray:
    return textnp.mix(key ^ np.uint64(size))


def _found_by_join(rows: DataFrame, done: DataFrame, shingle: int, coordinates: int, containment: float) -> DataFrame:
    """(_row, _id, _item, shared, item_shingles) for a benchmark that workers do not hold; ``rows`` has _row, _id, _t.

    Two filters of bounded size, one of all items' keys and one of all their shingles, are broadcast. Texts are read once and give the keys and shingles that
    pass, which is next to nothing for a clean text; keys meet items in a join, and what they share is counted from the shingles. A
    filter lets everything through that it should, so the result does not depend on its size.
    """
    spark = rows.sparkSession
    items = done.withColumn("_no", F.monotonically_increasing_id())

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                values, ends = _arrays(batch.column(1))
                key = _keyed(_least(values, ends, coordinates))
                part = _part(np.diff(ends))
                out = np.concatenate([_part_key(key[part == p], p).ravel() for p in np.unique(part).tolist()])
                no = np.concatenate([np.repeat(batch.column(0).to_numpy()[part == p], coordinates) for p in np.unique(part).tolist()])
                yield pa.RecordBatch.from_arrays([pa.array(no), pa.array(out.view(np.int64))], ["_no", "_v"])

    keys = materialise(items.select("_no", "_set").mapInArrow(keys_of, "_no long, _v long"), "item-keys")
    sizes = [1 << max(1, r["p"]) for r in done.select(F.ceil(F.log2(F.size("_set"))).cast("int").alias("p")).distinct().collect()]
    total = done.agg(F.sum(F.size("_set"))).first()[0]
    held = spark.sparkContext.broadcast((_filter(keys.select("_v"), done.count() * coordinates), _filter(done.select(F.explode("_set").alias("_v")), total), sorted(set(sizes))))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_filter, shingle_filter, sizes = held.value
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                code, row, _, _ = textnp.words(data, offsets)
                value, row = textnp.shingles(code, row, shingle)
                hit_row, hit_key = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
                for size, of, seen in _windows(value, row, j - i, sizes, coordinates):
                    key = _part_key(seen.ravel(), size)
                    hit = np.flatnonzero(_passes(key, key_filter))
                    hit_row.append(of[hit // coordinates])
                    hit_key.append(key[hit])
                key, at, _ = textnp.distinct(np.concatenate(hit_key), np.concatenate(hit_row))
                wanted = np.isin(row, at) & _passes(value, shingle_filter)
                own, own_at, _ = textnp.distinct(value[wanted], row[wanted])
                some = np.unique(at)
                take = pa.array(some)
                part = batch.slice(i, j - i)
                kept = lambda v, r: textnp.lists(v.view(np.int64), np.searchsorted(some, r), len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), kept(key, at), kept(own, own_at)], ["_row", "_id", "_keys", "_own"])

    kind = rows.schema["_id"].dataType.simpleString()
    seen = materialise(rows.select("_row", "_id", "_t").mapInArrow(look, f"_row long, _id {kind}, _keys array<long>, _own array<long>"), "seen")
    hits = seen.select("_row", F.explode("_keys").alias("_v"))
    facts = keys.join(hits.groupBy("_v").agg(F.count(F.lit(1)).alias("_rows")), "_v")
    pairs = materialise(spread_join(hits, facts, "_v", "_rows", "_row").select("_row", "_no").distinct(), "pairs")
    facts = items.join(pairs.groupBy("_no").agg(F.count(F.lit(1)).alias("_rows")), "_no")
    sets = spread_join(pairs, facts, "_no", "_rows", "_row")
    both = sets.join(seen.select("_row", "_id", "_own"), "_row")
    shared = both.select("_row", "_id", "_item", F.size(F.array_intersect("_own", "_set")).alias("shared"), F.size("_set").alias("item_shingles"))
    return shared.where(F.col("shared") >= containment * F.col("item_shingles"))


def find_test_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    containment: float = CONTAINMENT,
    shingle: int = textnp.SHINGLE,
    coordinates: int = COORDINATES,
    stored: bool = False,
) -> DataFrame:
    """Which rows hold which test items: id, item_id, shared, item_shingles, containment.

    An item counts as held where ``containment`` or more of its distinct five-word shingles occur
    anywhere in the whole text, verified exactly (on 64-bit hashes). Candidates come from MinHash: items
    are partitioned by size, long texts are seen through windows of the partition's size, and
    window and item are compared in 64 coordinates; an item of nine shingles in one
    passage is missed with a chance below 1e-6. The benchmark is shingled once. Up to ``SHINGLES_A_BLOCK`` shingles it is broadcast, and the texts stay where they are; beyond,
    filters of bounded size are, and what passes them meets the items in joins. Texts are read once either way (``stored`` says that ``docs`` reads files as they
    are; any other frame is written first where it has to be joined).

    Rows without a match give none. Null texts and null items have no words and match nothing; an item of fewer than
    five words matches only a text of the same words. Identifiers may be of any type; items with a null id keep it. Rows that repeat give their pairs each.
    Other columns are not read. An empty table on either side gives an empty result.
    """
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, shared int, item_shingles int, containment double"
    done, total = _item_sets(benchmark, item_col, item_text_col, shingle)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    if total > SHINGLES_A_BLOCK:
        found = _found_by_join(with_rows(rows, stored), done, shingle, coordinates, containment)
        return found.select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "shared", "item_shingles", (F.col("shared") / F.col("item_shingles")).alias("containment"))
    held = docs.sparkSession.sparkContext.broadcast(_held(done, coordinates))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for batch in batches:
            if not items.parts:
                continue
            row, item, shared = _matches(batch, "_t", items, shingle, containment)
            size = np.diff(items.ends)[item]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), items.ids.take(pa.array(item)), pa.array(shared, pa.int32()), pa.array(size, pa.int32()), pa.array(shared / np.maximum(size, 1), pa.float64())],
                [id_col, item_col, "shared", "item_shingles", "containment"],
            )

    return rows.mapInArrow(match, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", containment: float = CONTAINMENT, shingle: int = textnp.SHINGLE, coordinates: int = COORDINATES, stored: bool = False) -> DataFrame:
    """The rows that hold no test item, with all their columns; what counts as held is as in :func:`find_test_items`."""
    done, total = _item_sets(benchmark.select(F.lit(0).alias("_item"), F.col(item_text_col).alias("_text")), "_item", "_text", shingle)
    if total > SHINGLES_A_BLOCK:
        plain, own = numbered(docs if stored else materialise(docs, "rows"))
        rows = with_rows(plain, True)
        texts = rows.select("_row", F.lit(0).alias("_id"), F.coalesce(F.col(own[text_col]), F.lit("")).alias("_t"))
        found = _found_by_join(texts, done, shingle, coordinates, containment).select("_row").distinct()
        return rows.join(found, "_row", "left_anti").select(*(F.col(c).alias(name) for name, c in own.items()))
    held = docs.sparkSession.sparkContext.broadcast(_held(done, coordinates))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            if items.parts:
                keep[_matches(batch, text_col, items, shingle, containment)[0]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)


def op4_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds."""
    return find_test_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), stored=True).withColumn("containment", F.round("containment", 6))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z_\\x{80}-\\x{10FFFF}]+')"
_GRAMS = "unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g"
OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_GRAMS} FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
     b AS (SELECT item_id, {_GRAMS} FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
     n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id),
     s AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (g) GROUP BY ALL)
SELECT doc_id, item_id, CAST(shared AS INTEGER) AS shared, CAST(item_shingles AS INTEGER) AS item_shingles,
       round(CAST(shared AS DOUBLE) / item_shingles, 6) AS containment
FROM s JOIN n USING (item_id) WHERE shared >= 0.8 * item_shingles
"""
