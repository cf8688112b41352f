"""Near-duplicate classes by dart MinHash, banded joining and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import discard, materialise, numbered, spread_join, table

COORDINATES, BAND_ROWS, SIMILARITY = 128, 4, 0.8
#: Rows of a block of a mixed band, at least and at most; shingles of a block at most, about; columns of a matrix.
BLOCK_ROWS, MOST_BLOCK_ROWS, BLOCK_SHINGLES, MATRIX_COLUMNS = 512, 2048, 2_000_000, 4096


def dart_minhash(element: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, k: int = COORDINATES, seed: int = 1) -> np.ndarray:
    """The earliest dart of every coordinate for each row's weighted set: rows x k times, infinite for an empty set.

    Darts fall on the plane of (weight, time) of every element as a Poisson process that depends
    on the element alone: for each unit cell of weight, a sequence of exponential gaps drawn from
    hashes. A dart also draws a coordinate and its place within the cell. A set catches
    the darts below its elements' weights; thrown until about k ln k + 4k darts are caught, which
    leaves few coordinates empty, and on for the rows that have an empty one. So the work
    is elements + k log k a row. Two sets agree in a coordinate with the probability of
    their weighted Jaccard similarity.
    """
    best = np.full(rows * k, np.inf)
    total = np.bincount(row, weights=weight, minlength=rows)
    with np.errstate(divide="ignore"):
        limit = np.where(total > 0, (k * np.log(k) + 4 * k) / total, 0.0)
    cells = np.ceil(weight).astype(np.int64)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    source = textnp.mix(np.repeat(element, cells) ^ textnp.mix(cell.astype(np.uint64) * np.uint64(2) + np.uint64(seed * 2 + 1)))
    room = np.minimum(1.0, np.repeat(weight, cells) - cell)
    owner = np.repeat(row, cells)
    left = np.arange(len(source))
    while len(left):
        base, who, space = source[left], owner[left], room[left]
        time, turn = np.zeros(len(base)), 0
        while len(base):
            ahead = 1 if len(base) > 4096 else 32
            steps = (np.arange(turn + 1, turn + ahead + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[None, :]
            draw = textnp.mix(base[:, None] + steps)
            gap = -np.log((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54)
            gap[:, 0] += time
            when = np.cumsum(gap, axis=1)
            caught = when <= limit[who][:, None]
            more = textnp.mix(draw)
            inside = caught & ((more & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0**-24 < space[:, None])
            at = (who[:, None] * k + ((more >> np.uint64(32)) % np.uint64(k)).astype(np.int64))[inside]
            np.minimum.at(best, at, when[inside])
            turn += ahead
            on = caught[:, -1]
            base, who, space, time = base[on], who[on], space[on], when[on, -1]
        empty = np.isinf(best.reshape(rows, k)).any(axis=1) & (total > 0)
        limit = np.where(empty, limit * 2, limit)
        left = left[empty[owner[left]]]
    return best.reshape(rows, k)


def bands(signature: np.ndarray, rows_a_band: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit key for every band of a signature."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows_a_band)
    key = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]).copy()
    for j in range(rows_a_band):
        key = textnp.mix(key + bits[:, :, j])
    return key


def _sets(batch: pa.RecordBatch, k: int, weighted: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """For each piece of a batch: its rows, their distinct shingles with counts, and a 128-bit fingerprint of each set, or bag."""
    for i, j, data, offsets in textnp.chunks(batch, "_t"):
        code, row, _, _ = textnp.words(data, offsets)
        value, row, count = textnp.distinct(*textnp.shingles(code, row, k))
        print_ = np.zeros((j - i, 2), dtype=np.uint64)
        for c, salt in enumerate((np.uint64(11), np.uint64(29))):
            np.add.at(print_[:, c], row, textnp.mix((value + count.astype(np.uint64) if weighted else value) ^ textnp.mix(np.full(1, salt, dtype=np.uint64))))
        size = np.bincount(row, minlength=j - i).astype(np.uint64)
        print_ = textnp.mix(print_ + size[:, None])
        yield i, j, value, row, count, [x.tobytes() for x in print_]


def _sketcher(k: int, coordinates: int, rows_a_band: int, weighted: bool):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, value, row, count, prints in _sets(batch, k, weighted):
                weight = count.astype(np.float64) if weighted else np.ones(len(value))
                signature = dart_minhash(value, row, weight, j - i, coordinates)
                keys = bands(signature, rows_a_band)
                n = np.bincount(row, minlength=j - i)
                keep = np.repeat(np.arange(j - i), keys.shape[1])
                has = n[keep] > 0
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(prints, pa.binary()), pa.array(n, pa.int32()), textnp.lists(keys.ravel()[has].view(np.int64), keep[has], j - i, pa.int64())],
                    ["_id", "_key", "_print", "_n", "_bands"],
                )

    return sketch


def _shingler(k: int, weighted: bool):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            for i, j, value, row, count, prints in _sets(batch, k, weighted):
                part = batch.slice(i, j - i)
                if weighted:  # the n-th copy of a shingle is an element of its own, so common elements add up to the lesser counts
                    copy = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    value, row = textnp.mix(np.repeat(value, count) + copy.astype(np.uint64)), np.repeat(row, count)
                short = (value >> np.uint64(32)).astype(np.uint32).view(np.int32)
                out = pa.RecordBatch.from_arrays([part.column(0), textnp.lists(short, row, j - i, pa.int32())], ["_node", "_set"])
                yield out.filter(pa.array([a == b for a, b in zip(prints, wanted[i:j], strict=True)]))

    return shingle


def _unit_links(node: np.ndarray, comp: np.ndarray, block: np.ndarray, values: np.ndarray, ends: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join different classes, within one block or between two, by products of 0/1 matrices."""
    left = block == block[0]
    right = left if left.all() else ~left
    size = np.diff(ends)
    row = np.repeat(np.arange(len(node)), size)
    unique, column = np.unique(values, return_inverse=True)
    common = np.zeros((int(left.sum()), int(right.sum())), dtype=np.float32)
    for c in range(0, len(unique), MATRIX_COLUMNS):
        here = (column >= c) & (column < c + MATRIX_COLUMNS)
        has = np.zeros((len(node), min(MATRIX_COLUMNS, len(unique) - c)), dtype=np.float32)
        has[row[here], column[here] - c] = 1
        common += has[left] @ has[right].T
    n = size.astype(np.float32)
    alike = common >= similarity * (n[left][:, None] + n[right][None, :] - common) - 1e-4
    apart = comp[left][:, None] != comp[right][None, :]
    a, b = np.nonzero(alike & apart)
    return _forest(node[left][a], node[right][b], comp[left][a], comp[right][b])


def _forest(a: np.ndarray, b: np.ndarray, comp_a: np.ndarray, comp_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links of a unit, those that join its classes; further links between the same classes would not change any."""
    pair = np.stack([np.minimum(comp_a, comp_b), np.maximum(comp_a, comp_b)], axis=1)
    _, first = np.unique(pair, axis=0, return_index=True)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    keep = []
    for i, (x, y) in zip(first.tolist(), pair[first].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            keep.append(i)
    return a[keep], b[keep]


def _swept(similarity: float):
    """Links of units (_band, _i, _j) whose rows follow each other in a partition."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y == x:
                    continue
                piece = batch.slice(x, y - x)
                if held and any(held[0].column(c)[0].as_py() != piece.column(c)[0].as_py() for c in range(3)):
                    yield _of_unit(held, similarity)
                    held = []
                held.append(piece)
        if held:
            yield _of_unit(held, similarity)

    return sweep


def _of_unit(pieces: list[pa.RecordBatch], similarity: float) -> pa.RecordBatch:
    unit = pa.Table.from_batches(pieces).combine_chunks()
    column = lambda name: unit.column(name).combine_chunks().to_numpy()
    sets = unit.column("_set").combine_chunks()
    sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
    a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if unit.num_rows > 1:
        a, b = _unit_links(column("_node"), column("_comp"), column("_block"), sets.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())]), similarity)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["_a", "_b"])


def components(edges: DataFrame) -> DataFrame:
    """(_node, _comp) for every node of an edge table (_a, _b); _comp is the least node of the component.

    Each round hooks every root onto its least neighbour and shortens the paths; the
    edges between roots shrink at least by half a round, so rounds grow with the logarithm of the
    largest component. Nothing is collected but whether edges are left.
    """
    labels = edges.select(F.col("_a").alias("_node")).union(edges.select("_b")).distinct().withColumn("_comp", F.col("_node"))
    labels = materialise(labels, "labels")
    left = materialise(edges.select(F.greatest("_a", "_b").alias("_hi"), F.least("_a", "_b").alias("_lo")).distinct(), "links")
    while not left.isEmpty():
        parent = materialise(left.groupBy("_hi").agg(F.min("_lo").alias("_lo")), "parents")
        while True:
            up = parent.select(F.col("_hi").alias("_lo"), F.col("_lo").alias("_up"))
            further = parent.join(up, "_lo", "left")
            if further.where(F.col("_up").isNotNull()).isEmpty():
                break
            old, parent = parent, materialise(further.select("_hi", F.coalesce("_up", "_lo").alias("_lo")), "parents")
            discard(old)
        root = parent.select(F.col("_hi").alias("_comp"), F.col("_lo").alias("_root"))
        old, labels = labels, materialise(labels.join(root, "_comp", "left").select("_node", F.coalesce("_root", "_comp").alias("_comp")), "labels")
        discard(old)
        a = parent.select("_hi", F.col("_lo").alias("_ra"))
        b = parent.select(F.col("_hi").alias("_lo"), F.col("_lo").alias("_rb"))
        moved = left.join(a, "_hi", "left").join(b, "_lo", "left").select(F.coalesce("_ra", "_hi").alias("_x"), F.coalesce("_rb", "_lo").alias("_y"))
        old, left = left, materialise(moved.where("_x != _y").select(F.greatest("_x", "_y").alias("_hi"), F.least("_x", "_y").alias("_lo")).distinct(), "links")
        discard(old, parent)
    discard(left)
    return labels


def _classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = textnp.SHINGLE,
    coordinates: int = COORDINATES,
    rows_a_band: int = BAND_ROWS,
    weighted: bool = False,
) -> DataFrame:
    """What :func:`near_duplicates` returns, with ``_key``, a hash of each row's identifier and text."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    keyed = rows.select("_id", F.xxhash64("_id", "_t").alias("_key"), "_t")
    sketch = keyed.mapInArrow(_sketcher(shingle, coordinates, rows_a_band, weighted), f"_id {kind}, _key long, _print binary, _n int, _bands array<long>")
    sketch = materialise(sketch.withColumn("_row", F.monotonically_increasing_id()), "sketch")
    nodes = materialise(sketch.groupBy("_print").agg(F.min("_row").alias("_node"), F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")), "nodes")
    first = sketch.select(F.col("_row").alias("_node"), "_bands", "_n").join(nodes.select("_node"), "_node", "left_semi")
    members = materialise(first.select("_node", "_n", F.explode("_bands").alias("_band")), "bands")
    buckets = members.groupBy("_band").agg(F.min("_node").alias("_leader"), F.count(F.lit(1)).alias("_members")).where("_members > 1")
    every, buckets = members, materialise(buckets, "buckets")
    members = materialise(spread_join(every, buckets, "_band", "_members", "_node").drop("_members"), "candidates")
    discard(every, buckets)

    named = members.select("_node").distinct().join(nodes.select("_node", "_print"), "_node")
    wanted = named.join(sketch.select(F.col("_row").alias("_node"), "_key"), "_node").select("_node", F.col("_print").alias("_want"), "_key")
    # at its own size the text moves once, for candidates only
    texts = keyed.select("_key", "_t").join(wanted, "_key").select("_node", "_want", "_t")
    sets = materialise(texts.mapInArrow(_shingler(shingle, weighted), "_node long, _set array<int>").dropDuplicates(["_node"]), "sets")

    # every member against the least of its band
    pairs = members.where("_node != _leader").select(F.col("_leader").alias("_a"), F.col("_node").alias("_b")).distinct()
    of = lambda n: sets.select(F.col("_node").alias(f"_{n}"), F.col("_set").alias(f"_s{n}"))
    led = of("a").join(pairs.groupBy("_a").agg(F.count(F.lit(1)).alias("_led")), "_a")
    both = spread_join(pairs.join(of("b"), "_b"), led, "_a", "_led", "_b")
    measured = both.select("_a", "_b", F.size(F.array_intersect("_sa", "_sb")).alias("_common"), (F.size("_sa") + F.size("_sb")).alias("_both"))
    alike = F.col("_common") >= similarity * (F.col("_both") - F.col("_common")) - 1e-6
    edges = materialise(measured.where(alike).select("_a", "_b"), "edges")
    labels = components(edges)

    # bands that still hold several classes: all pairs of different classes, block against block
    placed = members.join(labels, "_node", "left").select("_band", "_node", "_n", F.coalesce("_comp", "_node").alias("_comp"))
    mixed = placed.groupBy("_band").agg(F.count(F.lit(1)).alias("_size"), F.sum("_n").alias("_shingles"), F.min("_comp").alias("_x"), F.max("_comp").alias("_y")).where("_x != _y")
    rows_of = F.greatest(F.lit(BLOCK_ROWS), F.least(F.lit(MOST_BLOCK_ROWS), F.floor(F.col("_size") / 16)))
    blocks = F.ceil(F.greatest(F.col("_size") / rows_of, F.col("_shingles") / BLOCK_SHINGLES)).cast("int")
    mixed = materialise(mixed.select("_band", "_size", blocks.alias("_blocks")), "mixed-bands")
    dealt = spread_join(placed, mixed, "_band", "_size", "_node").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    dealt = dealt.join(sets, "_node").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    units = dealt.select("_band", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_block", "_node", "_comp", "_set")
    units = units.repartition("_band", "_i", "_j").sortWithinPartitions("_band", "_i", "_j")
    more = materialise(units.mapInArrow(_swept(similarity), "_a long, _b long").distinct(), "more-edges")
    discard(mixed, sets, members)
    if not more.isEmpty():
        first, labels = labels, components(materialise(edges.union(more), "edges"))
        discard(first)
    classed = nodes.join(labels, "_node", "left").withColumn("_comp", F.coalesce("_comp", "_node"))
    least = classed.groupBy("_comp").agg(F.count(F.lit(1)).alias("_nodes"), F.min("_first").alias("_class"), F.sum("_rows").alias("_size"), F.min(F.struct(F.col("_first").isNull(), "_first", "_node")).alias("_best"))
    whole = spread_join(classed, materialise(least, "classes"), "_comp", "_nodes", "_node")
    whole = materialise(whole.select("_print", "_rows", "_node", "_class", "_size", F.col("_best._node").alias("_stay"), "_first"), "node-classes")
    # of the node that stays, its first row with the least id
    out = spread_join(sketch.select("_row", "_id", "_n", "_print", "_key"), whole, "_print", "_rows", "_row")
    lead = out.where((F.col("_node") == F.col("_stay")) & F.col("_id").eqNullSafe(F.col("_first"))).groupBy("_node").agg(F.min("_row").alias("_row")).select("_row", F.lit(True).alias("_kept"))
    return out.join(lead, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_class").alias("class_id"), F.col("_size").cast("long").alias("class_size"), F.col("_n").alias("n_shingles"), F.coalesce("_kept", F.lit(False)).alias("kept"), "_key",
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = textnp.SHINGLE,
    coordinates: int = COORDINATES,
    rows_a_band: int = BAND_ROWS,
    weighted: bool = False,
) -> DataFrame:
    """The class of near-duplicates of every row.

    Texts are sets of shingles of five words (lower-case runs of letters, digits, underscores and
    whatever is beyond ASCII); with ``weighted`` they are bags, weighted by counts. Rows of equal
    sets are one node. Nodes that share a band of their dart signatures are candidates;
    links are candidates whose (weighted) Jaccard similarity, counted on 32-bit hashes of the
    shingles, is ``similarity`` or more; classes are the connected components of the links. With 32 bands of 4
    the chance to miss a link of exactly 0.8 is 5e-8.

    Not all pairs of a band are looked at: each member is held against the least one of the band.
    Where a band then still holds several classes, its members are dealt into blocks (a sixteenth of the band, 512 rows at least, 2,048 and two million shingles
    at most), and two blocks at a time meet in a task that multiplies their 0/1 matrices and returns
    as many links as join the classes that are alike. What is skipped are pairs already in one class; no pairs are
    emitted but links, and no task holds more than two blocks. A band of n rows that are not alike is thus copied 16 times, or n / 2,048 times if that is more.
    Bands, leaders, classes and equal sets that a large part of all rows share are joined in parts.

    Returns one row per input row: id, class_id (least id of the class), class_size, n_shingles,
    kept (one row of the class: of least id, repeated rows once). Null text is empty; texts without words are one class. Null
    ids sort after others; identifiers may be of any type that has an order. Other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    return _classes(docs, id_col, text_col, similarity, shingle, coordinates, rows_a_band, weighted).drop("_key")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that :func:`near_duplicates` keeps, with all their columns; of rows that repeat, one."""
    kept = _classes(docs, id_col, text_col, **options).where("kept").select("_key")
    plain, own = numbered(docs)
    keyed = plain.withColumn("_key", F.xxhash64(F.col(own[id_col]), F.coalesce(F.col(own[text_col]), F.lit(""))))
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key", own[id_col]]).select(*(F.col(c).alias(name) for name, c in own.items()))


def op3_dart_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, by bags of shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), weighted=True)
