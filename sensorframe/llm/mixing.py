"""Interleaving sources at target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROWS_A_SLICE, numbered, ranked, table, uniform, width, with_rows

#: Least rows of a block, and most blocks of a mix, about: beyond, blocks grow, so that the schedule of all blocks has a bounded size.
BLOCK_ROWS, MOST_BLOCKS = 16, 1 << 20
#: Weights count in whole parts, the largest having so many.
PARTS = 1 << 40


def edf(share: list[int]) -> Iterator[tuple[int, int, int]]:
    """The source, release and deadline of each slot in turn, without end, for whole shares.

    Block j (from 0) of a source with share a of a total q is released at floor(j q / a) and due by
    ceil((j+1) q / a); each slot goes to the released block that is due first. Every block runs within its
    window, so after any slot a source is less than one block from its share.
    """
    q = sum(share)
    waiting = [(0, i, 0) for i in range(len(share))]  # release, source, block
    ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * q // share[i]), i, j, release))
        due, i, j, release = heapq.heappop(ready)
        yield i, release, due
        heapq.heappush(waiting, ((j + 1) * q // share[i], i, j + 1))
        t += 1


def pfair_period(share: list[int]) -> list[int]:
    """Which source has each slot of a period of ``sum(share)`` slots; at its end every source has had its share."""
    return [i for i, _, _ in islice(edf(share), sum(share))]


def schedule(blocks: list[int], weights: list[float]) -> list[tuple[list[int], list[int], list[int], list[float]]]:
    """Slots, releases, deadlines and shares of the blocks of every source.

    A phase ends with the slot in which a source runs out; those left begin a new one by their weights. Sources of weight 0 come
    when all others have run out, and share alike. No period repeats: the schedule is of all blocks by weights exact to a part in 2^40, so
    no error adds up.
    """
    if any(not math.isfinite(w) or w < 0 for w in weights):
        raise ValueError("weights are finite and not negative")
    out: list[tuple[list[int], list[int], list[int], list[float]]] = [([], [], [], []) for _ in blocks]
    slot = 0
    while on := [i for i, n in enumerate(blocks) if len(out[i][0]) < n]:
        on = [i for i in on if weights[i] > 0] or on
        top = max(weights[i] for i in on) or 1.0
        share = [max(1, round(weights[i] / top * PARTS)) for i in on]
        total, begin = sum(share), slot
        for x, release, due in edf(share):
            i = on[x]
            for column, value in zip(out[i], (slot, begin + release, begin + due, share[x] / total), strict=True):
                column.append(value)
            slot += 1
            if len(out[i][0]) == blocks[i]:
                break
    return out


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    most_blocks: int = MOST_BLOCKS,
    seed: int = 23,
    stored: bool = False,
) -> DataFrame:
    """Add to every row its place in a mix that keeps to the target weights.

    ``weights`` maps sources to target weights; without it they are the row counts to the power
    ``temperature``; a source not named has the least weight named; weights may not be negative. Rows of a source are put in a random order and cut into blocks of
    ``block_rows``, or more where that would make over ``most_blocks`` blocks. Blocks are scheduled by earliest deadline within Pfair windows: while no
    source has run out, each has had its share of the slots up to less than one block; then the
    others share by their weights. The driver holds a number a source and the slots of all blocks, ``most_blocks`` and one a source at most;
    every row finds its slot by itself.

    Adds mix_block, mix_release, mix_deadline, mix_slot, mix_share (of slots, in its phase) and
    mix_position (gapless from 0). No row is dropped or repeated. A null source is a source; null ids and repeated rows
    are rows like others, drawn by their place; columns of these names are replaced; an empty table gives an empty result. ``stored`` says that ``docs`` reads
    files as they are; any other frame is written first.
    """
    spark = docs.sparkSession
    added = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_share", "mix_position"]
    plain, own = numbered(docs)
    plain = with_rows(plain, stored)
    source = F.col(own[source_col])
    sizes = sorted(((r["_source"], r["n"]) for r in plain.groupBy(source.alias("_source")).agg(F.count(F.lit(1)).alias("n")).collect()), key=lambda x: (x[0] is None, str(x[0])))
    total = sum(n for _, n in sizes)
    block_rows = max(block_rows, -(-total // most_blocks))
    blocks = [-(-n // block_rows) for _, n in sizes]
    least = min(weights.values()) if weights else 0
    plan = schedule(blocks, [weights.get(s, least) if weights else n**temperature for s, n in sizes])

    rows_of = np.zeros(sum(blocks), dtype=np.int64)  # rows of each slot
    for (_, n), (slots, *_rest) in zip(sizes, plan, strict=True):
        rows_of[slots] = block_rows
        rows_of[slots[-1]] -= -n % block_rows
    start = np.cumsum(rows_of) - rows_of
    each = max(1, min(ROWS_A_SLICE, -(-total // width(spark))))
    slices = [-(-n // each) for _, n in sizes]
    base = np.cumsum([0, *slices])[:-1].tolist() if sizes else []
    kind = docs.schema[source_col].dataType.simpleString()
    cells = spark.createDataFrame([(s, k, base[k], slices[k]) for k, (s, _) in enumerate(sizes)], f"_of {kind}, _k int, _base int, _slices int")
    column = lambda x, of: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *blocks]), pa.int32()), pa.array(np.concatenate([*(np.asarray(p[x]) for p in plan), np.zeros(0)]), of))
    arrays = {"_key": pa.array(np.arange(len(sizes)), pa.int32()), "_slot": column(0, pa.int64()), "_release": column(1, pa.int64()), "_due": column(2, pa.int64()), "_share": column(3, pa.float64())}
    starts = pa.ListArray.from_arrays(arrays["_slot"].offsets, pa.array(start[arrays["_slot"].values.to_numpy()] if len(start) else start, pa.int64()))
    places = spark.createDataFrame(pa.table(arrays | {"_start": starts}))

    sliced = plain.withColumn("_order", uniform(F.col("_row"), seed=seed)).join(F.broadcast(cells), source.eqNullSafe(F.col("_of")))  # a row a source
    cell = F.col("_base") + F.least(F.floor(F.col("_order") * F.col("_slices")), F.col("_slices") - 1)
    groups = [k for k, n in enumerate(slices) for _ in range(n)] or [0]
    placed = ranked(sliced.withColumn("_cell", cell).drop("_of", "_base", "_slices"), F.col("_cell"), groups, ["_order", "_row"], "_index")
    block = F.floor(F.col("_index") / block_rows).cast("int")
    of = lambda c: F.get(F.col(c), block)
    # five numbers a block
    return placed.join(F.broadcast(places), F.col("_k") == F.col("_key")).select(
        *(F.col(c).alias(name) for name, c in own.items() if name not in added),
        block.cast("long").alias("mix_block"), of("_release").alias("mix_release"), of("_due").alias("mix_deadline"), of("_slot").alias("mix_slot"), of("_share").alias("mix_share"),
        (of("_start") + F.col("_index") % block_rows).cast("long").alias("mix_position"),
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows in the order of :func:`mix_sources`: partition after partition, row after row; so a table written from it keeps the mix in the order of its files."""
    mixed = mix_sources(docs, **options)
    plain, own = numbered(mixed)
    parts = width(docs.sparkSession)
    total = docs.count()
    part = F.floor(F.col(own["mix_position"]) * parts / max(total, 1)).cast("int")
    ordered = plain.withColumn("_part", part).repartitionById(parts, F.col("_part")).sortWithinPartitions(own["mix_position"])
    return ordered.select(*(F.col(own[c]).alias(c) for c in docs.columns if c in own))


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mix of the sources by the square root of their size."""
    mixed = mix_sources(table(spark, sf_dir, "documents"), stored=True)
    return mixed.select("doc_id", "source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_share", "mix_position")
