"""Exact deduplication, sharding and mixing against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorframe.llm import exact_dedup, mixing, sharding

ROWS = [(i, "hot text") for i in range(200)] + [(500 + i, f"text {i % 40}") for i in range(90)] + [(700, None), (701, ""), (702, "É"), (703, "é"), (702, "É"), (None, "É"), (None, None), *[(None, "no id")] * 30, *[(9, "hot text")] * 20, (704, "x " * 20000)]


@pytest.mark.parametrize("keep, cell_rows", [("min", 7), ("max", 7), ("max", 256), ("min", 1)])
def test_exact_groups(spark, keep, cell_rows):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in ROWS], "doc_id long, text string, keep_id string, _p int").repartition(7)
    out = exact_dedup.exact_dedup(docs, keep=keep, partitions=9, cell_rows=cell_rows).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    want = {h: (min if keep == "min" else max)((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    assert len(out) == len(ROWS)
    for r in out:
        assert r["keep_id"] == want[r["text_sha256"]] and r["group_size"] == len(groups[r["text_sha256"]])
    kept = Counter(r["text_sha256"] for r in out if r["kept"])
    assert kept == {h: 1 for h in groups}
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_exact_normalised_and_empty(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id long, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_dedup(docs, normalise=F.lower).collect()} == {1}
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_shards_are_exact_and_hold_every_row(spark):
    docs = spark.createDataFrame([(i, t, "own", 3, 4, 5) for i, t in ROWS], "doc_id long, text string, shard string, slot int, _slice int, _n int")
    out = sharding.shard(docs, shards=7, rows_a_slice=20).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(ROWS)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    for r in out:
        data = (r["text"] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "rows" and r["grown_shard"] is None
    assert sharding.shard(docs.limit(0)).count() == 0
    few = sharding.shard(docs.limit(3), shards=7).collect()
    assert len({r["shard"] for r in few}) == 3


def test_shuffle_looks_uniform(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.shard(docs, shards=8).toPandas()
    low = out[out.doc_id < 2000].groupby("shard").size()
    assert abs(low - 250).max() < 60
    assert abs(np.corrcoef(out.doc_id, out.slot)[0, 1]) < 0.06


def test_matrix_margins():
    m = sharding.communication_matrix([5, 0, 17, 9, 1], 4, 3)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 9, 1] and m.sum(axis=0).tolist() == [8, 8, 8, 8] and (m >= 0).all()
    draws = np.array([sharding.communication_matrix([6, 6], 2, s)[0, 0] for s in range(400)])
    assert abs(draws.mean() - 3) < 0.2 and abs(draws.var() - 6 * 0.25 * 6 / 11) < 0.25


def edf(share):
    """One slot at a time: the released block that is due first."""
    q, done, out = sum(share), [0] * len(share), []
    for t in range(q):
        ready = [(-(-(done[i] + 1) * q // a), i) for i, a in enumerate(share) if done[i] < a and done[i] * q // a <= t]
        _, i = min(ready)
        done[i] += 1
        out.append(i)
    return out


@pytest.mark.parametrize("share", [[1], [3, 5], [1, 1, 1], [64, 2, 2, 1, 31], [7, 11, 13, 97]])
def test_period_is_edf_and_within_a_block(share):
    got = mixing.pfair_period(share)
    assert got == edf(share)
    done = np.zeros(len(share))
    for t, i in enumerate(got, 1):
        done[i] += 1
        assert (abs(done - np.array(share) * t / sum(share)) < 1).all()


def test_mix_keeps_rows_and_weights(spark):
    rows = [(i, "a") for i in range(300)] + [(1000 + i, "b") for i in range(90)] + [(2000 + i, None) for i in range(25)] + [(None, "b"), (1000, "b")]
    docs = spark.createDataFrame([(i, s, 1, 2) for i, s in rows], "doc_id long, source string, _index int, _order int").repartition(5)
    out = mixing.mix_sources(docs, weights={"a": 0.5, "b": 0.3, None: 0.2}, block_rows=4).collect()
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter(rows)
    out.sort(key=lambda r: r["mix_position"])
    assert [r["mix_position"] for r in out] == list(range(len(rows)))
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in out)
    slots = [s for s, _ in heapq.merge(sorted({(r["mix_slot"], r["source"] or "") for r in out}))]
    assert slots == list(range(len(slots)))
    end = max(r["mix_slot"] for r in out if r["source"] is None)
    done = Counter()
    of = {r["mix_slot"]: r["source"] for r in out}
    for t in range(end + 1):
        done[of[t]] += 1
        assert all(abs(done[s] - w * (t + 1)) < 1 for s, w in (("a", 0.5), ("b", 0.3), (None, 0.2)))
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.in_mixed_order(docs).columns == docs.columns
    wide = mixing.mix_sources(docs, block_rows=1, most_blocks=40).collect()
    assert sorted(r["mix_position"] for r in wide) == list(range(len(rows))) and max(r["mix_slot"] for r in wide) < 43


def test_schedule_keeps_exact_weights_over_many_blocks():
    rng = np.random.default_rng(4)
    for weights in ([1.0] * 20, rng.random(20).tolist(), [1.0] + [1e-4] * 50, [0.3, 0.3, 0.4, 0.0]):
        blocks = [3000 if w else 5 for w in weights]
        plan = mixing.schedule(blocks, weights)
        slots = {t: i for i, p in enumerate(plan) for t in p[0]}
        assert sorted(slots) == list(range(sum(blocks)))
        assert all(r <= t < d for p in plan for t, r, d in zip(*p[:3], strict=True))
        share, done = np.array(weights) / sum(weights), np.zeros(len(weights))
        for t in range(sum(blocks)):
            done[slots[t]] += 1
            assert (abs(done - share * (t + 1)) < 1 + 1e-6).all()
            if done[slots[t]] == blocks[slots[t]]:
                break
    for bad in ([-1.0, 1.0], [float("nan"), 1.0]):
        with pytest.raises(ValueError):
            mixing.schedule([1, 1], bad)
    assert [p[0] for p in mixing.schedule([2, 2], [0.0, 0.0])] == [[0, 2], [1, 3]]


def test_equal_rows_are_spread(spark):
    docs = spark.createDataFrame([(None, "", None)] * 900 + [(1, "x", "s")] * 100, "doc_id long, text string, source string").repartition(3)
    out = sharding.shard(docs, shards=5, rows_a_slice=30).toPandas()
    assert out.groupby("shard").size().tolist() == [200] * 5 and (out[out.doc_id.notna()].groupby("shard").size() > 5).all()
    assert sorted(r["mix_position"] for r in mixing.mix_sources(docs).collect()) == list(range(1000))


def test_shards_in_the_order_of_the_table(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("_place"), F.lit(2).alias("_row"))
    path = str(tmp_path / "ordered")
    docs.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id").write.option("maxRecordsPerFile", 200).parquet(path)
    for frame, stored in ((spark.read.parquet(path), True), (docs, False)):
        out = sharding.shard(frame, shards=4, in_order=True, stored=stored, rows_a_slice=100).toPandas()
        assert out.columns[:4].tolist() == docs.columns and out.groupby("shard").size().tolist() == [750] * 4
        for _, part in out.groupby("shard"):
            part = part.sort_values("slot")
            assert part.slot.tolist() == list(range(750)) and part.doc_id.is_monotonic_increasing
