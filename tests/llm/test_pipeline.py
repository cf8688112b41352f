"""The corpus pipeline on the smallest tables, stage by stage against brute force."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from sensorframe.llm.common import materialise, table
from sensorframe.llm.mixing import mix_sources
from sensorframe.llm.sharding import with_place
from tests.llm.test_near_dup import bag, classes, shingles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="no test tables")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, [docs.count()]
    items = [shingles(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        assert all(after[i][c] == before[i][c] for i in after for c in columns)
        kept.append(len(rows))
        if name == "near-dedup":
            assert set(after) == set(classes([(i, r["text"]) for i, r in before.items()], bag).values())
        if name == "decontamination":
            held = {i for i, r in before.items() if any(len(s & shingles(r["text"])) >= 0.8 * len(s) for s in items if s)}
            assert held and set(before) - set(after) == held
        if name in ("mixing", "sharding"):
            assert set(after) == set(before)
        if name != "sharding":
            assert docs.columns == columns
        if name == "mixing":
            mixed = [r["doc_id"] for r in with_place(docs).orderBy("_place").collect()]
            places = {r["doc_id"]: r["mix_position"] for r in mix_sources(table_before, stored=True).collect()}
            assert mixed == sorted(places, key=places.get) and mixed != sorted(mixed)
        table_before = docs
    place = {i: n for n, i in enumerate(mixed)}
    for s in range(24):  # the mix decides the order of every shard
        own = sorted((r["slot"], place[r["doc_id"]]) for r in rows if r["shard"] == s)
        assert [x for x, _ in own] == list(range(len(own))) and [p for _, p in own] == sorted(p for _, p in own)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert kept[0] > kept[1] > kept[2] > kept[3] == kept[4] == kept[5]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(after)


def test_nulls_repeated_rows_and_other_columns(spark, tmp_path):
    docs = table(spark, SF, "documents").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (None, "you idiot scum, you moron " * 3, None, "web", 1), (10**9, "", "en", None, 0), (10**9, "", "en", None, 0), (10**9 + 1, "word " * 200_000, "en", "web", 1)], docs.schema)
    more = docs.unionByName(odd).unionByName(docs.limit(20)).selectExpr("*", "1 AS _row", "'x' AS shard", "2 AS _key", "3 AS mix_position", "4 AS _place", "'y' AS _t")
    path = str(tmp_path / "odd")
    more.repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = materialise(stage(spark, docs, SF), "test-odd")
        assert 0 < docs.count() <= before
        if name != "sharding":
            assert docs.columns == columns
        if name in ("mixing", "sharding"):
            assert docs.count() == before
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(10**9) <= 1 and len(ids) == len(set(ids)) and "slot" in docs.columns and docs.where("shard BETWEEN 0 AND 23").count() == len(ids)


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
