"""Near-duplicate classes against all pairs on small fixtures."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sensorframe.llm import near_dup, textnp


def shingles(text, k=5):
    words = re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def bag(text, k=5):
    """Shingles as elements of their own for every copy, so that sizes of common parts are sums of lesser counts."""
    words = re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [tuple(words)] if words else []
    seen = Counter()
    return {(g, seen.update([g]) or seen[g]) for g in grams}


def classes(rows, of=shingles):
    sets = {i: of(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y:
                a, b = sets[x], sets[y]
                if (not a and not b) or (a or b) and len(a & b) >= 0.8 * len(a | b):
                    p, q = sorted((find(x), find(y)))
                    root[q] = p
    return {i: find(i) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture()
def rows():
    rng = random.Random(3)
    out = []
    for g in range(6):
        base = [f"w{g}_{rng.randrange(900)}" for _ in range(60 + 60 * g)]
        for _ in range(25):
            out.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 22)))
    out += ["", None, "   ", "Two words", "two  WORDS!", "other words", "one " * 3000, "é ü ñ"]
    rng.shuffle(out)
    return list(enumerate(out))


def test_classes_equal_those_of_all_pairs(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs).collect()}
    want = classes(rows)
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert len(set(want.values())) > 12
    assert {i for i, r in got.items() if r["kept"]} == set(want.values())


def test_classes_of_bags_and_hot_keys(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 7)
    monkeypatch.setattr(near_dup.spread_join, "__defaults__", (3,))  # whatever has more than three rows is joined in parts
    line = "alpha beta gamma delta epsilon zeta eta theta "
    more = [t for _, t in rows] + [line * n for n in (10, 11, 12, 20, 30, 33)] + [line * 40] * 9
    docs = spark.createDataFrame([(f"d{i:03d}", t) for i, t in enumerate(more)], "doc_id string, text string").repartition(5)
    for weighted, of in ((True, bag), (False, shingles)):
        got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs, weighted=weighted).collect()}
        assert got == classes([(f"d{i:03d}", t) for i, t in enumerate(more)], of)


def test_kept_rows_and_extra_columns(spark, rows):
    again = [(i, t, "a", 1, 2) for i, t in rows[:40]] + [(rows[0][0], rows[0][1], "a", 1, 2), (None, "null id " * 9, None, None, None)]
    docs = spark.createDataFrame(again, "doc_id long, text string, class_id string, kept int, _key int")
    out = near_dup.keep_one_of_each(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    want = set(classes(rows[:40]).values()) | {None}
    assert len(ids) == len(set(ids)) and set(ids) == want


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_weighted_bags(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta "
    docs = spark.createDataFrame([(1, line * 10), (2, line * 11), (3, line * 30)], "doc_id long, text string")
    of = lambda w: {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs, weighted=w).collect()}
    assert of(False) == {1: 1, 2: 1, 3: 1}
    assert of(True) == {1: 1, 2: 1, 3: 3}


def test_dart_signatures_agree_as_weighted_jaccard():
    rng = np.random.default_rng(5)
    element = textnp.mix(np.arange(60, dtype=np.uint64))
    for _ in range(6):
        a, b = rng.uniform(0, 3, 60), rng.uniform(0, 3, 60)
        keep = rng.random(60) < 0.7
        b = np.where(keep, a, b)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        sig = near_dup.dart_minhash(np.tile(element, 2), np.repeat([0, 1], 60), np.concatenate([a, b]), 2, k=2048)
        assert np.isfinite(sig).all()
        assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(1000, 1001)], "_a long, _b long")
    got = {r["_node"]: r["_comp"] for r in near_dup.components(edges).collect()}
    assert {got[i] for i in range(n)} == {0} and got[1001] == 1000
