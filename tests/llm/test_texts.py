"""Scores, secrets and decontamination on small fixtures, against brute force or held-out rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorframe.llm import class_lm, decontamination, gbt, quality, secrets, textnp, toxicity
from sensorframe.llm.common import remainder

DOCS = "doc_id long, text string, lang string, source string"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def test_words_against_regex():
    rng = random.Random(2)
    texts = ["", None, "a", "  ", "Ab,cd\tEF-é_1", "x" * 3000] + ["".join(rng.choice("aB1 ,.\n\té|_") for _ in range(rng.randrange(60))) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"]).slice(1)
    got = {}
    for i, j, data, offsets in textnp.chunks(batch, "t"):
        code, row, start, end = textnp.words(data, offsets)
        for c, r, s, e in zip(code, row, start, end, strict=True):
            got.setdefault(i + r, []).append((int(c), bytes(data[s:e]).decode()))
    one = {}
    for i, t in enumerate(texts[1:]):
        found = re.findall(r"[0-9A-Za-z_\u0080-\U0010ffff]+", t or "")
        assert [w for _, w in got.get(i, [])] == found
        for c, w in got.get(i, []):
            assert one.setdefault("".join(x.lower() if x < "\x80" else x for x in w), c) == c
    assert len(set(one.values())) == len(one)


def test_long_words_hash_by_every_byte():
    fill = "x" * 1023
    texts = ["b" + fill + "c" + fill, "c" + fill + "b" + fill, "b" + "x" * ((1 << 20) - 1) + "c", "c" + "x" * ((1 << 20) - 1) + "b", "y" * 5000, "y" * 5001]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    codes = np.concatenate([textnp.words(data, offsets)[0] for _, _, data, offsets in textnp.chunks(batch, "t")])
    assert len(codes) == len(texts) == len(set(codes.tolist()))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(1200):
        text, toxic, bad = words(rng, rng.randrange(20, 120)), rng.random() < 0.2, rng.random() < 0.3
        parts = text.split()
        if toxic:
            for _ in range(4):
                parts.insert(rng.randrange(len(parts)), rng.choice(["idiot", "scum", "brzk" + rng.choice("abc"), "you moron"]))
        text = " ".join(parts)
        rows.append((i, " | ".join(text.split()) if bad else text + ".", "en", "s"))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(5000, None, None, None), (5001, "", "en", "s"), (None, "you idiot scum", "en", "s"), (5002, "y " * 30000, "en", "s"), (0, rows[0][1], "en", "s")]
    labels += [(5001, None, None), (None, 1, 1), (0, 1, 0)]
    return rows, labels


def accuracy(spark, labelled, fit, score, column, mod, left):
    docs, labels = spark.createDataFrame(labelled[0], DOCS), spark.createDataFrame(labelled[1], "doc_id long, quality int, toxic int")
    model = fit(docs, labels, remainder("doc_id", mod) != left)
    out = score(docs.withColumn("score", F.lit("own")), model).collect()
    assert len(out) == len(labelled[0]) and all(0 <= r["score"] <= 1 for r in out)
    truth = {i: (q, t)[column == "toxic"] for i, q, t in labelled[1]}
    held = [(r["score"] >= 0.5) == truth[r["doc_id"]] for r in out if r["doc_id"] is not None and truth.get(r["doc_id"]) is not None and zlib.crc32(str(r["doc_id"]).encode()) % mod == left]
    return np.mean(held), docs, model


def test_toxicity_on_held_out_rows(spark, labelled):
    share, docs, model = accuracy(spark, labelled, toxicity.fit_toxicity, toxicity.toxicity_scores, "toxic", 4, 2)
    assert share > 0.97
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()}
    assert {5000, 5001, 5002} <= kept and None not in kept
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark, labelled):
    share, docs, model = accuracy(spark, labelled, quality.fit_quality, quality.quality_scores, "quality", 3, 1)
    assert share > 0.97
    assert quality.quality_scores(docs.limit(0), model).count() == 0


def test_without_labels(spark, labelled):
    docs, none = spark.createDataFrame(labelled[0][:20], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r["score"], 6) for r in quality.quality_scores(docs, quality.fit_quality(docs, none, F.lit(True))).collect()} == {0.5}
    assert {round(r["score"], 6) for r in toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, none, F.lit(True))).collect()} == {0.5}


def test_trees_walk_as_fitted_and_isotonic_rises():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = gbt.fit(x, y, trees=30)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    for row in range(5):
        total = trees.start
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(x[row, trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.value[t, node]
        assert abs(total - trees.margin(x[row : row + 1])[0]) < 1e-9
    s = rng.random(500)
    cal = gbt.isotonic(s, (rng.random(500) < s**2).astype(float))
    grid = cal(np.linspace(0, 1, 200))
    assert (np.diff(grid) >= -1e-12).all() and abs(grid - np.linspace(0, 1, 200) ** 2).mean() < 0.08


def test_class_lm_base_and_totals(spark):
    rng = random.Random(4)
    texts = [words(rng, rng.randrange(1, 60), 300) + rng.choice(["", " New" + str(rng.randrange(900))]) for _ in range(300)] + ["", None, "\x0b\x0c ", "Wörd W1 w1"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "w1 w2", "en", "s"), (3, texts[3], "en", "s")]
    out = class_lm.class_lm_scores(spark.createDataFrame(rows, DOCS).repartition(4), remainder("doc_id", 10) != 0, single=20, classes=6, head=40).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t or "")) + [None]
    count = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            count.update(split(t))
    n, v = sum(count.values()), len(count)
    want = Counter((i, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t)), 5), len(split(t)), sum(count[w] > 0 for w in split(t))) for i, t, *_ in rows)
    assert Counter((r["doc_id"], round(r["base_score"], 5), r["n_tokens"], r["n_known"]) for r in out) == want
    assert {r["train_tokens"] for r in out} == {n} and all(r["score"] < 0 for r in out)
    assert class_lm.class_lm_scores(spark.createDataFrame([], DOCS), F.lit(True)).count() == 0


def test_scores_against_a_brute_force_model_of_one_class(spark):
    rng = random.Random(11)
    texts = [words(rng, rng.randrange(0, 40), 60) + rng.choice(["", " rare" + str(rng.randrange(500)), " q" * 3]) for _ in range(300)] + ["w1 " * 30000, "", None, "unheard of WORDS here"]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, rare int, _row int").repartition(3)
    out = {r["doc_id"]: r["score"] for r in class_lm.class_lm_scores(docs, remainder("doc_id", 10) != 0, single=10, classes=2, head=25).collect()}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    shape = {}
    for t in texts:
        batch = pa.RecordBatch.from_arrays([pa.array([t or ""])], ["t"])
        for _, _, data, offsets in textnp.chunks(batch, "t"):
            shape |= dict(zip(split(t), (int(c) & 255 for c in class_lm.tokens(data, offsets)[0]), strict=True))
    train = [split(t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for t in train for w in t)
    g = np.zeros((2, 2))
    for t in train:
        cls = [0, *[1] * len(t), 0]
        for a, b in zip(cls, cls[1:], strict=False):
            g[a, b] += 1
    share = g.sum(axis=0)
    prior = (share + 0.5) / (share.sum() + 1)
    transition = (g + 5 * prior) / (g.sum(axis=1, keepdims=True) + 5)
    n1, n2, total = (sum(n == x for n in count.values()) for x in (1, 2, -1))
    total = sum(count.values())
    d = min(0.9, max(0.1, (n1 + 0.5) / (n1 + 2 * n2 + 1)))
    weight = np.full(class_lm.SHAPES, 0.5)
    for w, n in count.items():
        weight[shape[w]] += (n == 1) + 1e-3
    unseen = d * len(count) / total * weight / weight.sum()
    assert abs(sum((n - d) / total for n in count.values()) + unseen.sum() - 1) < 1e-9 and np.allclose(transition.sum(axis=1), 1)
    for i, t in enumerate(texts):
        cls = [0, *[1] * len(split(t)), 0]
        want = sum(math.log10(transition[a, b]) for a, b in zip(cls, cls[1:], strict=False)) + sum(math.log10((count[w] - d) / total if w in count else unseen[shape[w]]) for w in split(t))
        assert abs(out[i] - want) < 1e-6 * max(1, abs(want)), i


def test_class_bigrams_beat_the_base_where_order_matters(spark):
    rng = random.Random(9)
    line = lambda: " ".join(f"{k}{rng.randrange(12)}" for _ in range(20) for k in ("noun", "verb", "adj"))
    rows = [(i, line(), "en", "s") for i in range(400)]
    out = class_lm.class_lm_scores(spark.createDataFrame(rows, DOCS), remainder("doc_id", 10) != 0, single=60, classes=8).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
    per = lambda c: sum(r[c] for r in held) / sum(r["n_tokens"] for r in held)
    assert per("score") > per("base_score") + 0.4  # three classes in turn: log10(3) = 0.477


def test_rare_words_of_one_shape_get_classes_from_their_neighbours(spark):
    rng = random.Random(3)
    line = lambda: " ".join(w for _ in range(15) for w in ("aa", f"q{rng.randrange(100, 300)}z", "bb", f"q{rng.randrange(300, 500)}z"))
    docs = spark.createDataFrame([(i, line(), "en", "s") for i in range(400)], DOCS).repartition(3)
    scores = []
    for head in (100, 1000):  # where words meet their classes must not matter
        out = class_lm.class_lm_scores(docs, remainder("doc_id", 10) != 0, single=60, classes=6, head=head).collect()
        held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
        scores.append({r["doc_id"]: round(r["score"], 6) for r in out})
        # log10(200) for two tokens; one class for all rare words would cost log10(400) and log10(2)
        assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -1.25
    assert scores[0] == scores[1]


def test_default_classes_are_bounded(spark):
    docs = spark.createDataFrame([(i, "x", "y", f"a{i % 3} b{i % 5} c") for i in range(40)], "doc_id long, source string, lang string, text string")
    score = lambda **k: {r["doc_id"]: round(r["score"], 9) for r in class_lm.class_lm_scores(docs, remainder("doc_id", 10) != 0, **k).collect()}
    assert score(most_classes=4, single=5) == score(classes=4, single=5)


def test_exchange_finds_two_classes():
    pairs = np.zeros((9, 9))
    for a in range(1, 5):
        for b in range(5, 9):
            pairs[a, b] = pairs[b, a] = 10 + a * b % 7 + a
    cls = class_lm.exchange_classes(pairs, 3)
    assert cls[0] == 0 and len(set(cls[1:5])) == 1 and len(set(cls[5:])) == 1 and cls[1] != cls[5]


TABLE = [("assign", re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = [(m.start(), r, m.end(), k) for r, (k, p, g, least) in enumerate(TABLE) for m in p.finditer(text or "") if len(m[g]) >= least]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_secrets_against_regex_and_owners(spark):
    rng = random.Random(6)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    shared, pieces = "AKIA" + "Q7" * 10, ["secret=token:abcdef", 'Password = "abc"', "api_key: 'xyz-123.4'", "TOKEN=", "é" * 5, "\U0001f600", "AKIAAKIA" + "B" * 18, "passwd=====", "kKKey"]
    texts = [" ".join(rng.choice([*pieces, "w", hexa(23), hexa(24), hexa(50)]) for _ in range(rng.randrange(12))) for _ in range(150)]
    rows = [(i, t, "en", f"s{i % 5}") for i, t in enumerate(texts)] + [(900 + i, f"key {shared} here", "en", f"s{i}") for i in range(6)]
    rows += [(990, None, None, None), (991, "ghp_" + "Ab1" * 12, "en", "s1"), (992, "password=hunter2hunter2", "en", None), (3, texts[3], "en", "s3"), (None, "", "en", "s1")]
    out = secrets.scan_secrets(spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", spans string").repartition(3)).collect()
    assert len(out) == len(rows)
    want = Counter((i, tuple(base_spans(t))) for i, t, *_ in rows)
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["base"])) for r in out) == want
    of = {r["doc_id"]: r for r in out}
    assert {s["verdict"] for i in range(900, 906) for s in of[i]["spans"]} == {"example"}
    assert [(s["kind"], s["verdict"]) for s in of[991]["spans"]][0] == ("github", "live") and of[992]["spans"][0]["verdict"] == "live"
    assert all({(s["kind"], s["start"]) for s in r["base"]} <= {(s["kind"], s["start"]) for s in r["spans"]} for r in out)
    assert secrets.scan_secrets(spark.createDataFrame([], DOCS)).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_secrets_copied_by_a_crawl_stay_live_and_examples_are_kept(spark):
    forge, example = "ghp_" + "Ab1" * 12, "ghp_" + "Cd2" * 12
    rows = [(i, f"use {forge} now", "en", f"s{i}") for i in range(2)] + [(10 + i, f"use {example} now", "en", f"s{i}") for i in range(9)]
    of = {r["doc_id"]: [(s["kind"], s["verdict"], s["owners"]) for s in r["spans"] if s["kind"] == "github"] for r in secrets.scan_secrets(spark.createDataFrame(rows, DOCS)).collect()}
    assert of == {i: [("github", "live", 2)] for i in range(2)} | {10 + i: [("github", "example", 9)] for i in range(9)}


def test_secret_kinds_of_any_length(spark):
    t = lambda n: "aB3_" * (n // 4)
    cases = {
        "github": "x gho_" + "Ab1" * 200, "slack": "xoxb-123456789012-abc", "google": "AIza" + "Sy0-_" * 7, "jwt": "eyJ" + "a" * 500 + "." + "b" * 20 + "." + "c" * 900,
        "pem": "-----BEGIN RSA PRIVATE KEY-----\n" + "MIIE\n" * 300 + "-----END RSA PRIVATE KEY-----", "url": "redis://" + "u" * 300 + ":" + "p" * 400 + "@host", "mixed": "A" + "b" * 500 + "7",
    }
    rows = [(i, f"words é {text} end", "en", "s") for i, text in enumerate(cases.values())]
    rows += [(90, "http://:abc@h 1http://u:pw3@h", "en", "s"), (91, t(400000), "en", "s"), (92, "z" * 300000 + "://" * 9 + "-----BEGIN " * 2000, "en", "s"), (93, "eyJ" + "z" * 200000, "en", "s")]
    out = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(spark.createDataFrame(rows, DOCS)).collect()}
    for i, (kind, text) in enumerate(cases.items()):
        at = 8 + (2 if kind == "github" else len("redis") if kind == "url" else 0)
        end = 8 + (text.index("@") + 1 if kind == "url" else text.index("-----END") if kind == "pem" else len(text))
        found = [s for s in out[i] if s["kind"] == kind]
        assert [(s["start"], s["end"]) for s in found] == [(at, end)], kind
        assert len(found[0]["hash"]) == 64 and "value" not in found[0].asDict()
    assert [s["kind"] for s in out[90]] == ["url", "url"] and [(s["kind"], s["start"], s["end"]) for s in out[91]] == [("mixed", 0, 400000)] and out[92] == out[93] == []


def test_a_secret_of_most_rows(spark, monkeypatch):
    monkeypatch.setattr(secrets.spread_join, "__defaults__", (20,))
    rows = [(i, "password=everyone123 " + (f"token=own{i:05d}" if i % 3 == 0 else ""), "en", f"s{i % 7}") for i in range(300)]
    out = secrets.scan_secrets(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(300))
    for r in out:
        assert [s["verdict"] for s in r["spans"]] == ["example", *["live"] * (r["doc_id"] % 3 == 0)] and r["spans"][0]["owners"] == 7


def grams(text, k=5):
    w = re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("block", [2_000_000, 5])
def test_items_found_as_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "SHINGLES_A_BLOCK", block)  # held by workers, or met in joins
    rng = random.Random(8)
    items = [(i, words(rng, n, 5000)) for i, n in enumerate([5, 6, 8, 9, 13, 20, 21, 37, 60, 64, 65, 120, 300])] + [(50, None), (51, ""), (52, "two words"), (None, words(rng, 30, 5000))]
    rows = []
    for d in range(160):
        body = words(rng, rng.choice([30, 300, 3000]), 5000).split()
        own = (items[rng.randrange(13)][1] if d % 2 else items[-1][1]).split()
        for _ in range(rng.randrange(0, 1 + len(own) // 12)):
            own[rng.randrange(len(own))] = "changed"
        at = rng.randrange(len(body))
        rows.append((d, " ".join(body[:at] + own + body[at:]), "en", "s"))
    rows += [(900, None, "en", "s"), (901, "Two   WORDS", "en", "s"), (902, "two words more", "en", "s"), (None, items[5][1], "en", "s"), (0, rows[0][1], "en", "s")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", item_id int").repartition(4)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    sets = [(i, grams(t)) for i, t in items]
    want = Counter()
    for d, t, *_ in rows:
        g = grams(t)
        want.update((d, i) for i, s in sets if s and len(s & g) >= 0.8 * len(s))
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.find_test_items(docs, bench).collect())
    assert got == want and len(want) > 90
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, t, *_ in rows if not any(s and len(s & grams(t)) >= 0.8 * len(s) for _, s in sets))
    assert decontamination.find_test_items(docs, bench.limit(0)).count() == 0 == decontamination.find_test_items(docs.limit(0), bench).count()


@pytest.mark.parametrize("block", [2_000_000, 5])
def test_items_of_other_identifiers(spark, monkeypatch, block):
    rng = random.Random(3)
    items = [(f"i{i}", words(rng, 25, 5000)) for i in range(12)]
    monkeypatch.setattr(decontamination, "SHINGLES_A_BLOCK", block)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "z") for i, t in items] + [("x", words(rng, 40, 5000), "en", "s", 1, "z"), (None, None, None, None, None, None)], "doc_id string, text string, lang string, source string, _row int, _item string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_test_items(docs, bench).collect()} == {(i, i) for i, _ in items}
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {"x", None}


def test_filter_lets_its_values_through(spark, monkeypatch):
    value = textnp.mix(np.arange(5000, dtype=np.uint64))
    for most in (22, 28, 12):
        monkeypatch.setattr(decontamination, "MOST_FILTER_BITS", most)
        held = decontamination._filter(spark.createDataFrame(pa.table({"_v": pa.array(value[:2500].view(np.int64))})), 2500)
        assert decontamination._passes(value[:2500], held).all() and (most == 12 or decontamination._passes(value[2500:], held).mean() < 0.01)


def test_web_tokens_take_time_by_the_text_alone(spark):
    token = "eyJ" + "a" * 20 + "." + "b" * 20 + "." + "c" * 20
    rows = [(1, "eyJ" * 350_000, "en", "s"), (2, ("eyJ" * 4 + ".") * 60_000, "en", "s"), (3, f"x {token} y-{token}", "en", "s")]
    began = time.time()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "jwt"] for r in secrets.scan_secrets(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1] == [] and len(got[2]) == 20_000 and got[3] == [(2, 2 + len(token))]  # a token begins where a run begins
    assert time.time() - began < 60
