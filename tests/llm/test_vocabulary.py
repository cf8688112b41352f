"""Spelling variants, divergence of sources and token counts on small fixtures, against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sensorframe.llm import divergence, spelling, token_counts

DOCS = "doc_id long, text string, lang string, source string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_hand(rows) -> dict:
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    form, close = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        close[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], close[w], n[form[w]] if form[w] else None)
    return out


def spelled(rng, n):
    out = []
    for _ in range(n):
        w = list("".join(rng.choice("abÀé÷") for _ in range(rng.randrange(4, 9))))
        out.append("".join(w))
    return out


def variants(frame, **options) -> dict:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(frame, **options).collect()}


def test_spelling_against_all_pairs(spark):
    rng = random.Random(5)
    base = spelled(rng, 300)
    pick = lambda: base[min(int(rng.expovariate(0.02)), len(base) - 1)]
    rows = [(i if i % 7 else None, rng.choice([" ", "-", "1", "œ"]).join(pick().upper() if rng.random() < 0.2 else pick() for _ in range(rng.randrange(60)))) for i in range(150)]
    long = "z" * 300
    rows += [(900 + k, f"{long} {long}y {long[:-1]}x {'q' * 70}{'w' * k}") for k in range(4)] + [(5, None), (6, ""), (7, "a b cd"), (8, "ab" * 40), (8, "ab" * 40)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, word int").repartition(3)
    want = by_hand(rows)
    assert len(want) > 100 and sum(v[0] is not None for v in want.values()) > 30 and any(want[v[0]][0] for v in want.values() if v[0])
    assert variants(frame) == want
    # blocks of few words: several rounds of cuts, also where words share long parts
    assert variants(frame, block_words=4, most_words=8) == want


def test_each_near_pair_is_in_one_block(spark):
    rng = random.Random(11)
    words = sorted({"pre" + "".join(rng.choice("ab") for _ in range(rng.randrange(4, 9))) for _ in range(400)} | {"".join(rng.choice("xyz") for _ in range(5)) for _ in range(100)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    members = defaultdict(list)
    for r in spelling.blocks(frame, 5, 9).collect():
        members[(r["s"], r["lo"], r["hi"], r["part"])].append(r["word"])
    seen = Counter()
    for (s, lo, hi, _), own in members.items():
        a, b = spelling.near_pairs(own, s, lo, hi)
        seen.update((own[x], own[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True))
    assert seen == Counter({(a, b): 1 for a in words for b in words if near(a, b)})
    assert max(len(own) for (_, lo, hi, _), own in members.items() if hi - lo > 1) <= 9


def test_checksums_advance_together():
    rng = random.Random(3)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 5, 63, 64, 65, 200]))) for _ in range(300)]
    start = np.cumsum([0, *map(len, parts)])[:-1]
    state = np.array([zlib.crc32(b"%d:" % k) for k in range(300)], dtype=np.uint32)
    got = spelling.checksums(state, np.frombuffer(b"".join(parts), dtype=np.uint8), start, np.array(list(map(len, parts))))
    assert got.tolist() == [zlib.crc32(p, int(s)) for s, p in zip(state, parts, strict=True)]
    assert len(spelling.checksums(state[:0], np.zeros(0, np.uint8), start[:0], start[:0])) == 0


def test_no_words(spark):
    frame = spark.createDataFrame([], DOCS)
    assert spelling.spelling_variants(frame).collect() == [] and divergence.divergence_audit(frame).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, "ab cd", "en", "a")], DOCS)).collect() == []
    assert token_counts.count_tokens(frame, MODEL).collect() == []


def audited(rows, least=3, top=200) -> list:
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    count, held, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for k, (text, lang, source) in enumerate(rows):
        groups[lang].add(source)
        for term in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text):
            term = re.sub("[A-Z]", lambda m: m[0].lower(), term)
            count[lang, source][term] += 1
            held[lang][term].add(k)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in held[lang].items() if len(d) >= least]
        n = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (n[s] + len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(n.values()) + len(kept)) for t in kept}
        for s in sources:
            f = lambda a, b: (a - b) ** 2 // b
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, s, part, item, value, rank))
    return sorted(out)


@pytest.fixture(scope="module")
def many():
    rng = random.Random(8)
    terms = ["the", "The", "été", "naïve", "x", "日本", "😀", "Straße", *(f"w{chr(97 + k)}" for k in range(26)), *("q" + chr(97 + k) * 3 for k in range(26))]
    rows = []
    for k in range(300):
        lang = rng.choice(["en", "de", None, "fr"])
        source = rng.choice(["a", "a", "a", "b", "c", None, ""]) if lang != "fr" else "only"
        some = terms[: 10 + 12 * (len(f"{lang}{source}") % 4)] if lang else terms
        rows.append((k, " ".join(rng.choice(some) for _ in range(rng.randrange(40))) if rng.random() > 0.05 else None, lang, source))
    rows += [(1000 + k, t, "xx", s) for k, (t, s) in enumerate([("once", "a"), ("", "b"), (None, "c"), ("42 !", "b")])]  # a language that keeps no term
    rows += [(2000 + k, "", "en", "silent") for k in range(2)] + [rows[0], rows[0]]
    return rows


def test_divergence_against_plain_arithmetic(spark, many):
    frame = spark.createDataFrame([(*r, "t", 1) for r in many], DOCS + ", term string, n int").repartition(3)
    for options in ({}, {"slice_counts": 7, "top": 5}):
        got = sorted(tuple(r) for r in divergence.divergence_audit(frame, **options).collect())
        assert got == audited(many, top=options.get("top", 200))
    assert any(r[0] == "xx" and r[4] == 0 for r in got) and any(r[1] == "silent" for r in got)


def test_divergence_equals_its_sql(spark, many):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents(doc_id BIGINT, text TEXT, lang TEXT, source TEXT)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", many)
    assert sorted(duck.execute(divergence.OP12_SQL).fetchall()) == audited(many)


def test_probabilities_of_large_counts():
    rng = random.Random(4)
    for total in (1, 2, 997, 10**9, 123_456_789_012_345):
        counts = [0, total - 1, *(rng.randrange(total) for _ in range(50))]
        assert divergence._probabilities(np.array(counts), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


def test_large_counts_in_spark(spark):
    rows = [(c, t) for t in (1, 10**9 + 7, 123_456_789_012_345) for c in (0, t // 3, t - 1)]
    got = spark.createDataFrame(rows, "c long, t long").select("c", "t", divergence.probability(F.col("c"), F.col("t")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 1) // r["t"] for r in got)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_tokens_against_the_library(spark, library, monkeypatch):
    rng = random.Random(1)
    alphabet = " \n\tab,.▁é<s>/</s><unk>ﬁＡ日本語😀\0'\"0123eéñ"
    texts = [None, "", " ", "   ", "▁", "▁▁x", "\n", "<s></s><unk><0x0A>", "a" * 3000, "ab " * 3000, "日本語" * 500]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(500)] + ["the same again"] * 50
    rows = [(i if i % 11 else None, t, i, 0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, n_tokens int").repartition(3)
    want = sorted((-1 if d is None else d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t, _, _ in rows)
    for frequent in (token_counts.FREQUENT, 10, 0):
        got = token_counts.count_tokens(frame, MODEL, frequent=frequent)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((-1 if r[0] is None else r[0], *tuple(r)[1:]) for r in got.collect()) == want


def test_long_texts_are_cut_between_pretokens(library):
    rng = random.Random(2)
    splitter = token_counts.Splitter(open(MODEL, "rb").read())
    text = " " + " ".join(rng.choice(["alpha", "über", "x1", "…", "  "]) for _ in range(700_000)) + "b" * 2_500_000 + " end"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    pieces = list(token_counts.segments(splitter, data, np.array([0, len(data)])))
    assert len(pieces) >= 4 and b"".join(p.tobytes() for _, p, _ in pieces) == text.encode()
    parts = [x for _, p, ends in pieces for x in token_counts.parts_of(splitter, p, ends)[2].to_pylist()]
    assert sum(splitter.count(parts)) == len(library.encode(text[1:]))


def test_tokens_of_a_very_long_text(spark, library):
    text = "Eine lange Zeile, 12 Wörter. " * 100_000
    frame = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_counts.count_tokens(frame, MODEL).collect()}
    assert got[1]["n_tokens"] == len(library.encode(text)) and got[1]["over_limit"] and got[2]["n_tokens"] == len(library.encode("short"))


def test_table_misses_where_it_is_full():
    parts = [b" w%d" % k for k in range(1000)]
    known = token_counts.Frequent(parts, list(range(1000)))
    found = known.find(token_counts.hashed(parts), np.array([len(p) for p in parts]))
    assert ((found == np.arange(1000)) | (found == -1)).all() and (found >= 0).mean() > 0.95
    other = [b"x%d" % k for k in range(1000)]
    assert (known.find(token_counts.hashed(other), np.array([len(p) for p in other])) == -1).all()


def test_the_sample_is_of_some_files_only(spark, library, tmp_path):
    rows = [(i, f"file {i % 80} has some words, and again some words {i}") for i in range(800)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(80, "doc_id").write.parquet(str(tmp_path / "many"))
    docs = spark.read.parquet(str(tmp_path / "many"))
    assert len(docs.inputFiles()) > token_counts.SAMPLE_FILES
    known = token_counts.frequent_pretokens(docs, open(MODEL, "rb").read(), rows=400)
    assert (known.lengths > 0).sum() > 5  # pre-tokens of the files that were chosen
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, MODEL).collect()} == {i: len(library.encode(t)) for i, t in rows}
    filtered = docs.where("doc_id < 100").withColumn("text", F.upper("text"))  # not the files as they are
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(filtered, MODEL).collect()} == {i: len(library.encode(t.upper())) for i, t in rows[:100]}
