"""Features of the classifiers against plain Python, text by text."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sensorframe.llm import quality, textnp, toxicity

WORD, LETTER, SPACE = re.compile(rb"[0-9a-zA-Z_\x80-\xff]+"), re.compile(rb"[A-Za-z]"), re.compile(rb"[\x20\x09-\x0d]")
LEARNED, STEMS = {"brzk": 1.5, "gräss": 2.5}, {b"moro": 3.0, b"vermi": 0.5}
LEET = {a: b for a, b in zip(b"013457@$!", b"oieastasi", strict=True)}


def texts():
    rng = random.Random(12)
    pieces = ["you", "idiot", "IDIOT", "1d10t", "moronic", "vermin", "brzk", "gräss", "tu", "fine", "WOW", "a,b", "x1y", "é", "...", "!!", "1", "|", "(b)", "the", "aLongWordIndeed", "id!ot", "-", "u"]
    out = ["", "   ", "a", "!", "7", "idiot", "you idiot", "x" * 5000, "\n\n", "Line one.\nLine one.\nline"]
    for n in (3, 9, 30, 80, 200, 700):
        for _ in range(12):
            out.append("".join(rng.choice(pieces) + rng.choice([" ", " ", " ", "\n", "\t", ", "]) for _ in range(rng.randrange(n))))
    return out


def lower(data):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def spans(data):
    return [(m.start(), m.end(), lower(m[0])) for m in WORD.finditer(data)]


def share(items):
    return len(set(items)) / len(items) if items else 1.0


def bytes_where(data, test):
    return sum(1 for c in data if test(c)) / max(len(data), 1)


def is_sign(c):
    return not WORD.match(bytes([c])) and not SPACE.match(bytes([c]))


def toxic_features(text):
    data = text.encode()
    found = spans(data)
    words = [w for _, _, w in found]
    n, size = max(len(words), 1), max(len(data), 1)
    insults, persons = ({w.encode() for w in x} for x in (toxicity.INSULTS, toxicity.SECOND_PERSON))
    learned = {k.encode(): v for k, v in LEARNED.items()}
    word = [learned.get(w, 0.0) for w in words]
    stem = [max([v for s, v in STEMS.items() if w.startswith(s)], default=0.0) for w in words]
    insult = [w in insults for w in words]
    bad = [a or b > 0 or c > 0 for a, b, c in zip(insult, word, stem, strict=True)]
    person = [w in persons for w in words]
    near = sum(b and any(person[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, b in enumerate(bad))
    plain = lower(bytes(LEET.get(c, c) for c in data))
    hidden = sum(w in insults or w in learned for w in re.split(rb"[\x20\x09-\x0d]+", plain) if w)
    both = [max(a, b) for a, b in zip(word, stem, strict=True)]
    counts = [sum(insult), sum(x > 0 for x in word), sum(x > 0 for x in stem), len({w for w, b in zip(words, bad, strict=True) if b}), hidden, near, sum(both)]
    window = max((sum(bad[i : i + toxicity.WINDOW]) for i in range(len(bad))), default=0)
    odd = lambda c: is_sign(c) or 48 <= c <= 57
    inside = sum(odd(data[i]) and bool(LETTER.match(data[i - 1 : i])) and bool(LETTER.match(data[i + 1 : i + 2])) for i in range(1, len(data) - 1))
    shout = sum(re.fullmatch(rb"[A-Z]{2,}", data[s:e]) is not None for s, e, _ in found)
    return [
        *(x for c in counts for x in (c / n, math.log1p(c))), sum(person) / n, max(both, default=0.0), window / min(n, toxicity.WINDOW),
        bytes_where(data, lambda c: 65 <= c <= 90), shout / n, bytes_where(data, lambda c: c == 33), bytes_where(data, lambda c: is_sign(c) and c not in b".,'-"),
        inside / n, bytes_where(data, lambda c: 48 <= c <= 57), math.log1p(n), sum(bad) / n,
    ]


def quality_features(text):
    data = text.encode()
    found = spans(data)
    words, lengths = [w for _, _, w in found], [e - s for s, e, _ in found]
    n, size = max(len(words), 1), max(len(data), 1)
    mean = sum(lengths) / n
    lines = [x for x in data.split(b"\n") if x]
    low = [lower(x) for x in lines]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
    pair = lambda test: sum(test(data[i - 1], data[i]) for i in range(1, len(data)))
    return [
        math.log1p(size), math.log1p(len(words)), mean, math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0)), bytes_where(data, lambda c: 65 <= c <= 90),
        sum(re.fullmatch(rb"[A-Z]{2,}", data[s:e]) is not None for s, e, _ in found) / n, bytes_where(data, lambda c: 48 <= c <= 57), bytes_where(data, is_sign), pair(lambda a, b: is_sign(a) and is_sign(b)) / size,
        bytes_where(data, lambda c: c == 124), bytes_where(data, lambda c: c == 33), bytes_where(data, lambda c: c >= 128), share(words), share(grams), math.log1p(len(lines)),
        sum(map(len, lines)) / max(len(lines), 1), share(low), max(Counter(low).values(), default=0) / max(len(low), 1), bytes_where(data, lambda c: c == 46), bytes_where(data, lambda c: c == 44),
        sum(x <= 3 for x in lengths) / n, sum(x >= 12 for x in lengths) / n, bytes_where(data, lambda c: c in b"()[]{}<>"), pair(lambda a, b: is_sign(b) and WORD.match(bytes([a])) is not None) / n,
        bytes_where(data, lambda c: c == 32), sum(x[-1:] in (b".", b"!", b"?") for x in lines) / max(len(lines), 1),
    ]


def model():
    def of(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
        (_, _, data, offsets) = next(textnp.chunks(batch, "t"))
        return textnp.words(data, offsets), data

    (code, _, _, _), _ = of(list(LEARNED))
    order = np.argsort(code)
    keys = []
    for stem in STEMS:
        (_, _, start, end), data = of([stem.decode()])
        keys.append(toxicity._stems(data, start, end)[toxicity.STEM_BYTES.index(len(stem))][0])
    stems = np.array(keys, dtype=np.uint64)
    at = np.argsort(stems)
    return toxicity.ToxicityModel(code[order], np.array(list(LEARNED.values()))[order], stems[at], np.array(list(STEMS.values()))[at])


@pytest.mark.parametrize("which", ["toxicity", "quality"])
def test_features_of_each_text_whatever_stands_beside_it(which):
    features, brute, names = (model().features, toxic_features, toxicity.NAMES) if which == "toxicity" else (quality.features, quality_features, quality.NAMES)
    rows = texts()
    want = np.array([brute(t) for t in rows])
    for part in (rows, rows[::-1], *([t] for t in rows)):
        batch = pa.RecordBatch.from_arrays([pa.array(part)], ["t"])
        got = np.concatenate([features(data, offsets) for _, _, data, offsets in textnp.chunks(batch, "t")])
        expected = want if part is rows else want[::-1] if len(part) == len(rows) else want[[rows.index(part[0])]]
        assert got.shape == (len(part), len(names))
        worst = np.abs(got - expected).max(axis=0)
        assert (worst < 1e-9).all(), {n: w for n, w in zip(names, worst, strict=True) if w > 1e-9}
