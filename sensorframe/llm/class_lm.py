"""Language-model scores by a Brown class bigram model whose classes come from exchange clustering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import materialise, remainder, table, width

#: Least words that the driver clusters one by one, groups of words of like shape (under 256), least classes, words that workers hold.
SINGLE, SHAPES, CLASSES, HEAD, SWEEPS, SMOOTHING = 512, 192, 48, 1_000_000, 12, 5.0
#: Most classes by default. It bounds what the driver clusters: units (four a class, and the shapes) and their matrix (about 18 million counts, 150 MB).
MOST_CLASSES = 1024
#: Sweeps over all words in Spark; events (tokens, neighbours) that a worker gathers before it hands them on; numbers that a task adds up at once.
WORD_SWEEPS, MOST_EVENTS, DENSE = 2, 4_000_000, 4_000_000
#: What the class of its shape's group is ahead by for a word, in nats: words of few neighbours stay with their group unless those speak for another class.
STAY = 4.0
#: Ranks below are stored in two bytes. The number of the end among ranks.
SHORT, END = 65_535, np.iinfo(np.int32).max


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and row of every run of bytes that are not white space, A-Z in lower case. The code is a hash of 56 bits and the shape (by last byte and length)."""
    code, row, start, end = textnp.words(data, offsets, textnp.SOLID)
    if not len(code):
        return code, row
    length = np.searchsorted([4, 7, 10, 14], end - start, side="right").astype(np.uint64)
    last = textnp.LOWER[data[end - 1]].astype(np.uint64)
    return (code & ~np.uint64(255)) | (textnp.mix(last * np.uint64(8) + length) % np.uint64(SHAPES)), row


def _lookup(code: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each hash is among sorted keys, or -1."""
    if not len(keys):
        return np.full(len(code), -1)
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    return np.where(keys[at] == code, at, -1)


def exchange_classes(pairs: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for every unit of a bigram count matrix; unit 0, the end, has class 0 for itself.

    Units start in turn by frequency; each is then taken out of its class and put where the likelihood
    of the class bigram model grows most, in sweeps over all units until none moves.
    """
    m = len(pairs)
    c = pairs.astype(np.float64)
    order = np.argsort(-(c.sum(axis=1)), kind="stable")
    order = order[order != 0]
    cls = np.zeros(m, dtype=np.int64)
    cls[order] = 1 + np.arange(m - 1) % (classes - 1)
    hot = np.zeros((m, classes))
    hot[np.arange(m), cls] = 1
    after, before = c @ hot, c.T @ hot  # unit -> class, class -> unit
    g = hot.T @ after
    phi = lambda x: x * np.log(np.maximum(x, 1e-12))
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a, own = cls[u], c[u, u]
            g[a, :] -= after[u]
            g[:, a] -= before[u]
            g[a, a] += own
            out, into = after[u].copy(), before[u].copy()
            out[a] -= own
            into[a] -= own
            rows, cols = g.sum(axis=1) + into, g.sum(axis=0) + out  # what other classes have with u, wherever it goes
            gain = (phi(g + out[None, :]) - phi(g)).sum(axis=1) + (phi(g + into[:, None]) - phi(g)).sum(axis=0)
            d = np.diag(g)
            gain += phi(d + out + into + own) - phi(d + out) - phi(d + into) + phi(d)
            gain -= phi(rows + out.sum() + own) - phi(rows) + phi(cols + into.sum() + own) - phi(cols)
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            if b != a:
                after[:, a] -= c[:, u]
                after[:, b] += c[:, u]
                before[:, a] -= c[u]
                before[:, b] += c[u]
                cls[u] = b
            g[b, :] += after[u]
            g[:, b] += before[u]
            g[b, b] -= own
        if not moved:
            break
    return cls


def _pairs(value: np.ndarray, row: np.ndarray, rows: int, end: object) -> tuple[np.ndarray, np.ndarray]:
    """What stands before and after at each of all neighbouring places of the rows, their ends being ``end``."""
    before, last = np.full(len(value), end, dtype=value.dtype), np.full(rows, end, dtype=value.dtype)
    same = row[1:] == row[:-1]
    before[1:][same] = value[:-1][same]
    last[row] = value  # the last assignment stays
    return np.concatenate([before, last]), np.concatenate([value, np.full(rows, end, dtype=value.dtype)])


def _word_counts(texts: DataFrame) -> DataFrame:
    """(code, n) of every word of the corpus."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        u, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n, pa.int64())], ["code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, data, offsets in textnp.chunks(batch, "_t"):
                parts.append(tokens(data, offsets)[0])
                held += len(parts[-1])
                if held >= MOST_EVENTS:
                    yield counted(parts)
                    parts, held = [], 0
        if held:
            yield counted(parts)

    return texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> Column:
    """Which words are the most frequent, ``most`` at most: all of the highest bins of log counts that fit together, so no task sorts all words."""
    bin_ = F.floor(F.log2("n") * 64)
    left, least = most, None
    for r in sorted(counts.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("v")).collect(), key=lambda r: -r["b"]):
        left -= r["v"]
        if left < 0:
            break
        least = r["b"]
    return F.lit(False) if least is None else bin_ >= least


def _packed(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The values of each row as bytes."""
    ends = (np.searchsorted(row, np.arange(rows + 1)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of bytes and the ends of its rows."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, dtype=np.uint8)
    return data[ends[0] : ends[-1]].view(kind), (ends - ends[0]) // np.dtype(kind).itemsize


def _encoded(docs: DataFrame, code: np.ndarray) -> DataFrame:
    """Each text as ranks of its words among ``code``, the frequent ones in turn: _lo (two bytes a token), _hi (four for ranks that do not fit), _rare (codes of words that are not frequent).

    Texts are read once here; all that follows reads these numbers.
    """
    order = np.argsort(code)
    held = docs.sparkSession.sparkContext.broadcast((code[order], order.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks = held.value
        for batch in batches:
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                code, row = tokens(data, offsets)
                at = _lookup(code, keys)
                rank = np.where(at >= 0, ranks[at] if len(ranks) else 0, -1 - (code & np.uint64(255)).astype(np.int32)).astype(np.int32)
                near = (rank >= 0) & (rank < SHORT)
                lo = np.where(near, rank, SHORT).astype(np.uint16)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _packed(lo, row, j - i), _packed(rank[~near], row[~near], j - i), _packed(code[rank < 0], row[rank < 0], j - i)], ["_id", "_train", "_lo", "_hi", "_rare"]
                )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, _train boolean, _lo binary, _hi binary, _rare binary")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, ranks, rows, codes of the rare words) for pieces of a batch; the rank of a rare word is -1 less its shape."""
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    (lo, ends), (hi, hi_ends), (rare, rare_ends) = _unpacked(column("_lo"), np.uint16), _unpacked(column("_hi"), np.int32), _unpacked(column("_rare"), np.uint64)
    i = 0
    while i < len(batch):
        j = min(len(batch), max(i + 1, int(np.searchsorted(ends, ends[i] + (1 << 18), side="right")) - 1))
        rank = lo[ends[i] : ends[j]].astype(np.int32)
        rank[rank == SHORT] = hi[hi_ends[i] : hi_ends[j]]
        yield i, j, rank, np.repeat(np.arange(j - i), np.diff(ends[i : j + 1])), rare[rare_ends[i] : rare_ends[j]]
        i = j


def _sum_matrix(found: DataFrame, m: int) -> np.ndarray:
    """The sum of (at, n) rows as an m x m matrix."""
    rows = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(m * m, dtype=np.int64)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(m, m)


def _counted(train: DataFrame, m: int, of_rank: np.ndarray, of_shape: np.ndarray | None) -> np.ndarray:
    """Counts of neighbouring numbers below ``m`` over the corpus, 0 being the end; each task adds up its own matrix.

    Numbers come by rank, and for rare words by shape; without ``of_shape`` pairs with a rare word are left out.
    """
    held = train.sparkSession.sparkContext.broadcast((of_rank, of_shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_rank, of_shape = held.value
        total = np.zeros(m * m, dtype=np.int64)
        for batch in batches:
            for i, j, rank, row, _ in _texts(batch):
                a, b = _pairs(_numbers(rank, of_rank, of_shape), row, j - i, 0)
                if of_shape is None:
                    both = (a >= 0) & (b >= 0)
                    a, b = a[both], b[both]
                total += np.bincount(a * m + b, minlength=m * m)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    return _sum_matrix(train.mapInArrow(run, "at int, n long"), m)


def _numbers(rank: np.ndarray, of_rank: np.ndarray, of_shape: np.ndarray | None) -> np.ndarray:
    """The number of each token by its rank, or shape; -1 for rare words without."""
    rare = np.flatnonzero(rank < 0)
    out = of_rank[np.maximum(rank, 0)].astype(np.int64) if len(of_rank) else np.zeros(len(rank), dtype=np.int64)
    out[rare] = -1 if of_shape is None else of_shape[-1 - rank[rare]]
    return out


def _rare_neighbours(train: DataFrame) -> DataFrame:
    """(kind, a, b, n): rare words a with frequent words or ends b (ranks) before (kind 0) and after them (1), and rare words a before rare words b (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, rank, row, rare in _texts(batch):
                code = np.zeros(len(rank), dtype=np.uint64)
                code[rank < 0] = rare
                (a, b), (ca, cb) = _pairs(rank, row, j - i, END), _pairs(code, row, j - i, 0)
                ra, rb = a < 0, b < 0
                out = [(0, cb[rb & ~ra].view(np.int64), a[rb & ~ra]), (1, ca[ra & ~rb].view(np.int64), b[ra & ~rb]), (2, ca[ra & rb].view(np.int64), cb[ra & rb].view(np.int64))]
                kind = np.concatenate([np.full(len(x), k, dtype=np.int32) for k, x, _ in out])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([x for _, x, _ in out])), pa.array(np.concatenate([y.astype(np.int64) for _, _, y in out]))], ["kind", "a", "b"])

    return train.mapInArrow(run, "kind int, a long, b long").groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def _buckets(words: int, classes: int, least: int) -> int:
    """How many tasks add up the class neighbours of the frequent words, so that none holds more than about :data:`DENSE` numbers."""
    return max(least, -(-words * 2 * classes // DENSE))


def _flush(key: np.ndarray, n: np.ndarray | None, buckets: int, classes: int) -> pa.RecordBatch:
    """(bucket, keys, counts) of (rank x 2 classes + event) keys: the bucket is the rank's remainder, the key within it of its quotient."""
    if n is None:
        key, n = np.unique(key, return_counts=True)
    rank, event = np.divmod(key, 2 * classes)
    bucket = rank % buckets
    order = np.argsort(bucket, kind="stable")
    local = ((rank // buckets) * (2 * classes) + event)[order].astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), _packed(local, bucket[order], buckets), _packed(n[order].astype(np.int64), bucket[order], buckets)], ["bucket", "keys", "counts"])


def _frequent_events(train: DataFrame, cls: np.ndarray, of_shape: np.ndarray | None, classes: int, buckets: int) -> DataFrame:
    """The classes before (k) and after (classes + k) every frequent word, as :func:`_flush` gives them."""
    held = train.sparkSession.sparkContext.broadcast((cls, of_shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, of_shape = held.value
        parts, size = [], 0
        for batch in batches:
            for i, j, rank, row, _ in _texts(batch):
                (a, b), (ca, cb) = _pairs(rank, row, j - i, END), _pairs(_numbers(rank, cls, of_shape), row, j - i, 0)
                right, left = (a >= 0) & (a != END) & (cb >= 0), (b >= 0) & (b != END) & (ca >= 0)
                parts += [a[right].astype(np.int64) * (2 * classes) + classes + cb[right], b[left].astype(np.int64) * (2 * classes) + ca[left]]
                size += len(parts[-1]) + len(parts[-2])
                if size >= MOST_EVENTS:
                    yield _flush(np.concatenate(parts), None, buckets, classes)
                    parts, size = [], 0
        if size:
            yield _flush(np.concatenate(parts), None, buckets, classes)

    return train.mapInArrow(run, "bucket int, keys binary, counts binary")


def _scores_of(g: np.ndarray) -> np.ndarray:
    """What a neighbour of each class before a word, and after it, adds to the log likelihood of each class for the word."""
    c = g.astype(np.float64)
    into, out = c.sum(axis=0), c.sum(axis=1)
    share = lambda x: (x + 0.5) / (x.sum() + 0.5 * len(c))
    left_of = np.log((c + SMOOTHING * share(out)[:, None]) / (into + SMOOTHING)[None, :])
    right_of = np.log((c + SMOOTHING * share(into)[None, :]) / (out + SMOOTHING)[:, None]).T
    weight = np.concatenate([left_of, right_of]).astype(np.float32)
    return weight


def _best(counts: np.ndarray, weight: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """The likeliest class of each row of neighbour counts; class 0 is the end's own."""
    score = counts @ weight
    score[np.arange(len(score)), stay] += STAY
    return (score[:, 1:].argmax(axis=1) + 1).astype(np.int32)


def _frequent_classes(events: DataFrame, g: np.ndarray, stay: np.ndarray, fixed: np.ndarray, buckets: int) -> np.ndarray:
    """The class of every frequent word where its neighbours are likeliest, that of ``stay`` being ahead; those of ``fixed``, the first, do not move. Each task adds up the events of its own words."""
    classes, words = len(g), len(stay)
    held = events.sparkSession.sparkContext.broadcast((_scores_of(g), stay))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, own = np.zeros((-(-words // buckets) + 1) * 2 * classes, dtype=np.float32), None
        for batch in batches:
            own = batch.column(0)[0].as_py() if len(batch) else own
            np.add.at(total, _unpacked(batch.column(1), np.int64)[0], _unpacked(batch.column(2), np.int64)[0].astype(np.float32))
        if own is None:
            return
        rank = own + buckets * np.arange(-(-words // buckets) + 1)
        rank = rank[rank < words]
        best = [_best(total.reshape(-1, 2 * classes)[x : min(x + 4096, len(rank))], held.value[0], held.value[1][rank[x : x + 4096]]) for x in range(0, len(rank), 4096)]
        yield pa.RecordBatch.from_arrays([pa.array(rank, pa.int32()), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *best]))], ["rank", "cls"])

    rows = events.repartitionById(buckets, F.col("bucket")).mapInArrow(run, "rank int, cls int").toArrow()
    out = np.ones(words, dtype=np.int32)
    out[rows.column("rank").to_numpy()] = rows.column("cls").to_numpy()
    out[: len(fixed)] = fixed
    return out


def _rare_classes(events: DataFrame, g: np.ndarray, of_shape: np.ndarray) -> DataFrame:
    """(code, cls) for (code, k, n) events of rare words: the class where they are likeliest, that of the word's shape being ahead."""
    classes = len(g)
    held = events.sparkSession.sparkContext.broadcast((_scores_of(g), of_shape))

    def best(code: np.ndarray, dense: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(_best(dense, held.value[0], held.value[1][code & 255]))], ["code", "cls"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_code, open_counts = np.zeros(0, dtype=np.int64), np.zeros((0, 2 * classes), dtype=np.float32)
        for batch in batches:
            code, k, n = (batch.column(c).to_numpy() for c in range(3))
            for i in range(0, len(code), 8192):
                part = slice(i, i + 8192)
                own, at = np.unique(np.concatenate([open_code, code[part]]), return_inverse=True)
                dense = np.bincount(at[len(open_code) :] * (2 * classes) + k[part], n[part], len(own) * 2 * classes)
                dense = dense.reshape(len(own), 2 * classes).astype(np.float32)
                np.add.at(dense, at[: len(open_code)], open_counts)
                done = own != code[part][-1]  # the last word may go on
                if done.any():
                    yield best(own[done], dense[done])
                open_code, open_counts = own[~done], dense[~done]
        if len(open_code):
            yield best(open_code, open_counts)

    return events.repartition("code").sortWithinPartitions("code").mapInArrow(run, "code long, cls int")


def _known_side(one: DataFrame, cls: np.ndarray, classes: int) -> DataFrame:
    """(code, k, n) of rare words from their frequent neighbours' classes."""
    held = one.sparkSession.sparkContext.broadcast(cls)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            k = np.where(rank == END, 0, held.value[np.where(rank == END, 0, rank)] if len(held.value) else 0) + kind * classes
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(k.astype(np.int32)), batch.column(3)], ["code", "k", "n"])

    return one.select("kind", "a", "b", "n").mapInArrow(run, "code long, k int, n long").groupBy("code", "k").agg(F.sum("n").alias("n"))


def _other_side(classed: DataFrame, classes: int, buckets: int) -> DataFrame:
    """Events of frequent words from their rare neighbours' classes, as :func:`_flush` gives them; ``classed`` has kind, cls, b, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, cls, rank, n = (batch.column(c).to_numpy() for c in range(4))
            at = np.flatnonzero(rank != END)
            if len(at):  # a rare word after (1) its neighbour stands before for the rare one, and the reverse
                yield _flush(rank[at] * (2 * classes) + (1 - kind[at]) * classes + cls[at], n[at], buckets, classes)

    return classed.select("kind", "cls", "b", "n").mapInArrow(run, "bucket int, keys binary, counts binary")


def _rare_pairs(classed: DataFrame, both: DataFrame, rare_words: DataFrame, cls: np.ndarray, classes: int) -> np.ndarray:
    """Counts of neighbouring classes where at least one of the words is rare."""
    held = classed.sparkSession.sparkContext.broadcast(cls)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            kind, own, rank, n = (batch.column(c).to_numpy() for c in range(4))
            other = np.where(rank == END, 0, held.value[np.where(rank == END, 0, rank)] if len(held.value) else 0)
            np.add.at(total, np.where(kind == 0, other * classes + own, own * classes + other), n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    found = classed.select("kind", "cls", "b", "n").mapInArrow(run, "at int, n long")
    two = both.join(rare_words.toDF("a", "ca"), "a").join(rare_words.toDF("b", "cb"), "b")
    return _sum_matrix(found.union(two.select((F.col("ca") * classes + F.col("cb")).cast("int"), "n")), classes)


def class_lm_scores(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    single: int | None = None,
    classes: int | None = None,
    head: int = HEAD,
    word_sweeps: int = WORD_SWEEPS,
    most_classes: int = MOST_CLASSES,
) -> DataFrame:
    """log10 probabilities of every text under a class bigram model fitted to the rows that meet ``train``.

    Tokens are runs of bytes that are not white space, A-Z in lower case, and one end a text. All words of
    the training rows are counted. The ``single`` most frequent words and groups of the other words
    of like shape are the units that exchange clustering on the driver assigns to ``classes`` classes, by
    the counts of all neighbouring units. From there ``word_sweeps`` sweeps in Spark (one at least) put every other word into a class of its own choice, by the
    counts of all classes before and after it; to first order that is the exchange of all words at once. By default classes are twice the fourth root of the training tokens and single words four times
    as many as classes, so both grow with the corpus (from 48 and 512 on, up to ``most_classes`` and four times that, at 7 x 10^10 tokens); words and their
    counts grow without bound, in Spark. A token's probability is that of its class after the
    class before (smoothed with the class's share), and of the word in the class: its count less an absolute discount, whose
    mass is that of words never seen in training. Those are in the class where most words of their shape that
    were seen once are, as one symbol a shape; a class's words and the symbols of its shapes add up to one. The base is
    an add-0.1 unigram model with one symbol for unseen words.

    Texts are read twice, to count words and to write them as ranks; all else reads those. Workers hold the most frequent words, ``head`` at most; all others meet their counts and classes in joins, so the
    vocabulary may grow with the corpus and ``head`` changes where words meet their classes, not the scores. Returns one row per input row: id, n_tokens, n_known, train_tokens,
    base_score, score, perplexity. Null texts are empty (one token, the end); null ids are returned;
    rows that repeat score alike; other columns are not read; an empty table gives an empty result. Without training
    rows the base is that of one unseen symbol and the score is uniform over classes.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(train, F.lit(False)).alias("_train"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    counts = materialise(_word_counts(rows.where("_train").select("_t")), "word-counts")
    n_train = rows.where("_train").count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = n + n_train, v + (n_train > 0)
    classes = classes or min(most_classes, max(CLASSES, round(2 * n**0.25)))
    frequent = _frequent(counts, head)
    top = counts.where(frequent).toArrow()
    code, count = top.column("code").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.lexsort((code, -count))
    code, count = code[order], count[order]
    shape = (code & np.uint64(255)).astype(np.int64)
    single = min(len(code), single or max(SINGLE, 4 * classes))
    encoded = materialise(_encoded(rows, code), "ranks")
    known = encoded.where("_train")

    unit = np.where(np.arange(len(code)) < single, 1 + np.arange(len(code)), 1 + single + shape)
    units = 1 + single + SHAPES
    pairs = _counted(known, units, unit, 1 + single + np.arange(SHAPES))
    unit_cls = exchange_classes(pairs, classes)
    g = np.zeros((classes, classes), dtype=np.int64)
    np.add.at(g, (unit_cls[:, None].repeat(units, 1), unit_cls[None, :].repeat(units, 0)), pairs)
    cls, of_shape = unit_cls[unit], unit_cls[1 + single :]
    rare = materialise(_rare_neighbours(known), "rare-neighbours")
    one, both = rare.where("kind < 2"), rare.where("kind = 2").select("a", "b", "n")
    buckets = _buckets(len(code), classes, width(spark))
    rare_words = classed = None
    for _ in range(max(1, word_sweeps)):
        events = _frequent_events(known, cls, of_shape if classed is None else None, classes, buckets)
        of_rare = _known_side(one, cls, classes)
        if classed is not None:
            events = events.union(_other_side(classed, classes, buckets))
            right = both.join(rare_words.toDF("b", "c"), "b").select(F.col("a").alias("code"), (classes + F.col("c")).alias("k"), "n")
            left = both.join(rare_words.toDF("a", "c"), "a").select(F.col("b").alias("code"), F.col("c").alias("k"), "n")
            of_rare = of_rare.union(right.union(left))
        new = _frequent_classes(events, g, of_shape[shape], unit_cls[1 : 1 + single], buckets)
        rare_words = materialise(_rare_classes(of_rare, g, of_shape), "rare-classes")
        cls = new
        classed = materialise(one.join(rare_words.toDF("a", "cls"), "a").groupBy("kind", "cls", "b").agg(F.sum("n").alias("n")), "rare-classed")
        g = _counted(known, classes, cls, None) + _rare_pairs(classed, both, rare_words, cls, classes)

    share = g.sum(axis=0)
    prior = (share + 0.5) / (share.sum() + 0.5 * classes)
    transition = np.log10((g + SMOOTHING * prior[None, :]) / (g.sum(axis=1, keepdims=True) + SMOOTHING))
    rare_counts = materialise(counts.where(~frequent).join(rare_words, "code"), "rare-words")
    once = lambda c: F.count_if(F.col("n") == c)
    stats = rare_counts.groupBy(F.col("code").bitwiseAND(255).alias("shape"), "cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), once(1).alias("n1"), once(2).alias("n2")).toArrow()
    sums = {c: np.zeros((SHAPES, classes)) for c in ("n", "v", "n1", "n2")}
    for c, total in sums.items():
        np.add.at(total, (stats.column("shape").to_numpy(), stats.column("cls").to_numpy()), stats.column(c).to_numpy())
        np.add.at(total, (shape, cls), {"n": count, "v": np.ones(len(count)), "n1": count == 1, "n2": count == 2}[c])
    tokens_of, words_of, n1, n2 = (sums[c].sum(axis=0) for c in ("n", "v", "n1", "n2"))
    singly = sums["n1"] + 1e-3 * sums["v"]
    shape_cls = np.where(singly.any(axis=1), singly.argmax(axis=1), of_shape)
    weight = singly.sum(axis=1) + 0.5
    some = np.bincount(shape_cls, weight, classes)  # classes that words unseen in training may have
    size = np.maximum(tokens_of, 1)
    discount = np.where(some > 0, np.clip((n1 + 0.5) / (n1 + 2 * n2 + 1), 0.1, 0.9), 0.0)
    unseen = np.where(tokens_of > 0, np.maximum(discount * words_of, 1e-9) / size, 1.0)
    shape_unseen = np.log10(unseen[shape_cls] * weight / some[shape_cls])
    word = lambda count, cls: np.log10(np.maximum(count - discount[cls], 1e-9) / size[cls])
    held = spark.sparkContext.broadcast((cls, word(count, cls), np.log10(count + 0.1), transition))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, own, base, transition = held.value
        for batch in batches:
            for i, j, rank, row, code in _texts(batch):
                total = j - i
                number = _numbers(rank, cls, None)
                here = rank >= 0
                a, b = _pairs(number, row, total, 0)
                both = (a >= 0) & (b >= 0)
                score = np.bincount(np.concatenate([row, np.arange(total)])[both], transition[a[both], b[both]], total) + np.bincount(row[here], own[rank[here]], total)
                rare = np.flatnonzero(~here)
                before, after = a[: len(rank)], np.append(number[1:], 0)
                after[np.flatnonzero(np.append(row[1:] != row[:-1], True))[: len(after)]] = 0
                ends = pa.array(np.searchsorted(row[rare], np.arange(total + 1)).astype(np.int32))
                entry = pa.StructArray.from_arrays(
                    [pa.array(rare.astype(np.int32)), pa.array(code.view(np.int64)), *(pa.array(x[rare].astype(np.int32)) for x in (before, after[: len(rank)]))], ["at", "code", "before", "after"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, total), pa.array(np.bincount(row, minlength=total) + 1, pa.int64()), pa.array(np.bincount(row[here], minlength=total), pa.int64()),
                        pa.array(np.bincount(row[here], base[rank[here]], total)), pa.array(score), pa.ListArray.from_arrays(ends, entry),
                    ],
                    [id_col, "n_tokens", "known", "base", "score", "rare"],
                )

    def run_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0
        for batch in batches:
            row, code, before, after, count, cls = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("_row", "code", "before", "after", "n", "cls"))
            seen, shape = batch.column("n").is_valid().to_numpy(zero_copy_only=False), code & 255
            cls = np.where(seen, cls, shape_cls[shape])
            before = np.where(before >= 0, before, np.append(last, cls[:-1])[: len(cls)])  # the one before is rare too
            score = np.where(seen, word(count, cls), shape_unseen[shape]) + transition[before, cls] + np.where(after >= 0, transition[cls, after], 0.0)
            last = cls[-1] if len(cls) else last
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(seen.astype(np.int64)), pa.array(np.log10(count + 0.1)), pa.array(score)], ["_row", "_known", "_base", "_score"])

    schema = f"`{id_col}` {kind}, n_tokens long, known long, base double, score double, rare array<struct<at:int,code:long,before:int,after:int>>"
    scored = materialise(encoded.select("_id", "_lo", "_hi", "_rare").mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    unheld = scored.select("_row", F.explode("rare").alias("_w")).select("_row", "_w.*")
    met = unheld.join(rare_counts.select("code", "n", "cls"), "code", "left").select("_row", "at", "code", "before", "after", "n", "cls")
    met = met.repartition("_row").sortWithinPartitions("_row", "at").mapInArrow(run_rare, "_row long, _known long, _base double, _score double")
    more = met.groupBy("_row").agg(*(F.sum(c).alias(c) for c in ("_known", "_base", "_score")))
    per_token = float(np.log10(n + 0.1 * (v + 1)))
    end = float(np.log10((n_train if n_train else 0) + 0.1))
    total = F.col("score") + F.coalesce("_score", F.lit(0.0))
    return scored.drop("rare").join(more, "_row", "left").select(
        id_col, "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0)) + int(n_train > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0)) + end - F.col("n_tokens") * per_token).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    docs = table(spark, sf_dir, "documents")
    out = class_lm_scores(docs, remainder("doc_id", 10) != 0)
    return out.select("doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
