"""Spelling variants: words one edit apart, found through bitsets of a vocabulary by position and letter."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import discard, materialise, table

#: Least letters and occurrences of a word; how many times as frequent a form has to be; one in so many words of a document loses a letter.
LEAST_LETTERS, LEAST_COUNT, FACTOR, SPOILT = 5, 3, 2, 97
#: Words of a block, and those that a block is cut from; bytes of a set of words for all queries at once; words that a task holds.
BLOCK_WORDS, MOST_WORDS, SET_BYTES, HELD = 2_048, 4_096, 8 << 20, 400_000
#: Bytes of a word up to which checksums of all words advance together.
LOCKSTEP = 64

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & np.uint32(1), (out >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), out >> np.uint32(1))
    return out


_CRC = _crc_table()


def checksums(state: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of what ``state`` has seen and then each string, a byte of every string at a time."""
    out = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    out, first, size = out[order], start[order], length[order]
    for j in range(int(min(size[0], LOCKSTEP)) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, side="left"))  # so many are longer than j
        now = out[:n]
        out[:n] = _CRC[(now ^ data[first[:n] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for k in range(int(np.searchsorted(-size, -LOCKSTEP, side="left"))):
        out[k] = zlib.crc32(data[first[k] + LOCKSTEP : first[k] + size[k]].tobytes(), int(out[k]))
    back = np.empty_like(out)
    back[order] = out
    return back


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of A-Z, a-z and U+00C0 to U+00FF, and the bytes that begin a letter of two."""
    lead = data == 0xC3
    inside = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | lead
    inside[1:] |= lead[:-1]
    start, end = textnp.runs(inside, offsets)
    return start, end, lead


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of all runs as the documents have them, after every run whose checksum with its document says so has lost a letter."""

    def summed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        yield from pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            seeds = np.array([zlib.crc32(f"{x}:".encode()) for x in batch.column(0).to_pylist()], dtype=np.uint32)
            for i, _, data, offsets in textnp.chunks(batch, "_t"):
                low = textnp.LOWER[data]
                start, end, lead = letter_runs(low, offsets)
                if not len(start):
                    continue
                row = np.searchsorted(offsets, start, side="right") - 1
                h = checksums(seeds[i + row], low, start, end - start)
                doubled = np.concatenate([[0], np.cumsum(lead)])
                letters = (end - start) - (doubled[end] - doubled[start])
                spoilt = h % SPOILT == 0
                parts = []
                for k in np.flatnonzero(spoilt & (letters > LEAST_LETTERS)):
                    word, at = low[start[k] : end[k]].tobytes().decode(), int(h[k]) % int(letters[k])
                    parts.append(word[:at] + word[at + 1 :])
                good = ~spoilt & (letters >= LEAST_LETTERS)
                length = np.where(good, end - start, 0)[good]
                begin = np.cumsum(length) - length
                taken = low[np.arange(int(length.sum())) - np.repeat(begin, length) + np.repeat(start[good], length)]
                plain = pa.Array.from_buffers(pa.large_string(), len(length), [None, pa.py_buffer(np.append(begin, length.sum()).astype(np.int64)), pa.py_buffer(taken)])
                found = pc.value_counts(pa.chunked_array([plain, pa.array(parts, pa.large_string())]))
                found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
                held.append(pa.table({"word": found.field(0).cast(pa.string()), "n": found.field(1)}))
                rows += len(found)
                if rows >= HELD:
                    yield from summed(held)
                    held, rows = [], 0
        if held:
            yield from summed(held)

    plain = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return plain.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _bits(mask: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit sets."""
    wide = np.zeros((mask.shape[0], -(-mask.shape[1] // 64) * 64), dtype=bool)
    wide[:, : mask.shape[1]] = mask
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and member of every bit of rows of sets."""
    row, word = np.nonzero(sets)
    bit = np.unpackbits(sets[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    k, b = np.nonzero(bit)
    return row[k], word[k] * 64 + b


def near_pairs(words: list[str], short: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places of words one edit apart, both ways round, that share a first part of ``lo`` to ``hi`` - 1 letters.

    The words have ``short`` or ``short`` + 1 letters; pairs have a word of ``short`` letters at least. For each position and letter there is the set of words
    that have it there. Queries of ``short`` letters go through their letters together: ``same`` are the words without an error so far, ``changed`` those with
    a letter replaced and ``longer``, read one position on, those with a letter inserted; each step is an intersection with the set of a letter, and an error joins from ``same``.
    """
    length = np.array([len(w) for w in words])
    code = np.zeros((len(words), short + 1), dtype=np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    code[np.repeat(np.arange(len(words)), length), at] = flat
    letter = np.unique(code, return_inverse=True)[1].reshape(code.shape)
    size = int(letter.max()) + 1
    of_short, of_long = _bits((length == short)[None, :])[0], _bits((length == short + 1)[None, :])[0]
    query = np.flatnonzero(length == short)
    step = max(1, SET_BYTES // (8 * len(of_short)))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def index(i: int) -> np.ndarray:
        sets = np.zeros((size, len(words)), dtype=bool)
        sets[letter[:, i], np.arange(len(words))] = True
        return _bits(sets)

    for q in (query[k : k + step] for k in range(0, len(query), step)):
        same = np.repeat(_bits(np.ones((1, len(words)), dtype=bool)), len(q), axis=0)
        changed, longer, beyond = np.zeros_like(same), np.zeros_like(same), np.zeros_like(same)
        here = index(0)
        for i in range(short):
            ahead = index(i + 1)
            if i == hi:
                beyond = same.copy()  # these share more than a block's pairs do
            at_i, at_next = here[letter[q, i]], ahead[letter[q, i]]
            changed &= at_i
            if lo <= i < hi:
                changed |= same
                longer |= same
            longer &= at_next
            same &= at_i
            here = ahead
        if lo <= short < hi:
            longer |= same
        if hi == short:
            beyond = same
        near = (changed & of_short & ~same) | (longer & of_long)
        near &= ~beyond
        a, b = _members(near)
        found.append((q[a], b))
        back = length[b] > short
        found.append((b[back], q[a][back]))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *(a for a, _ in found)]), np.concatenate([none, *(b for _, b in found)])


def _of_block(block: pa.Table) -> pa.Table:
    """(word, near, best) of one block: how many near words each word has there, and the one of largest n."""
    rows = block.sort_by([("n", "descending"), ("word", "ascending")])
    words, short, lo, hi = rows["word"].to_pylist(), *(rows[c][0].as_py() for c in ("s", "lo", "hi"))
    a, b = near_pairs(words, short, lo, hi)
    near, best = np.bincount(a, minlength=len(words)), np.full(len(words), len(words))
    np.minimum.at(best, a, b)  # places are in the order of choice
    some = pa.array(np.flatnonzero(near))
    form = rows.take(pa.array(best[near > 0]))
    return pa.table({"word": rows["word"].take(some), "near": pa.array(near[near > 0], pa.int64()), "form": form["word"], "form_n": form["n"]})


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("s", "lo", "hi", "part").agg(F.count(F.lit(1)).alias("size"))


def blocks(words: DataFrame, block_words: int, most_words: int) -> DataFrame:
    """(word, n, s, lo, hi, part): the blocks in which each word meets others, each pair of near words in exactly one.

    A pair whose shorter word has s letters is of class s, so a word of m letters is in classes m and m - 1. Two near words share a first part and, behind the
    error, the rest. A block holds the pairs that share ``lo`` to ``hi`` - 1 first letters. One of more than ``most_words`` is cut in the middle: pairs that share
    more are found where the first ``mid`` letters are dealt by a hash, the others where the last s - mid are. In the end words of a block differ at one position
    only, so rounds of counts bring every block down, whichever part words have in common; there are about log2(letters) of them.
    """
    letters = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(letters, letters - 1)).alias("s")).where(F.col("s") >= LEAST_LETTERS)
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.col("s") + 1, "part": F.lit(0).cast("long")})
    done: list[DataFrame] = []
    while True:
        rows = materialise(rows, "spelling-blocks")
        # a row a block: stored, so that Spark knows its size and broadcasts it where it is small, and words of a wide block do not meet in a task
        sizes = materialise(_sizes(rows), "spelling-sizes")
        sized = rows.join(sizes, ["s", "lo", "hi", "part"])
        wide = (F.col("size") > most_words) & (F.col("hi") - F.col("lo") > 1)
        done.append(sized.where(~wide & (F.col("size") > 1)).drop("size"))
        if not sizes.where(wide).limit(1).count():
            break
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        # so many parts that a part has about a block's words, where no first or last part is shared by more
        dealt = lambda key, side: F.pmod(F.xxhash64(key, F.col("part"), F.lit(side)), F.ceil(F.col("size") / block_words))
        split = F.array(
            F.struct(mid.alias("lo"), F.col("hi"), dealt(F.substring("word", F.lit(1), mid), 1).alias("part")),
            F.struct(F.col("lo"), mid.alias("hi"), dealt(F.right("word", F.col("s") - mid), 2).alias("part")),
        )
        # the parts of a block are told apart by the block they come from
        own = F.xxhash64("lo", "hi", "part")
        rows = sized.where(wide).select("word", "n", "s", own.alias("_own"), F.inline(split)).select("word", "n", "s", "lo", "hi", F.xxhash64("_own", "part").alias("part"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, most_words: int = MOST_WORDS) -> DataFrame:
    """(word, near, form, form_n) of the words that have near ones: how many, and the one of largest n (ties: the smallest)."""
    found = blocks(words, block_words, most_words).groupBy("s", "lo", "hi", "part").applyInArrow(_of_block, "word string, near long, form string, form_n long")
    best = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), F.col("form"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("near"), best).select("word", "near", "b.form", "b.form_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form, by following twice as many forms a round; forms grow in frequency, so chains have ends and few rounds do."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("_of"), F.col("root").alias("_next"))
        joined = at.join(ahead, F.col("root") == F.col("_of"), "left")
        new = materialise(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        discard(at)
        at = new
        if not at.where("_moved").limit(1).count():
            return at.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_count: int = LEAST_COUNT, factor: int = FACTOR, block_words: int = BLOCK_WORDS, most_words: int = MOST_WORDS
) -> DataFrame:
    """word, form, root, n, n_near and form_n of the vocabulary.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z in lower case. Where 97 divides the crc32 of `<id>:<run>`, the run loses the letter whose number is that
    crc32 modulo its length. Of at least five letters and ``least_count`` occurrences each is a word. Near words differ by one letter inserted, deleted or replaced. The form of a word is its near word of largest
    n (ties: the smallest in code-point order) if that n is ``factor`` (2 or more) times its own, else null; the root follows forms to the last.

    Runs are counted where texts are, then by word. Near words are found in blocks of the vocabulary (:func:`blocks`), each a bit-sliced index by position and letter
    (:func:`near_pairs`); counts and best words leave a block, pairs do not. Roots come from doubled steps over the words that have forms.

    Null texts have no runs; a null identifier counts as the empty text; repeated rows count each; long runs are words like others. Other columns are not read; a table without words gives
    an empty result.
    """
    if factor < 2:
        raise ValueError("the factor is 2 or more, so that chains of forms have an end")
    words = materialise(word_counts(docs, id_col, text_col).where(F.col("n") >= least_count), "spelling-words")
    near = near_words(words, block_words, most_words).withColumnRenamed("word", "_of")
    joined = words.join(near, F.col("word") == F.col("_of"), "left")
    frequent: Column = F.col("form_n") >= factor * F.col("n")
    found = materialise(
        joined.select("word", F.when(frequent, F.col("form")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("form_n")).alias("form_n")), "spelling-near"
    )
    discard(words)
    ends = roots(found.where("form IS NOT NULL")).withColumnRenamed("word", "_of")
    return found.join(ends, F.col("word") == F.col("_of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents with forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents"))


# crc32 as a fold over bytes with a table of 256 remainders, which the SQL makes by the rule
OP11_SQL = r"""
WITH RECURSIVE rem(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM rem WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM rem WHERE k = 8),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
g AS (SELECT id, run, count(*) AS n FROM r GROUP BY ALL),
b AS (SELECT id, run, n, hex(encode(id || ':' || run)) AS x FROM g),
h AS (SELECT run, n, xor(list_reduce(list_transform(range(length(x) // 2), lambda k: ('0x' || substr(x, (2 * k + 1)::INT, 2))::BIGINT), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM b, tab),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1),
v AS MATERIALIZED (SELECT word, n, length(word) AS m FROM w WHERE n >= 3 AND length(word) >= 5),
cut AS MATERIALIZED (SELECT word, m, k, substr(word, 1, k::INT) || substr(word, (k + 2)::INT) AS rest FROM v, LATERAL (SELECT unnest(range(m)) AS k)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.m = b.m AND a.word != b.word
  UNION SELECT a.word, b.word FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT near.word, count(*) AS n_near, arg_min(v.word, (-v.n, v.word)) AS form, max(v.n) AS form_n FROM near JOIN v ON v.word = near.other GROUP BY near.word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form, CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain(word, root, step) AS (SELECT word, word, 0 FROM f UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) e USING (word)
"""
