"""How the words of sources differ within a language: exact divergences from run-length columns of counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textnp
from .common import materialise, table

#: Documents of a language that a term has to be in; the scale of probabilities; ranks of the terms that are told.
LEAST_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
#: Counts (terms x sources) of a slice of the vocabulary, about; terms that a task holds before it hands them on.
SLICE_COUNTS, HELD = 500_000, 400_000

_bytes = np.arange(256)
#: Letters and whatever is beyond ASCII.
TERM = ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term of each group, added up within tasks first."""

    def summed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        keys = ["lang", "source", "term"]
        yield from pa.concat_tables(held, promote_options="none").group_by(keys).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*keys, "n", "docs"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            groups = pa.table({"lang": batch.column(0), "source": batch.column(1)})
            for i, j, data, offsets in textnp.chunks(batch, "_t"):
                inside = TERM[data]
                start, end = textnp.runs(inside, offsets)
                if not len(start):
                    continue
                ends = np.concatenate([[0], np.cumsum(end - start)])
                terms = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(textnp.LOWER[data[inside]])]).dictionary_encode()
                row = np.searchsorted(offsets, start, side="right") - 1
                of_doc, n = np.unique(row * len(terms.dictionary) + terms.indices.to_numpy(), return_counts=True)
                row, term = np.divmod(of_doc, len(terms.dictionary))
                of = groups.take(pa.array(row + i))
                each = pa.table({"lang": of["lang"], "source": of["source"], "term": terms.dictionary.cast(pa.string()).take(pa.array(term)), "n": n, "docs": np.ones(len(n), dtype=np.int64)})
                held.append(each)
                rows += len(n)
                if rows >= HELD:
                    yield from summed(held)
                    held, rows = [], 0
        if held:
            yield from summed(held)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "_t"))))
    return plain.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total) in whole numbers, three decimal places at a time so that none overflows."""
    left, out = count + 1, F.lit(0).cast("long")
    whole = lambda a, b: F.call_function("div", a, b)
    for _ in range(3):
        scaled = left * 1000
        out = out * 1000 + whole(scaled, total)
        left = scaled % total
    return out + 1


def _probabilities(count: np.ndarray, total: int) -> np.ndarray:
    """As :func:`probability`."""
    left, out = count + 1, np.zeros(len(count), dtype=np.int64)
    for _ in range(3):
        out = out * 1000 + left * 1000 // total
        left = left * 1000 % total
    return out + 1


class Runs:
    """One source's counts over a slice of the vocabulary: where each run begins, its count and its probability."""

    def __init__(self, begin: np.ndarray, count: np.ndarray, total: int):
        fresh = np.ones(len(count), dtype=bool)
        fresh[1:] = count[1:] != count[:-1]
        self.begin = begin[fresh]
        self.p = _probabilities(count[fresh], total) if total else np.zeros(int(fresh.sum()), dtype=np.int64)

    def at(self, place: np.ndarray) -> np.ndarray:
        return self.p[np.searchsorted(self.begin, place, side="right") - 1]


def runs_of(places: np.ndarray, counts: np.ndarray, width: np.ndarray, before: np.ndarray, total: int) -> Runs:
    """Runs of a column that is 0 but at some of the slice's distinct vectors; ``width`` terms share a vector and ``before`` come ahead of it."""
    begin = np.concatenate([before[places], before[places] + width[places], [0]])
    count = np.concatenate([counts, np.zeros(len(places) + 1, dtype=np.int64)])
    # a run of 0 begins behind every count and at the front; a count that begins there takes its place
    order = np.lexsort((count == 0, begin))
    begin, count = begin[order], count[order]
    first = np.ones(len(begin), dtype=bool)
    first[1:] = begin[1:] != begin[:-1]
    return Runs(begin[first], count[first], total)


def divergence(a: Runs, b: Runs, terms: int) -> tuple[int, int]:
    """f summed over the slice for a against b and for b against a: the boundaries of both columns are intersected, and f counts as often as the run is long."""
    begin = np.union1d(a.begin, b.begin)
    begin = begin[begin < terms]
    length = np.diff(np.append(begin, terms))
    p, q = a.at(begin), b.at(begin)
    square = (p - q) * (p - q)
    return int((square // q * length).sum()), int((square // p * length).sum())


def _slice_pairs(batch: pa.Table) -> pa.Table:
    """(lang, source, item, value) of every pair of sources over one slice, from its distinct vectors and the sources' totals."""
    lang = batch["lang"][0]
    facts = batch.filter(pc.is_valid(batch["source"]))
    sources, totals = facts["source"].to_pylist(), facts["total"].to_pylist()
    vectors = batch.filter(pc.is_null(batch["source"])).combine_chunks().sort_by("key")
    width = vectors["terms"].to_numpy()
    before, terms = np.cumsum(width) - width, int(width.sum())
    lists = vectors["counts"].combine_chunks() if vectors.num_rows else None
    place_of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    if lists is not None:
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        place = np.repeat(np.arange(vectors.num_rows), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        coded = flat.field("source").dictionary_encode()
        code, n = coded.indices.to_numpy(), flat.field("n").to_numpy()
        order = np.argsort(code, kind="stable")
        ends = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
        place_of = {s: (place[order[ends[k] : ends[k + 1]]], n[order[ends[k] : ends[k + 1]]]) for k, s in enumerate(coded.dictionary.to_pylist())}
    none = np.zeros(0, dtype=np.int64)
    columns = [runs_of(*place_of.get(s, (none, none)), width, before, t) for s, t in zip(sources, totals, strict=True)]
    out: tuple[list, list, list] = ([], [], [])
    for i, a in enumerate(sources):
        for j in range(i):
            there, back = divergence(columns[i], columns[j], terms)
            for column, x in zip(out, ((a, sources[j]), (sources[j], a), (there, back)), strict=True):
                column.extend(x)
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.table({"lang": pa.array([lang.as_py()] * len(out[0]), pa.string())} | {c: pa.array(x, k) for c, x, k in zip(("source", "item", "value"), out, kinds, strict=True)})


def divergence_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, slice_counts: int = SLICE_COUNTS) -> DataFrame:
    """For every source of a language, how far its words are from each other source's, and the terms that it has most in excess of the language.

    Terms are runs of letters and of anything beyond ASCII, A-Z in lower case; each language keeps the terms that ``least_docs`` of its rows hold.
    p = 1 + floor(10^9 (count + 1) / (N + V)) for each of the V kept terms, N being the group's occurrences of them; f = floor((p - q)^2 / q), all in whole numbers.
    ``part`` is `pair` (item: another source of the language, q its p; value: f over all kept terms) or `term` (item: a kept term that the group has, with p > q, q that of the
    whole language; value: f; the first ``top``). ``rank`` counts from 1 in each group and part, by value descending and item ascending.

    The vocabulary is put in an order that brings terms of equal counts together: terms of one vector of counts are one entry with a width, vectors are sorted within
    slices, and every source's column over a slice is runs of equal counts. A pair of columns meets at the boundaries of their runs, and f is multiplied by the length.
    Slices hold about ``slice_counts`` counts and are dealt by a hash of the vector, so no term, source or language gathers in a task; only sums of pairs
    leave a slice. Its work is (pairs of sources) x (runs), which the result's own size, a row a pair, calls for.

    Null texts, languages and sources count as ''. A group without kept terms has N = 0; where a language keeps no term its pairs have value 0. A source that is
    alone in its language has no pairs. Rows have no identity here: repeated rows count each. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = materialise(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    # a row a kept term: its counts by source, sorted, which is its vector
    kept = counts.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"), F.sum("n").alias("whole"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    kept = materialise(kept, "divergence-kept")
    flat = kept.select("lang", "term", "whole", F.inline("counts"))
    sizes = materialise(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("whole").alias("lang_n")), "divergence-sizes")
    groups = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    totals = groups.join(flat.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(sizes, "lang", "left")
    totals = materialise(totals.select("lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_n", F.lit(0)).alias("lang_n")), "divergence-totals")

    # vectors of equal counts are one run; a slice holds about so many counts
    key = F.array_join(F.transform("counts", lambda x: F.concat_ws("\x01", x["source"], x["n"])), "\x02")
    vectors = kept.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms"))
    vectors = materialise(vectors, "divergence-vectors")
    # a row a language: stored, so that Spark knows its size and broadcasts it where it is small, and vectors of a language that most have do not meet in a task
    slices = materialise(vectors.groupBy("lang").agg(F.ceil(F.sum(F.size("counts")) / slice_counts).cast("int").alias("slices")), "divergence-slices")
    sliced = vectors.join(slices, "lang").select("lang", F.pmod(F.xxhash64("counts"), F.col("slices")).cast("int").alias("slice"), key.alias("key"), "counts", "terms", F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("total"))
    facts = totals.join(slices, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(None).cast("string").alias("key"), F.lit(None).cast(vectors.schema["counts"].dataType).alias("counts"), F.lit(None).cast("long").alias("terms"), "source", (F.col("group_n") + F.col("kept")).alias("total")
    )
    summed = sliced.unionByName(facts).groupBy("lang", "slice").applyInArrow(_slice_pairs, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # languages that keep no term
    bare = totals.where("kept = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = summed.unionByName(zero).withColumn("part", F.lit("pair"))

    p, q = probability(F.col("n"), F.col("group_n") + F.col("kept")), probability(F.col("whole"), F.col("lang_n") + F.col("kept"))
    excess = flat.join(totals, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = excess.select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"), F.lit("term").alias("part"))
    line = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    # the limit on ranks is taken within tasks before terms move
    terms = terms.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top)
    out = terms.unionByName(pairs.withColumn("rank", F.row_number().over(line)))
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of a language from the others, and its terms in excess."""
    return divergence_audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS w FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(w) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + l.v) AS p,
             1 + (1000000000::HUGEINT * (k.w + 1)) // (l.n + l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM u)
WHERE part = 'pair' OR rank <= 200
"""
