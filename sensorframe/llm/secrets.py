"""Secret scan whose findings are judged by who else, in the whole corpus, holds the same value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, spread_join, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group of the value, least length of the value; the base kinds come first.
BASE = [("assign", ASSIGN, 2, 6), ("access", r"(AKIA[A-Z0-9]+)", 1, 20), ("hex", r"([0-9a-f]+)", 1, 24)]
#: Kinds of the method itself. Runs are possessive or begin where a run begins, so that time grows with the text alone, whatever the lengths.
TOKEN = "A-Za-z0-9+/_-"
MORE = [
    ("github", r"(gh[pousr]_[A-Za-z0-9]{20,})", 1, 20),
    ("slack", r"(xox[abprs]-[A-Za-z0-9-]{10,})", 1, 10),
    ("google", r"(AIza[0-9A-Za-z_-]{35})", 1, 39),
    ("jwt", r"((?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)", 1, 20),
    ("pem", r"-----BEGIN (?:(?:RSA|DSA|EC|OPENSSH|ENCRYPTED|PGP|ED25519) )?PRIVATE KEY(?: BLOCK)?-----\s*+([A-Za-z0-9+/=\s]{16,}+)", 1, 16),
    ("url", r"(?<=[a-z0-9+.-])://[^\s:@/]*+:([^\s:@/]{3,}+)@", 1, 3),
    ("mixed", rf"((?<![{TOKEN}])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])(?=[A-Za-z+/_-]*+[0-9])[{TOKEN}]{{32,}}+)", 1, 32),
]
#: Cheaper patterns that hold wherever the whole one does.
GUARD = {"url": "://", "pem": "-----BEGIN", "hex": r"[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}", "mixed": r"[A-Za-z0-9+/_-]{32}"}
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,hash:string>>"


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """All leftmost non-overlapping matches of a pattern whose value is long enough, in code points, with the digest of the value.

    What lies between the matches comes from ``split``, the matches themselves from
    ``regexp_extract_all``; their lengths add up to the offsets.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.when(F.length(v) >= least, F.sha2(v, 256)))
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("hash"))

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["hit"], F.lit(0))
        found = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), part["hash"].alias("hash"))
        return F.struct(end.alias("at"), F.when(part["hash"].isNotNull(), F.concat(state["found"], F.array(found))).otherwise(state["found"]).alias("found"))

    none = F.lit(None).cast(SPAN)
    empty = F.coalesce(none, F.array().cast(SPAN))
    all_spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("found")), add, lambda s: s["found"])
    return F.when(text.rlike(GUARD.get(kind, pattern)), all_spans).otherwise(empty)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then by kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_cols: tuple[str, ...] = ("source",),
    repo_cols: tuple[str, ...] = ("source", "lang"),
    most_owners: int = 4,
    most_repos: int = 8,
) -> DataFrame:
    """Find secrets in every text and separate live-looking credentials from copied examples.

    Every match of a base kind or of a kind of the method is a candidate. The hashes of all
    candidates are counted over the corpus by distinct owners and by distinct repositories
    (``owner_cols``, ``repo_cols``; a null is a name of its own). A value that at most
    ``most_owners`` owners and ``most_repos`` repositories hold is ``live``, others are ``example``.
    A few copies by a crawl do not make an example of a credential. Spans of all kinds are reported with their verdict. Values leave the
    text as SHA-256 digests only: no table that is written or returned holds one in clear.

    Returns one row per input row: id, base (array of spans: start, end, kind, hash), spans
    (the same with verdict, owners, repos). Offsets count code points, ends are exclusive.
    Null and empty texts have empty arrays, rows that repeat are scanned as any other. Columns of
    ``docs`` besides those named are not read. Counting is done by (value, owner,
    repository) first, so a value that a third of the rows hold is summed up where it is read, and its verdict reaches them in parts.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    name = lambda cols: F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols))
    kinds = [*BASE, *MORE]
    read = docs.select(F.col(id_col).alias("_id"), name(owner_cols).alias("_owner"), name(repo_cols).alias("_repo"), t.alias("_t"))
    found = materialise(
        read.select(
            F.monotonically_increasing_id().alias("_row"), "_id", "_owner", "_repo",
            F.concat(*(_spans(F.col("_t"), i, *k) for i, k in enumerate(kinds[: len(BASE)]))).alias("_base"),
            F.concat(*(_spans(F.col("_t"), i + len(BASE), *k) for i, k in enumerate(MORE))).alias("_more"),
        ),
        "secrets",
    )
    hits = found.where((F.size("_base") > 0) | (F.size("_more") > 0)).select("_row", "_owner", "_repo", F.explode(F.concat("_base", "_more")).alias("_s"))
    hits = hits.withColumn("_hash", F.col("_s.hash"))
    by_repo = hits.groupBy("_hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    held = materialise(by_owner.groupBy("_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.sum("n").alias("copies")), "secret-owners")
    live = (F.col("owners") <= most_owners) & (F.col("repos") <= most_repos)
    judged = spread_join(hits, held, "_hash", "copies", "_row").withColumn("_live", live)
    span = F.struct(
        F.col("_s.start").alias("start"), F.col("_s.rank").alias("rank"), F.col("_s.end").alias("end"), F.col("_s.kind").alias("kind"),
        F.col("_hash").alias("hash"), F.when(F.col("_live"), "live").otherwise("example").alias("verdict"), "owners", "repos",
    )
    spans = judged.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,hash:string,verdict:string,owners:bigint,repos:bigint>>")
    return found.join(spans, "_row", "left").select(F.col("_id").alias(id_col), F.array_sort("_base").alias("base"), F.coalesce("spans", none).alias("spans"))


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: base spans, all spans, and how many look live."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    verdict = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long").alias(f"n_{v}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), verdict("live"), verdict("example"),
    )
