"""Secret scan with corpus-wide ownership frequency.

Every text is searched for candidates. Each candidate's value is hashed and
the hashes are aggregated over the corpus by the distinct repositories and
owners that hold them: a value held by many owners is a widely copied
example, a value of a single owner that looks random is a credential that
may be live.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b, sha256
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, small

# The kinds and their patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")     # a run of 16 or more is one leftmost match
KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex")    # then the classes, in the order of a tie
MIN_ASSIGN, MIN_ACCESS = 12, 18

COPIED_OWNERS = 3        # owners from which on a value is a copied example
LIVE_BITS = 2.5          # least entropy per character of a live-looking value
BROADCAST_HASHES = 300_000


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, end, kind, value start, value end) of every base match, by
    start and kind; code points, ends exclusive."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        found += [(*m.span(), 0, *m.span(2)) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(*m.span(), 1, *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [(*m.span(), 2, *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def entropy(value: str) -> float:
    """Shannon entropy in bits per character; 0 unless letters and digits mix."""
    n = len(value)
    if value.isdigit() or not any(c.isdigit() for c in value):
        return 0.0
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


SPAN = "struct<start:long,end:long,kind:string,rank:int,vstart:long,vend:long,hash:string,bits:double>"


def _scan(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    id_type = dict(docs.dtypes)[id_col]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("rank", pa.int32()),
                      ("vstart", pa.int64()), ("vend", pa.int64()), ("hash", pa.string()), ("bits", pa.float64())])

    def scan(batches):
        for batch in batches:
            keys, spans, counts, digests = [], [], [[], [], []], []
            for text in batch.column(3).to_pylist():
                text = text or ""
                found = base_spans(text)
                keys.append(blake2b(text.encode(), digest_size=16).hexdigest() if found else None)
                spans.append([{"start": s, "end": e, "kind": KINDS[k], "rank": k, "vstart": vs, "vend": ve,
                               "hash": sha256(text[vs:ve].encode()).hexdigest(), "bits": entropy(text[vs:ve])}
                              for s, e, k, vs, ve in found])
                for k in range(3):
                    counts[k].append(sum(f[2] == k for f in found))
                line = ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k, _, _ in found)
                digests.append(sha256(line.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(keys, pa.string()), pa.array(spans, pa.list_(span)),
                 *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string())],
                ["id", "repo", "owner", "text_key", "spans", "n_assign", "n_access", "n_hex", "base_sha256"])

    return docs.select(F.col(id_col).alias("id"), repo.cast("string").alias("repo"),
                       owner.cast("string").alias("owner"), F.col(text_col).cast("string").alias("t")) \
        .mapInArrow(frugal(scan), f"id {id_type}, repo string, owner string, text_key string, spans array<{SPAN}>, "
                          "n_assign long, n_access long, n_hex long, base_sha256 string")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repos, occurrences, class) of rows (hash, owner, repo, bits).

    Distinct owners and repositories are counted by aggregating in two
    steps, so a value that a third of all rows holds is combined before each
    shuffle. A null owner or repository counts as one more of its kind.
    """
    pairs = candidates.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("bits").alias("bits"))
    by_owner = pairs.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"),
                                                  F.max("bits").alias("bits"))
    value = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"),
                                         F.sum("n").alias("occurrences"), F.max("bits").alias("bits"))
    kind = F.when(F.col("owners") >= COPIED_OWNERS, F.lit("copied")) \
        .when((F.col("owners") == 1) & (F.col("bits") >= LIVE_BITS), F.lit("live")).otherwise(F.lit("unclear"))
    return value.select("hash", "owners", "repos", "occurrences", kind.alias("class"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """One row per input row with its spans and their corpus-wide class.

    Columns: id, n_assign, n_access, n_hex, base_sha256, spans (struct array
    by start: the base spans, then for each value that is ``copied`` or
    ``live`` a span of that kind over the value), values (struct array:
    hash, class, owners, repos, occurrences), repo and owner as used.

    ``owner`` and ``repo`` default to the columns ``source`` and ``lang``
    within source. Null texts count as empty and hold nothing. Rows that
    repeat an id and a text each get the spans; rows that repeat an id with
    unlike texts keep their own. An empty table gives no rows. Other columns
    are not read.
    """
    bound_batches(docs.sparkSession)
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.col("source"), F.col("lang")) if repo is None else repo
    scanned = cut(_scan(docs, id_col, text_col, repo, owner), "secret-scan")
    held = scanned.where("size(spans) > 0")
    each = held.select("id", "text_key", "owner", "repo", F.explode("spans").alias("s"))
    classes = cut(ownership(each.select(F.col("s.hash").alias("hash"), "owner", "repo", F.col("s.bits").alias("bits"))),
                  "secret-classes")
    # a row for each text once, however often rows repeat it
    spots = each.select("id", "text_key", F.col("s.hash").alias("hash")).distinct()
    tagged = cut(spots, "secret-spots").join(small(classes, BROADCAST_HASHES), "hash") \
        .groupBy("id", "text_key").agg(F.collect_list(F.struct("hash", "class", "owners", "repos", "occurrences"))
                                       .alias("values"))
    tagged = cut(tagged.withColumnRenamed("id", "tid"), "secret-tagged")
    joined = held.join(tagged.withColumnRenamed("text_key", "tkey"),
                       F.col("id").eqNullSafe(F.col("tid")) & (F.col("text_key") == F.col("tkey")))

    def plain(kind: Column, start: Column, end: Column, rank: Column) -> Column:
        return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"), kind.alias("kind"))

    base = F.transform("spans", lambda s: plain(s["kind"], s["start"], s["end"], s["rank"]))

    def added(kind: str, rank: int) -> Column:
        hashes = F.transform(F.filter("values", lambda v: v["class"] == kind), lambda v: v["hash"])
        hits = F.filter("spans", lambda s: F.array_contains(hashes, s["hash"]))
        return F.transform(hits, lambda s: plain(F.lit(kind), s["vstart"], s["vend"], F.lit(rank)))

    all_spans = F.array_sort(F.array_distinct(F.concat(base, added("copied", 3), added("live", 4))))
    counts = ["n_assign", "n_access", "n_hex", "base_sha256"]
    # most rows hold nothing and bypass the join
    rest = scanned.where("size(spans) = 0").select(
        "id", *counts, F.expr("cast(array() as array<struct<start:long,rank:int,end:long,kind:string>>)").alias("spans"),
        F.expr("cast(array() as array<struct<hash:string,class:string,owners:long,repos:long,occurrences:long>>)")
        .alias("values"), "repo", "owner")
    return joined.select("id", *counts, all_spans.alias("spans"), "values", "repo", "owner") \
        .unionByName(rest).withColumnRenamed("id", id_col)


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
