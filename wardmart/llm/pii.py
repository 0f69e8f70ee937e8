"""Personal data: fixed patterns plus bootstrapped contextual extraction.

Entities of the fixed patterns are seeds. The words around a seed induce
lexical patterns, and the same patterns are read off around every other
identifier-like token. Spark scores this graph of patterns and instances
round by round: a pattern is confident if nearly all identifiers it holds
are known ones of one kind; unseen identifiers in confident patterns become
known, which makes further patterns confident.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, small

# The kinds and their patterns. Runs are possessive and start
# at their first character, which finds the same and stays linear.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Identifier-like tokens: a run of these characters without punctuation at
# its ends, of five characters or more, that holds three digits or an @.
TOKEN = re.compile(r"[A-Za-z0-9@._%+#/-]+")
HIT = re.compile(r"[0-9@]")
TRIMMED = "@._%+#/-"
DIGIT = re.compile(r"[0-9]")

ROUNDS = 4
CONFIDENT = 0.7     # Wilson bound of a pattern's share of known instances
ACCEPTED = 0.8      # of an unseen instance: 1 - product of (1 - confidence)
Z = 1.96
BROADCAST_ROWS = 200_000    # patterns, instances and tagged rows (some 100 bytes each)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every match that holds, by kind and start; code
    points, ends exclusive."""
    found = []
    if "@" in text:
        found += [(0, *m.span()) for m in EMAIL.finditer(text) if m.group(1)]
    first = DIGIT.search(text)
    if first is None:
        return found
    found += [(1, *m.span()) for m in IP.finditer(text, first.start())
              if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m.group().split(".")))]
    for m in CARD.finditer(text, first.start()):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text)
                  if 8 <= len(DIGIT.findall(m.group())) <= 15]
    return found


def identifiers(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens that touch no span of ``taken``."""
    spans = sorted((s, e) for _, s, e in taken)
    starts, ends, reach = [s for s, _ in spans], [], 0
    for _, e in spans:
        reach = max(reach, e)
        ends.append(reach)
    out, at = [], 0
    while (hit := HIT.search(text, at)) is not None:
        start = hit.start()
        while start > at and TOKEN.match(text[start - 1]):
            start -= 1
        at = TOKEN.match(text, hit.start()).end()
        token = text[start:at]
        low, high = start + len(token) - len(token.lstrip(TRIMMED)), start + len(token.rstrip(TRIMMED))
        kept = text[low:high]
        if high - low >= 5 and ("@" in kept or len(DIGIT.findall(kept)) >= 3):
            before = bisect_right(starts, high - 1)
            if not before or ends[before - 1] <= low:
                out.append((low, high))
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: two words before it, and a word
    on either side; lower-cased, digits as 0. None without a letter before."""
    near = DIGIT.sub("0", text[max(0, start - 80):start].lower()).split()[-2:]
    if not near or not any(c.isalpha() for c in near[-1]):
        return []
    after = DIGIT.sub("0", text[end:end + 40].lower()).split()[:1]
    return [" ".join([*near, "_"])] * (len(near) > 1) + [f"{near[-1]} _ {after[0] if after else '$'}"]


OCCURRENCE = "struct<start:long,end:long,kind:int,instance:long,patterns:array<string>>"


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = dict(docs.dtypes)[id_col]
    occurrence = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                            ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))])

    def scan(batches):
        for batch in batches:
            counts, digests, found = [[] for _ in KINDS], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                for k, column in enumerate(counts):
                    column.append(sum(b[0] == k for b in base))
                digests.append(sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base).encode()).hexdigest())
                found.append([{"start": s, "end": e, "kind": k, "patterns": contexts(text, s, e),
                               "instance": int.from_bytes(blake2b(text[s:e].lower().encode(), digest_size=8).digest(),
                                                          "little", signed=True)}
                              for k, s, e in base + [(-1, *i) for i in identifiers(text, base)]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(found, pa.list_(occurrence))],
                ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "found"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")) \
        .mapInArrow(frugal(scan), f"id {id_type}, " + "".join(f"n_{k} long, " for k in KINDS)
                    + f"base_sha256 string, found array<{OCCURRENCE}>")


def confidence(known: Column, total: Column) -> Column:
    """Lower end of Wilson's interval for the share known / total."""
    share = known / total
    spread = F.sqrt(share * (1 - share) / total + Z * Z / (4 * total * total))
    return (share + Z * Z / (2 * total) - Z * spread) / (1 + Z * Z / total)


def bootstrap(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (pattern, kind, confidence) and accepted instances
    (instance, kind, score) of a written table of distinct (pattern,
    instance, kind): kind 0 to 3 for seeds, -1 for unseen identifiers.

    A pattern counts every distinct instance once, however many rows repeat
    it. Trust and evidence are summed in whole thousandths and millionths,
    so a threshold never depends on the order of rows. Rounds end when no
    further instance is accepted, after ``ROUNDS`` at the latest.
    """
    spark = edges.sparkSession
    accepted = spark.createDataFrame([], "instance long, kind int, score double")
    patterns, before = None, 0
    for _ in range(ROUNDS):
        learned = small(accepted, BROADCAST_ROWS).select(
            "instance", F.col("kind").alias("learned"), F.round(F.col("score") * 1000).cast("long").alias("trust"))
        known = edges.join(learned, "instance", "left").select(
            "pattern", F.when(F.col("kind") >= 0, F.col("kind")).otherwise(F.col("learned")).alias("kind"),
            F.when(F.col("kind") >= 0, F.lit(1000)).otherwise(F.col("trust")).alias("trust"))
        share = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("trust"))), F.lit(0)) for k in range(len(KINDS))]
        sums = known.groupBy("pattern").agg(
            F.count(F.lit(1)).alias("total"),
            F.greatest(*[F.struct(s.alias("trust"), F.lit(-k).alias("neg")) for k, s in enumerate(share)]).alias("best"))
        sure = confidence(F.col("best.trust") / 1000, F.col("total"))
        patterns = cut(sums.select("pattern", (-F.col("best.neg")).alias("kind"), sure.alias("confidence"))
                       .where(F.col("confidence") >= CONFIDENT), "pii-patterns")
        hits = edges.where("kind < 0").select("pattern", "instance").join(small(patterns, BROADCAST_ROWS), "pattern")
        evidence = F.sum(F.round(-F.log1p(-F.col("confidence")) * 1_000_000).cast("long"))
        scored = hits.groupBy("instance", "kind").agg((1 - F.exp(-evidence / 1_000_000)).alias("score")) \
            .where(F.col("score") >= ACCEPTED)
        best = F.max(F.struct("score", (-F.col("kind")).alias("neg"))).alias("best")
        accepted = cut(scored.groupBy("instance").agg(best).select(
            "instance", (-F.col("best.neg")).alias("kind"), F.col("best.score").alias("score")), "pii-instances")
        count = accepted.count()
        if count == before:
            break
        before = count
    return patterns, accepted


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_context.

    ``spans`` (struct array: kind, start, end by kind as listed, then start)
    holds the base spans and, as kinds ``context_email`` and so on, the
    unseen identifiers that the bootstrapping accepted, where they stand in
    a confident pattern of their kind; ``n_context`` counts these. Null
    texts count as empty and hold nothing. Every row, also one that repeats
    an id or has none, keeps the spans of its own text. An empty table gives
    an empty result. Other columns are not read.
    """
    bound_batches(docs.sparkSession)
    scanned = cut(_scan(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    each = scanned.where("size(found) > 0").select("row", F.explode("found").alias("f")).select("row", "f.*")
    edges = cut(each.select(F.explode("patterns").alias("pattern"), "instance", "kind")
                .groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-graph")
    patterns, accepted = bootstrap(edges)
    unseen = each.where("kind < 0").select("row", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    hits = unseen.join(small(accepted, BROADCAST_ROWS).select("instance", "kind"), "instance") \
        .join(small(patterns, BROADCAST_ROWS).select("pattern", "kind"), ["pattern", "kind"])
    tags = cut(hits.select("row", F.struct((F.col("kind") + len(KINDS)).alias("rank"), "start", "end").alias("s"))
               .groupBy("row").agg(F.collect_set("s").alias("more")), "pii-tags")
    base = F.transform(F.filter("found", lambda f: f["kind"] >= 0),
                       lambda f: F.struct(f["kind"].alias("rank"), f["start"].alias("start"), f["end"].alias("end")))
    more = F.coalesce("more", F.expr("cast(array() as array<struct<rank:int,start:long,end:long>>)"))
    names = F.array(*[F.lit(k) for k in KINDS + tuple(f"context_{k}" for k in KINDS)])
    spans = F.transform(F.array_sort(F.concat(base, more)),
                        lambda s: F.struct(names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.join(small(tags, BROADCAST_ROWS), "row", "left").select(
        F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"),
        F.size(more).cast("long").alias("n_context"))
