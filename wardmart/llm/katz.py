"""Word bigram scores by Katz backoff.

Counts are Good-Turing discounted, the backoff weight of a history is the
mass its seen continuations leave divided by the unigram mass of the words
not seen after it, so each history's distribution sums to one exactly. A
token is evaluated recursively: bigram, else backoff weight times unigram,
else the unknown word.

The n-gram counts lie in hash partitions of the words. A map task gathers
the distinct bigrams of a batch of documents with the documents that hold
them, as numpy columns, one blob for each partition; a partition sums a
bigram's counts over all batches and answers with the documents' sums, so
tokens are never joined one by one. The partitioned counts are a shuffle
that two jobs read (the discounts need all counts before any score), which
is why this operator works on an RDD of blobs. Words that make up a
``HOT``-th of all tokens or more, fewer than ``HOT`` of them, are known
beforehand: their bigrams are spread over all partitions.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, ship
from .words import MULTIPLIER, mix, words

CUTOFF = 5               # counts up to here are discounted by Good-Turing
RESERVE = 0.05           # what a larger count gives up, so that every history can back off
HOT = 2_000
BATCH_TOKENS = 500_000
BATCH_DOCS = 60_000      # document numbers of a batch fit in 16 bits
CHUNK = 20_000           # words hashed at once
BIG = 64                 # a bigram's documents stay with the batch from here on
PARTITION_BYTES = 16 << 20


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit SipHash of each word, the same in every process."""
    held = np.empty(len(words), object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False)


# words never hold white space, so these are no words
END, START = hashes_of([b"\n", b" "])
SHORT = np.uint64((1 << 48) - 1)         # histories are told apart by 48 bits

PAIRS, DOCS, LISTS, SUMS, EVENTS, PART, VALUES, ADJUST = range(8)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, 16-bit numbers by byte planes."""
    head = b"".join(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    body = b"".join(np.ascontiguousarray(a.view("u1").reshape(-1, 2).T).tobytes() if a.dtype.itemsize == 2
                    else a.tobytes() for a in arrays)
    blob = struct.pack("<I", len(arrays)) + head + body
    return struct.pack("<Q", len(blob)) + pa.Codec("zstd", 1).compress(blob, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    size, = struct.unpack_from("<Q", blob)
    blob = pa.Codec("zstd", 1).decompress(memoryview(blob)[8:], size, asbytes=True)
    n, = struct.unpack_from("<I", blob)
    at, out = 4 + 10 * n, []
    for k in range(n):
        kind, size = struct.unpack_from("<2sQ", blob, 4 + 10 * k)
        kind = np.dtype("<" + kind.decode())
        if kind.itemsize == 2:
            planes = np.frombuffer(blob, "u1", 2 * size, at).reshape(2, -1)
            out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        else:
            out.append(np.frombuffer(blob, kind, size, at))
        at += out[-1].nbytes
    return out


def shorten(h: np.ndarray) -> np.ndarray:
    """48-bit numbers as bytes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).ravel()


def lengthen(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = b.reshape(-1, 6)
    return out.view("<u8").ravel()


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(h * MULTIPLIER) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def good_turing(n: list[int]) -> np.ndarray:
    """Discounted counts r* of r = 0..CUTOFF from the numbers n[r] of types
    with count r (to CUTOFF + 1): Katz's form of Good-Turing, or, where the
    counts of counts do not allow it, an absolute discount."""
    k = CUTOFF
    if all(n[r] > 0 for r in range(1, k + 2)):
        common = (k + 1) * n[k + 1] / n[1]
        if common < 1:
            d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([0.0] + [r * x for r, x in enumerate(d, 1)])
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.array([0.0] + [r - off for r in range(1, k + 1)])


def discount(table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """r* of counts of any size."""
    return np.where(counts <= CUTOFF, table[np.minimum(counts, CUTOFF)], counts - RESERVE)


@dataclass
class Unigrams:
    """Constants of the unigram model and the hot words with their counts."""
    tokens: int
    types: int
    docs: int
    table: np.ndarray
    unknown: float
    hot: np.ndarray              # sorted 64-bit hashes
    hot_counts: np.ndarray
    hot_short: np.ndarray = field(init=False)   # sorted 48-bit histories, START among them
    hot_history: np.ndarray = field(init=False)  # their counts

    def __post_init__(self):
        h = np.r_[self.hot & SHORT, START & SHORT]
        order = np.argsort(h)
        self.hot_short, self.hot_history = h[order], np.r_[self.hot_counts, self.docs][order]

    def p(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a word by its count."""
        return np.where(counts > 0, discount(self.table, counts) / max(1, self.tokens), self.unknown)

    @staticmethod
    def find(among: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Index in a sorted array, or -1."""
        if not len(among):
            return np.full(len(x), -1)
        at = np.minimum(np.searchsorted(among, x), len(among) - 1)
        return np.where(among[at] == x, at, -1)


def _tokens(rows) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of documents: ids, held-out flags, trained-on flags, numbers of tokens, hashes of all tokens."""
    ids, held, train, size, hashes, flat, n = [], [], [], [], [], [], 0

    def batch():
        return (ids, np.array(held), np.array(train), np.array(size, np.int64),
                np.concatenate([*hashes, hashes_of(flat)]))

    for i, text, t, h in rows:
        ids.append(i)
        train.append(bool(t))
        held.append(bool(h))
        mine = words(text)
        size.append(len(mine) + 1)
        n += size[-1]
        flat += mine
        flat.append(b"\n")
        if len(flat) >= CHUNK:
            hashes.append(hashes_of(flat))
            flat = []
        if n >= BATCH_TOKENS or len(ids) >= BATCH_DOCS:
            yield batch()
            ids, held, train, size, hashes, flat, n = [], [], [], [], [], [], 0
    if ids:
        yield batch()


def _unigrams(source: DataFrame) -> Unigrams:
    """Count all training tokens."""
    def count(batches):
        seen, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, _, train, size, hashes in _tokens(rows):
            if train.any():
                w, c = np.unique(hashes[np.repeat(train, size)], return_counts=True)
                both, at = np.unique(np.r_[seen, w], return_inverse=True)
                times = np.bincount(at, np.r_[times, c], len(both)).astype(np.int64)
                seen = both
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(times)], ["w", "c"])

    counts = cut(source.mapInArrow(frugal(count), "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "katz-unigrams")
    n = [0] * (CUTOFF + 2)
    for r in counts.where(F.col("c") <= CUTOFF + 1).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():
        n[r.c] = r.n
    total = counts.agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types"),
                       F.max(F.when(F.col("w") == int(END.view(np.int64)), F.col("c"))).alias("docs")).first()
    tokens, types = total.tokens or 0, total.types
    # fewer than HOT + 1 words can have a HOT-th of all tokens
    hot = counts.where(F.col("c") * HOT >= tokens).collect()
    w = np.array([r.w for r in hot], np.int64).view(np.uint64)
    order = np.argsort(w)
    table = good_turing(n)
    given = sum(n[r] * (r - table[r]) for r in range(1, CUTOFF + 1)) + RESERVE * (types - sum(n[1:CUTOFF + 1]))
    return Unigrams(tokens, types, total.docs or 0, table, given / tokens if tokens else 1.0,
                    w[order], np.array([r.c for r in hot], np.int64)[order])


def _emit(parts: int, uni):
    """Blobs (key, (tag, batch, payload, ids)) of a partition's documents."""
    def emit(index, rows):
        u = uni()
        for seq, (ids, held, train, size, w) in enumerate(_tokens(rows)):
            batch = (index << 24) + seq
            h = np.r_[START, w[:-1]]
            first = np.cumsum(size) - size
            h[first] = START
            h &= SHORT
            doc = np.repeat(np.arange(len(ids)), size)
            yield batch % parts, (DOCS, batch, pack(held.astype("u1"), size), ids)

            pair = mix(w * MULTIPLIER + h)
            spread = Unigrams.find(u.hot, w) >= 0
            part = part_of(np.where(spread, pair, w), parts)
            # by partition, then word, then history; hashes of 24 bits order them well enough
            order = np.argsort((part.astype(np.uint64) << np.uint64(44))
                               | (w >> np.uint64(42) << np.uint64(22)) | (pair >> np.uint64(42)))
            w, h, doc, part = w[order], h[order], doc[order], part[order]
            new_w = np.r_[True, (w[1:] != w[:-1]) | (part[1:] != part[:-1])]
            at = np.flatnonzero(new_w | np.r_[True, h[1:] != h[:-1]])
            occurs = np.diff(np.r_[at, len(w)])
            trained = np.add.reduceat(train[doc].astype(np.int64), at)
            big = (occurs >= BIG) & (trained > 0)
            uid = np.flatnonzero(big)
            if len(uid):
                inside = np.repeat(big, occurs)
                yield batch % parts, (LISTS, batch, pack(uid.astype("<u4"), occurs[uid].astype("<u4"),
                                                         doc[inside].astype("<u2")), None)
            doc_small = doc[np.repeat(~big, occurs)].astype("<u2")
            listed = np.where(big, 0, occurs)
            ends = np.r_[0, np.cumsum(listed)]
            word_at = new_w[at]
            pair_part = part[at]
            cuts = np.flatnonzero(np.r_[True, pair_part[1:] != pair_part[:-1], True])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                starts = np.flatnonzero(word_at[lo:hi])
                mine = uid[(uid >= lo) & (uid < hi)]
                yield int(pair_part[lo]), (PAIRS, batch, pack(
                    w[at[lo:hi]][starts], np.diff(np.r_[starts, hi - lo]).astype("<u4"), shorten(h[at[lo:hi]]),
                    listed[lo:hi].astype("<u4"), trained[lo:hi].astype("<u4"), doc_small[ends[lo]:ends[hi]],
                    (mine - lo).astype("<u4"), mine.astype("<u4")), None)
    return emit


class Partition:
    """The bigrams of one hash partition, summed over all batches."""

    def __init__(self, blobs: list[tuple[int, bytes]], uni: Unigrams):
        self.batches = [b for b, _ in blobs]
        parts = [unpack(x) for _, x in blobs]
        self.parts = parts
        self.pairs = [len(p[3]) for p in parts]
        w_list = np.concatenate([p[0] for p in parts])
        w_pairs = np.concatenate([p[1] for p in parts]).astype(np.int64)
        self.h = lengthen(np.concatenate([p[2] for p in parts]))
        trained = np.concatenate([p[4] for p in parts])
        word, at = np.unique(w_list, return_inverse=True)
        word_of = np.repeat(at.astype(np.int32), w_pairs)
        c = np.bincount(word_of, trained, len(word)).astype(np.int64)
        hot = Unigrams.find(uni.hot, word)
        c[hot >= 0] = uni.hot_counts[hot[hot >= 0]]
        pair, first, self.pair_of = np.unique(mix(word[word_of] * MULTIPLIER + self.h),
                                              return_index=True, return_inverse=True)
        self.pair_of = self.pair_of.astype(np.int32)
        self.count = np.bincount(self.pair_of, trained, len(pair)).astype(np.int64)   # by distinct bigram
        self.pair_h = self.h[first]
        self.pair_c = c[word_of[first]]          # count of the bigram's word
        self.c = c[word_of]                      # the same by entry
        self.is_end = word[word_of] == END


def _by_key(rows) -> dict[int, dict[int, list]]:
    found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for key, (tag, batch, payload, ids) in rows:
        found[key][tag].append((batch, payload, ids))
    return found


def _statistics(uni):
    """Counts of counts of the bigrams, and what the hot histories' weights need."""
    def run(rows):
        u = uni()
        n = np.zeros(CUTOFF + 2, np.int64)
        hot = np.zeros((len(u.hot_short), CUTOFF + 3))
        for tags in _by_key(rows).values():
            if not tags[PAIRS]:
                continue
            p = Partition([(b, x) for b, x, _ in tags[PAIRS]], u)
            n += np.bincount(np.minimum(p.count, CUTOFF + 2), minlength=CUTOFF + 3)[:CUTOFF + 2]
            at = Unigrams.find(u.hot_short, p.pair_h)
            use = (at >= 0) & (p.count > 0)
            at, count, pu = at[use], p.count[use], u.p(p.pair_c[use])
            for r in range(1, CUTOFF + 1):
                hot[:, r] += np.bincount(at[count == r], minlength=len(hot))
            large = count > CUTOFF
            hot[:, 0] += np.bincount(at[large], count[large] - RESERVE, len(hot))
            hot[:, CUTOFF + 1] += np.bincount(at, pu, len(hot))
        yield n, hot
    return run


def backoff(star: np.ndarray, mass: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Backoff weights from the histories' discounted sums, the unigram mass
    of their seen continuations and their counts."""
    count = np.maximum(count, 1)
    return np.maximum(1 - star / count, 1e-300) / np.maximum(1 - mass, 1e-300)


def _answers(uni, table: np.ndarray, hot_alpha, parts: int):
    """What a partition says: sums by history, events of unseen bigrams, and
    the documents' sums."""
    def run(rows):
        u, alpha = uni(), hot_alpha()
        for key, tags in _by_key(rows).items():
            for tag in (DOCS, LISTS):
                for batch, payload, ids in tags[tag]:
                    yield key, (tag, batch, payload, ids)
            if not tags[PAIRS]:
                continue
            p = Partition([(b, x) for b, x, _ in tags[PAIRS]], u)
            # histories: discounted sum, unigram mass and count of the seen continuations
            cold = (Unigrams.find(u.hot_short, p.pair_h) < 0) & (p.count > 0)
            h, at = np.unique(p.pair_h[cold], return_inverse=True)
            count = p.count[cold]
            star = np.bincount(at, discount(table, count), len(h))
            mass = np.bincount(at, u.p(p.pair_c[cold]), len(h))
            total = np.bincount(at, count, len(h)).astype("<u4")
            for to, s in _cuts(part_of(h, parts)):
                yield int(to), (SUMS, 0, pack(shorten(h[s]), star[s], mass[s], total[s]), None)

            del h, at, count, star, mass, total, cold
            # each entry's share of a document's score and base score
            count = p.count[p.pair_of]
            seen = count > 0
            value = np.where(seen, np.log10(np.maximum(discount(table, count), 1e-300)), np.log10(u.p(p.c)))
            # the word is the next token's history: its bigram is divided by its count
            value -= np.where((p.c > 0) & ~p.is_end, np.log10(np.maximum(p.c, 1)), 0)
            hot = Unigrams.find(u.hot_short, p.h)
            value += np.where(~seen & (hot >= 0), alpha[hot], 0)
            event = ~seen & (hot < 0)
            base, known = np.log10(p.c + 1), p.c > 0
            at = 0
            for batch, n, (_, _, _, listed, _, docs, big, uid) in zip(p.batches, p.pairs, p.parts):
                s = slice(at, at + n)
                at += n
                owner = np.repeat(np.arange(n), listed.astype(np.int64))
                held, where = np.unique(docs, return_inverse=True)
                yield int(batch % parts), (PART, batch, pack(
                    held, np.bincount(where, value[s][owner], len(held)), np.bincount(where, base[s][owner], len(held)),
                    np.bincount(where, known[s][owner], len(held)).astype("<u4")), None)
                if len(uid):
                    yield int(batch % parts), (VALUES, batch, pack(uid, value[s][big], base[s][big]), None)
                open_ = event[s][owner]
                if open_.any():
                    eh, ed = p.h[s][owner[open_]], docs[open_]
                    to = part_of(eh, parts)
                    order = np.argsort(to, kind="stable")
                    for k, x in _cuts(to[order]):
                        yield int(k), (EVENTS, batch, pack(shorten(eh[order][x]), ed[order][x]), None)
    return run


def _cuts(to: np.ndarray):
    """(value, indices) of each distinct value."""
    order = np.argsort(to, kind="stable")
    at = np.flatnonzero(np.r_[True, to[order][1:] != to[order][:-1]]) if len(to) else np.empty(0, np.int64)
    for lo, hi in zip(at, np.r_[at[1:], len(to)]):
        yield to[order[lo]], order[lo:hi]


def _weights(parts: int):
    """Answer the events by the histories' backoff weights; sum up a batch."""
    def run(rows):
        for tags in _by_key(rows).values():
            sums = [unpack(x) for _, x, _ in tags[SUMS]]
            h, at = np.unique(lengthen(np.concatenate([s[0] for s in sums])), return_inverse=True) \
                if sums else (np.empty(0, np.uint64), np.empty(0, np.int64))
            star, mass, count = (np.bincount(at, np.concatenate([s[k] for s in sums]), len(h)) if sums
                                 else np.empty(0) for k in (1, 2, 3))
            log_weight = np.log10(backoff(star, mass, count)) + np.log10(np.maximum(count, 1))
            for batch, payload, _ in tags[EVENTS]:
                short, docs = unpack(payload)
                at = Unigrams.find(h, lengthen(short))
                held, where = np.unique(docs[at >= 0], return_inverse=True)
                if len(held):
                    yield batch % parts, (ADJUST, batch, pack(held, np.bincount(where, log_weight[at[at >= 0]],
                                                                               len(held))), None)
            doc_rows = {b: (payload, ids) for b, payload, ids in tags[DOCS]}
            values, lists = defaultdict(list), {b: unpack(x) for b, x, _ in tags[LISTS]}
            for batch, payload, _ in tags[VALUES]:
                values[batch].append(unpack(payload))
            parts_of = defaultdict(list)
            for batch, payload, _ in tags[PART]:
                parts_of[batch].append(unpack(payload))
            for batch, (payload, ids) in doc_rows.items():
                n = len(ids)
                score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
                for held, s, b, k in parts_of[batch]:
                    score[held] += s
                    base[held] += b
                    known[held] += k
                if batch in lists:
                    uid, occurs, docs = lists[batch]
                    got = [np.concatenate(x) for x in zip(*values[batch])]
                    order = np.argsort(got[0])
                    at = np.repeat(order[np.searchsorted(got[0][order], uid)], occurs.astype(np.int64))
                    score += np.bincount(docs, got[1][at], n)
                    base += np.bincount(docs, got[2][at], n)
                    known += np.bincount(docs, minlength=n)
                held, size = unpack(payload)
                yield batch % parts, (DOCS, batch, pack(held, size, score, base, known), ids)
    return run


def _rows(uni):
    """The documents' rows of each batch."""
    def run(rows):
        u = uni()
        log_docs = math.log10(u.docs) if u.docs else 0.0
        log_base = math.log10(u.tokens + u.types + 1)
        for tags in _by_key(rows).values():
            adjust = defaultdict(list)
            for batch, payload, _ in tags[ADJUST]:
                adjust[batch].append(unpack(payload))
            for batch, payload, ids in tags[DOCS]:
                held, size, score, base, known = unpack(payload)
                score = score.copy()
                for docs, value in adjust[batch]:
                    score[docs] += value
                for k, i in enumerate(ids):
                    yield (i, bool(held[k]), int(size[k]), int(known[k]), u.tokens,
                           float(base[k] - size[k] * log_base), float(score[k] - log_docs))
    return run


def katz_scores(docs: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id",
                text_col: str = "text", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    The model learns from the rows for which ``train`` holds (null: not).
    Null texts count as empty and have the end token only. score is the
    log10 probability of the words and the end by the bigram model,
    base_score the add-one unigram one; unknown words are one outcome of the
    unigram model. Without training rows every score is 0. Repeated rows
    count and are scored as often as they occur; null ids pass through. An
    empty table gives no rows. Other columns are not read. Words are told
    apart by 64-bit hashes, histories of a word by 48 bits.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    id_type = dict(docs.dtypes)[id_col]
    kind = "long" if id_type in ("bigint", "int", "smallint", "tinyint") else "string"
    source = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"),
                         train.alias("train"), held_out.alias("held"))
    unigrams = _unigrams(source)
    uni = ship(spark, unigrams)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // partition_bytes))

    counted = source.rdd.mapPartitionsWithIndex(frugal(_emit(parts, uni))).partitionBy(parts, int)

    zero = np.zeros(CUTOFF + 2, np.int64), np.zeros((len(unigrams.hot_short), CUTOFF + 3))
    n, hot = counted.mapPartitions(frugal(_statistics(uni))).treeAggregate(
        zero, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    table = good_turing(n.tolist())
    star = hot[:, 0] + hot[:, 1:CUTOFF + 1] @ table[1:]
    history = unigrams.hot_history
    alpha = np.log10(backoff(star, hot[:, CUTOFF + 1], history)) + np.log10(np.maximum(history, 1))
    alpha = ship(spark, np.where(history > 0, alpha, 0.0))

    answered = counted.mapPartitions(frugal(_answers(uni, table, alpha, parts))).partitionBy(parts, int)
    rows = answered.mapPartitions(frugal(_weights(parts))).partitionBy(parts, int).mapPartitions(_rows(uni))
    schema = (f"id {kind}, held_out boolean, n_tokens long, n_known long, "
              "train_tokens long, base_score double, score double")
    scored = spark.createDataFrame(rows, schema, verifySchema=False)
    return scored.select(F.col("id").cast(id_type).alias(id_col), *scored.columns[1:])
