"""Benchmark decontamination over item-sized windows.

A benchmark item is compared with the windows of a document that have as
many words as the item. Items and windows get SimHash fingerprints of their
weighted shingles; an index over blocks of the fingerprints' bits finds all
items of the window's length within a Hamming radius, and the exact weighted
Jaccard similarity of the shingles verifies them.

The j-th occurrence of a shingle is a feature of its own and counts with the
root of its weight, so texts of weighted Jaccard similarity t have a cosine
of 2t / (1 + t) at least, whatever the weights and repetitions. The
projections are Gaussian, so each bit differs with the angle's share of pi,
and the radius is the binomial quantile that a similar pair exceeds with a
chance of at most ``MISS``.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, ship
from .words import WordHashes, mix, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS = 128, 8     # of a fingerprint; a block has 16 bits
MISS = 1e-6
WINDOWS = 256             # compared with the items at once
# items whose tables one pass over the documents holds, in number and in text
ITEMS_PER_SCAN = 20_000
BYTES_PER_SCAN = 16 << 20

# ASCII punctuation and white space part words
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(PLAIN).split() if text else []


def hamming_radius(bits: int, similarity: float, miss: float) -> int:
    """Least radius that fingerprints of texts with that similarity exceed
    with a chance of at most ``miss``."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    left, radius = 1.0, -1
    while left > miss:
        radius += 1
        left -= math.comb(bits, radius) * p ** radius * (1 - p) ** (bits - radius)
    return radius


RADIUS = hamming_radius(BITS, SIMILARITY, MISS)


def projections() -> np.ndarray:
    """Two tables of Gaussian directions; a feature's direction is the sum of
    one of each. Their seed is fixed: fingerprints of all tasks agree."""
    return np.random.default_rng(20240229).standard_normal((2, 4096, BITS), np.float32)


def occurrences(shingles: np.ndarray) -> np.ndarray:
    """Features of a text: its shingles, repeated ones told apart by their
    number so far."""
    order = np.argsort(shingles, kind="stable")
    s = shingles[order]
    first = np.r_[True, s[1:] != s[:-1]]
    nth = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    out = shingles.copy()
    late = order[nth > 0]
    out[late] = mix(shingles[late] + nth[nth > 0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


class HammingIndex:
    """Fingerprints by blocks of 16 bits. Two that differ in ``radius`` bits
    at most differ in radius / blocks bits at most in one of the blocks, so
    looking up near block values loses none."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints                            # (n, BITS / 64)
        self.tables = []
        for block in np.ascontiguousarray(prints).view(np.uint16).reshape(-1, BLOCKS).T:
            values, place = np.unique(block, return_inverse=True)
            self.tables.append((values, place))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) of all pairs within the radius, by query."""
        found = []
        for low in range(0, len(queries), WINDOWS):
            part = np.ascontiguousarray(queries[low:low + WINDOWS])
            blocks = part.view(np.uint16).reshape(-1, BLOCKS).T
            near = np.zeros((len(part), len(self.prints)), bool)
            for block, (values, place) in zip(blocks, self.tables):
                near |= (np.bitwise_count(block[:, None] ^ values) <= radius // BLOCKS)[:, place]
            # where the blocks rule out little, distances of all pairs cost less than to gather the pairs left
            if 8 * np.count_nonzero(near) > near.size:
                distance = sum(np.bitwise_count(q[:, None] ^ p) for q, p in zip(part.T, self.prints.T))
                near &= distance <= radius
            query, item = np.nonzero(near)
            far = np.bitwise_count(part[query] ^ self.prints[item]).sum(axis=1) > radius
            found.append((query[~far] + low, item[~far]))
        return tuple(np.concatenate(x) for x in zip(*found))


def shingle_counts(texts: DataFrame) -> tuple[int, DataFrame]:
    """Number of the distinct item texts; (shingle, df, blocks) of the
    shingles of more than one block, with their document frequency over all."""
    def scan(batches):
        memo = WordHashes()
        for batch in batches:
            shingles, held = [], []
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.unique(shingle_hashes(memo.of(text.split(b" ")), SHINGLE)).view(np.int64)
                shingles += [pa.array([None], pa.int64()), pa.array(own)]   # null counts the item
                held.append(np.full(len(own) + 1, block, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(shingles) if shingles else pa.array([], pa.int64()),
                 pa.array(np.concatenate(held) if held else np.empty(0, np.int32))], ["shingle", "block"])

    counts = cut(texts.select("block", "words").mapInArrow(frugal(scan), "shingle long, block int").groupBy("shingle")
                 .agg(F.count(F.lit(1)).alias("df"), F.collect_set("block").alias("blocks"))
                 .where("shingle is null or size(blocks) > 1"), "item-shingles")
    n = counts.where("shingle is null").first()
    return n.df if n else 0, counts.where("shingle is not null")


class Items:
    """Shingles, weights, fingerprints and indexes of a block of distinct
    item texts, given as (key, words).

    ``n`` is the number of all distinct texts, ``shared`` (shingles, df) the
    document frequency over all of them of shingles that other blocks hold
    too; without them the block is taken for all.
    """

    def __init__(self, rows: list[tuple[int, list[bytes]]], n: int | None = None,
                 shared: tuple[np.ndarray, np.ndarray] | None = None):
        memo = WordHashes(limit=1 << 40)
        self.keys = [key for key, _ in rows]
        hashes = [memo.of(words) for _, words in rows]
        self.vocabulary = dict(memo)
        self.length = np.array([len(h) for h in hashes], np.int64)
        self.sizes = np.unique(np.minimum(self.length, SHINGLE)).tolist()
        shingles = [shingle_hashes(h, SHINGLE) for h in hashes]
        all_, df = np.unique(np.concatenate([np.unique(s) for s in shingles]), return_counts=True) \
            if shingles else (np.empty(0, np.uint64), np.empty(0))
        if shared is not None:
            df = df.copy()
            df[np.searchsorted(all_, shared[0])] = shared[1]
        n = max(1, len(shingles) if n is None else n)
        self.known, self.weight = all_, np.log1p(n / df)
        self.unknown = float(np.log1p(n))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(all_ >> np.uint64(44)).astype(np.int64)] = True
        # sorted features of each item and their weights
        self.features = [np.sort(occurrences(s)) for s in shingles]
        weights = [self.weights(s) for s in shingles]
        self.total = np.array([w.sum() for w in weights])
        self.projections = projections()
        self.groups = {}
        for length in np.unique(self.length).tolist():
            items = np.flatnonzero(self.length == length)
            prints = np.stack([self._print(occurrences(shingles[i]), weights[i]) for i in items])
            self.groups[length] = items, HammingIndex(prints)

    def _directions(self, features: np.ndarray, weights: np.ndarray) -> np.ndarray:
        low = (features & np.uint64(4095)).astype(np.int64)
        high = (features >> np.uint64(12) & np.uint64(4095)).astype(np.int64)
        return (self.projections[0, low] + self.projections[1, high]) * np.sqrt(weights).astype(np.float32)[:, None]

    @staticmethod
    def _packed(sums: np.ndarray) -> np.ndarray:
        return np.packbits(sums > 0, axis=-1).view(np.uint64)

    def _print(self, features: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self._packed(self._directions(features, weights).sum(axis=0))

    def prints(self, shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        """Fingerprints of the windows of ``width`` shingles at ``starts``."""
        # windows that hold a shingle twice are taken one by one
        order = np.argsort(shingles, kind="stable")
        twin = np.flatnonzero(shingles[order[1:]] == shingles[order[:-1]])
        before, after = order[twin], order[twin + 1]
        near = after - before < width
        change = np.zeros(len(shingles) + 2, np.int64)
        np.add.at(change, np.maximum(after[near] - width + 1, 0), 1)
        np.add.at(change, before[near] + 1, -1)
        repeated = np.cumsum(change)[starts] > 0
        out = np.empty((len(starts), BITS // 64), np.uint64)
        plain = np.flatnonzero(~repeated)
        # running sums over stretches, so that they stay short and exact
        for low in range(0, len(plain), WINDOWS):
            some = plain[low:low + WINDOWS]
            cuts = np.flatnonzero(np.diff(starts[some]) > 2 * width) + 1
            for run in np.split(some, cuts):
                first, end = starts[run[0]], starts[run[-1]] + width
                sums = np.zeros((end - first + 1, BITS), np.float64)
                np.cumsum(self._directions(shingles[first:end], weights[first:end]), axis=0, out=sums[1:])
                at = starts[run] - first
                out[run] = self._packed(sums[at + width] - sums[at])
        for k in np.flatnonzero(repeated):
            span = slice(starts[k], starts[k] + width)
            out[k] = self._print(occurrences(shingles[span]), weights[span])
        return out

    def found(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles an item holds."""
        out = self.filter[(shingles >> np.uint64(44)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            where = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            out[at] = self.known[where] == shingles[at]
        return out

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), self.unknown)
        known = self.found(shingles)
        out[known] = self.weight[np.searchsorted(self.known, shingles[known])]
        return out

    def similarities(self, shingles: np.ndarray, weights: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Exact weighted Jaccard similarity of a window and each item."""
        features = occurrences(shingles)
        order = np.argsort(features)
        features, w = features[order], weights[order]
        held = [self.features[i] for i in items]
        flat = np.concatenate(held)
        at = np.minimum(np.searchsorted(features, flat), len(features) - 1)
        both = np.where(features[at] == flat, w[at], 0.0)
        shared = np.add.reduceat(both, np.cumsum([0, *[len(h) for h in held[:-1]]]))
        return shared / (w.sum() + self.total[items] - shared)

    def may_match(self, words: list[bytes]) -> bool:
        """Whether a text holds an item's shingle; without one no window has
        any similarity. Only the items' own words are hashed for it."""
        hashes = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        return any(self.found(shingle_hashes(hashes, size)).any() for size in self.sizes if size <= len(words))

    def matches(self, hashes: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, start word, words, similarity): each item's best window."""
        best: dict[int, tuple[float, int, int]] = {}
        cache = {}
        for length in self.groups:
            words = min(length, len(hashes))
            size = min(SHINGLE, length)
            if words < size:
                continue
            if size not in cache:
                shingles = shingle_hashes(hashes, size)
                cache[size] = shingles, self.found(shingles)
            shingles, known = cache[size]
            if not known.any():
                continue
            width = words - size + 1
            # only windows around known shingles have any similarity
            at = np.flatnonzero(known)
            lo, hi = max(0, at[0] - width), min(len(shingles), at[-1] + width + 1)
            part, hit = shingles[lo:hi], known[lo:hi]
            w = self.weights(part)
            total, held = np.r_[0, np.cumsum(w)], np.r_[0, np.cumsum(w * hit)]
            starts = np.arange(len(part) - width + 1)
            # the similarity is at most the known share of the window's weight
            share = (held[starts + width] - held[starts]) / (total[starts + width] - total[starts])
            starts = starts[share >= SIMILARITY - 1e-9]
            if not len(starts):
                continue
            items, index = self.groups[length]
            window, near = index.within(self.prints(part, w, starts, width), RADIUS)
            for k, few in zip(*_grouped(window, near)):
                s = int(starts[k])
                for item, sim in zip(items[few].tolist(), self.similarities(part[s:s + width], w[s:s + width],
                                                                             items[few]).tolist()):
                    if sim >= SIMILARITY - 1e-12 and (item not in best or sim > best[item][0] + 1e-12):
                        best[item] = (sim, lo + s, words)
        return [(i, s, n, sim) for i, (sim, s, n) in sorted(best.items())]


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct sorted keys and the values of each."""
    if not len(keys):
        return keys, []
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.r_[0, cuts]], np.split(values, cuts)


def _item_texts(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Written tables (item, key) of the items with words and (key, words,
    block) of their distinct texts; words are joined by single spaces."""
    item_type = dict(benchmark.dtypes)[item_col]

    def scan(batches):
        for batch in batches:
            words = [b" ".join(plain_words(t)) or None for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], ["item", "words"])

    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("t")) \
        .mapInArrow(frugal(scan), f"item {item_type}, words binary").where("words is not null")
    rows = cut(rows.withColumn("key", F.sha2("words", 256)), "items")
    texts = rows.groupBy("key").agg(F.first("words").alias("words"))
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("words")).alias("b")).first()
    blocks = max(1, -(-size.n // ITEMS_PER_SCAN), -(-(size.b or 0) // BYTES_PER_SCAN))
    return rows.select("item", "key"), cut(texts.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")),
                                           "item-texts")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, start_word, n_words, similarity): for every document and
    item that the document holds with weighted similarity 0.8 or more, the
    best window, the first of equals.

    Words are lower-cased without ASCII punctuation and shingled by five; an
    item of fewer words is one shingle of them all. A document shorter than
    an item is compared whole. Null, empty and word-less texts match
    nothing, repeated documents and items each match, rows with a null id
    are reported under null. No documents or no items give no rows. Other
    columns are not read.

    Items are a query set. Items of equal words are one text, searched once;
    the texts are taken in blocks of some ``ITEMS_PER_SCAN`` texts and
    ``BYTES_PER_SCAN`` bytes, by a hash of the words, each a pass over the
    documents. A shingle weighs log(1 + n / df) over all distinct texts,
    whatever the blocks.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    id_type, item_type = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    names, distinct = _item_texts(benchmark, item_col, item_text_col)
    blocks = [r.block for r in distinct.select("block").distinct().orderBy("block").collect()]
    n = counts = found = None
    if len(blocks) > 1:
        n, counts = shingle_counts(distinct)
    for block in blocks:
        rows = distinct.where(F.col("block") == block).select("key", "words").collect()
        others = None
        if counts is not None:
            held = counts.where(F.array_contains("blocks", block)).select("shingle", "df").toArrow()
            others = held.column(0).to_numpy().view(np.uint64), held.column(1).to_numpy()
        shared = ship(spark, Items([(r.key, bytes(r.words).split(b" ")) for r in rows], n, others))

        def scan(batches, shared=shared):
            table, memo = shared(), WordHashes()
            for batch in batches:
                at, out = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    words = plain_words(text)
                    if words and table.may_match(words):
                        got = table.matches(memo.of(words))
                        at += [k] * len(got)
                        out += got
                ids, starts, sizes, sims = zip(*out) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array([table.keys[i] for i in ids], pa.string()),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sims, pa.float64())],
                    ["id", "key", "start_word", "n_words", "similarity"])

        part = cut(texts.mapInArrow(frugal(scan), f"id {id_type}, key string, start_word long, n_words long, "
                                    "similarity double"), "contamination")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"id {id_type}, key string, start_word long, n_words long, similarity double")
    return found.join(names, "key").select(F.col("id").alias(id_col), F.col("item").cast(item_type).alias("item_id"),
                                           "start_word", "n_words", "similarity")
