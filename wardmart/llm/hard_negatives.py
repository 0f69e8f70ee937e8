"""Hard-negative mining with Four-Russians scoring.

Components are floored to integers. For a block of anchors every group of
eight dimensions gets a table of the sums of all 256 subsets; a candidate's
components are packed into bit planes, a byte for each plane and group. A
score is then a sum of table rows looked up by those bytes, doubled from
plane to plane: exact integer inner products of one candidate with all
anchors of a block at once.

A pass over the rows of an anchor's own label finds its positives, a second
one over the others the negatives whose score lies in each positive's band.
Every task keeps the best rows it has met; Spark merges the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, ship

PASS_BYTES = 16 << 20       # anchors broadcast for one pass over the rows
ANCHORS, ROWS = 256, 1_024  # anchors and candidates scored at once
LEAST = np.iinfo(np.int64).min


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of eight components,
    in the smallest type that holds the sum of a whole plane."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    largest = int(np.abs(anchors).sum(axis=1).max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max)
    padded = np.zeros((n, groups * 8), kind)
    padded[:, :dims] = anchors
    sums = np.zeros((groups, 256, n), kind)
    for j in range(8):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + padded[:, j::8].T[:, None, :]
    return sums


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows): bytes of the two's complement bits of every
    component, the sign plane last."""
    least, most = int(rows.min(initial=0)), int(rows.max(initial=0))
    planes = max(most.bit_length(), (-least - 1).bit_length() if least < 0 else 0) + 1
    return np.stack([np.packbits((rows >> b & 1).astype(np.uint8), axis=1, bitorder="little").T
                     for b in range(planes)])


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products."""
    count, groups, n = planes.shape
    if not groups:
        return np.zeros((n, sums.shape[2]), np.int64)
    most = int(np.abs(sums.astype(np.int64)).max(axis=(1, 2)).sum()) << count
    out = np.zeros((n, sums.shape[2]), np.int32 if most < 1 << 31 else np.int64)
    part, found = (np.empty((n, sums.shape[2]), sums.dtype) for _ in range(2))
    for b in reversed(range(count)):
        np.take(sums[0], planes[b, 0], axis=0, out=part, mode="clip")
        for g in range(1, groups):
            np.take(sums[g], planes[b, g], axis=0, out=found, mode="clip")
            part += found
        out += out
        if b == count - 1:      # the sign plane counts against
            out -= part
        else:
            out += part
    return out


class Best:
    """The ``k`` best (score, id) of each slot: higher scores, smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), LEAST, np.int64)
        self.id = np.zeros((slots, k), np.int64)

    def worst(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        slot = np.r_[slot, np.repeat(touched, self.k)]
        score = np.r_[score.astype(np.int64), self.score[touched].ravel()]
        ident = np.r_[ident, self.id[touched].ravel()]
        # scores are below 2^55, so -LEAST can only be an empty place
        order = np.lexsort((ident, -np.maximum(score, -(1 << 62)), slot))
        slot, score, ident = slot[order], score[order], ident[order]
        starts = np.r_[True, slot[1:] != slot[:-1]]
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(starts, np.arange(len(slot)), 0))
        top = rank < self.k
        self.score[slot[top], rank[top]] = score[top]
        self.id[slot[top], rank[top]] = ident[top]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score > LEAST)
        return slot, self.score[slot, place], self.id[slot, place]


@dataclass
class Anchors:
    """A pass's anchors in order of their labels, and their positives'
    scores, ids and bands (anchors x positives; an empty band holds none)."""
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positive_ids: np.ndarray | None = None
    positive_scores: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of ``dims`` components; shorter vectors end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (sizes == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def chunks(batches, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of at most ``ROWS`` rows of (id, label, q)."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2), dims)


def _positives(rows: DataFrame, held, dims: int, k: int) -> DataFrame:
    """(slot, id, score): each task's ``k`` best rows of the anchor's label."""
    def search(batches):
        a: Anchors = held()
        best = Best(len(a.ids), k)
        where = {label: (np.searchsorted(a.labels, label), np.searchsorted(a.labels, label, "right"))
                 for label in np.unique(a.labels).tolist()}
        for ids, labels, vectors in chunks(batches, dims):
            for label in np.unique(labels).tolist():
                mine = np.flatnonzero(labels == label)
                planes = bit_planes(vectors[mine])
                first, end = where.get(label, (0, 0))
                for low in range(first, end, ANCHORS):
                    spots = np.arange(low, min(end, low + ANCHORS))
                    found = scores(planes, subset_sums(a.vectors[spots]))
                    good = found >= best.worst()[spots]
                    # an anchor is no positive of its own
                    same, at = np.nonzero(ids[mine][:, None] == a.ids[spots])
                    itself = (vectors[mine[same]] == a.vectors[spots[at]]).all(axis=1)
                    good[same[itself], at[itself]] = False
                    row, at = np.nonzero(good)
                    best.offer(spots[at], found[row, at], ids[mine[row]])
        slot, score, ident = best.entries()
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(ident), pa.array(score)],
                                         ["slot", "id", "score"])

    return rows.mapInArrow(frugal(search), "slot int, id long, score long")


def _negatives(rows: DataFrame, held, dims: int, k: int) -> DataFrame:
    """Each task's ``k`` best rows of another label in every positive's band."""
    names = ["slot", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def search(batches):
        a: Anchors = held()
        count = a.low.shape[1]
        best = Best(len(a.ids) * count, k)
        for ids, labels, vectors in chunks(batches, dims):
            planes = bit_planes(vectors)
            for low in range(0, len(a.ids), ANCHORS):
                spots = np.arange(low, min(len(a.ids), low + ANCHORS))
                other = labels[:, None] != a.labels[spots]
                if not other.any():
                    continue
                found = scores(planes, subset_sums(a.vectors[spots]))
                for p in range(count):
                    slots = spots * count + p
                    floor = np.maximum(best.worst()[slots], a.low[spots, p])
                    row, at = np.nonzero((found >= floor) & (found <= a.high[spots, p]) & other)
                    best.offer(slots[at], found[row, at], ids[row])
        slot, score, ident = best.entries()
        at, p = slot // count, slot % count
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(a.ids[at]), pa.array(a.positive_ids[at, p]),
             pa.array(a.positive_scores[at, p]), pa.array(ident), pa.array(score)], names)

    return rows.mapInArrow(frugal(search), "slot int, " + ", ".join(f"{n} long" for n in names[1:]))


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, q) of the rows that take part; equal rows once."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("v"),
                       finite.alias("whole")) \
        .where("id is not null and label is not null and v is not null and whole") \
        .select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("q")).distinct()


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components x become floor(``scale`` * x); a score is the integer inner
    product with the anchor, higher first, ties by the smaller id. Anchors
    are the rows for which ``anchor`` (over the column ``id``) holds. An
    anchor's positives are its first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of other labels with a score from
    ``low_percent`` to ``high_percent`` hundredths of the positive's are
    returned. ``label`` defaults to the column of that name.

    Rows with a null id, label or vector or a null or non-finite component
    take no part. Rows equal in id, label and components count once; rows
    that share an id only are rows of their own. Vectors of unlike length
    are compared as if the shorter ended in zeros. Scores that could reach
    2^55 are an error. An empty table, or one without anchors, gives an
    empty result. Other columns are not read.

    The rows are scanned twice for every ``PASS_BYTES`` of anchors; what
    goes to the driver and back is one pass's anchors and positives.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    label = F.col("label") if label is None else label
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = integer_vectors(rows, id_col, vector_col, label, scale)
    # rows of a label lie together; a hot label is cut by its ids
    vectors = cut(vectors.repartitionByRange(parts, "label", "id", F.xxhash64("q")), "negatives-vectors")
    shape = vectors.agg(F.max(F.size("q")).alias("dims"), F.count(F.when(anchor, 1)).alias("anchors"),
                        F.max(F.array_max("q")).alias("most"), F.min(F.array_min("q")).alias("least")).first()
    dims = max(shape.dims or 0, 1)
    if max(shape.most or 0, -(shape.least or 0)) ** 2 * dims >= 1 << 55:
        raise ValueError("the integer inner products could reach 2^55")
    per_pass = max(1, PASS_BYTES // (8 * dims))
    blocks = -(-shape.anchors // per_pass)
    queries = vectors.where(anchor).withColumn("block", F.pmod(F.xxhash64("id", "label", "q"), F.lit(max(1, blocks))))
    names = "slot int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = spark.createDataFrame([], names + ", block int")
    for block in range(blocks):
        mine = queries.where(F.col("block") == block).drop("block").toArrow().sort_by([("label", "ascending"),
                                                                                       ("id", "ascending")])
        if not mine.num_rows:
            continue
        column = mine.column("q").combine_chunks()
        a = Anchors(mine.column("id").to_numpy(), mine.column("label").to_numpy(), matrix(column, dims))
        top = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
        best = _positives(vectors, ship(spark, a), dims, positives) \
            .withColumn("p", F.row_number().over(top)).where(F.col("p") <= positives).toArrow()
        at = best.column("slot").to_numpy(), best.column("p").to_numpy() - 1
        a.positive_ids, a.positive_scores = (np.zeros((len(a.ids), positives), np.int64) for _ in range(2))
        a.low, a.high = (np.full((len(a.ids), positives), x, np.int64) for x in (1, 0))
        score = best.column("score").to_numpy()
        a.positive_ids[at], a.positive_scores[at] = best.column("id").to_numpy(), score
        a.low[at], a.high[at] = -(-low_percent * score // 100), high_percent * score // 100
        found = found.unionByName(cut(_negatives(vectors, ship(spark, a), dims, negatives), "negatives-found")
                                  .withColumn("block", F.lit(block)))
    first = Window.partitionBy("block", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
