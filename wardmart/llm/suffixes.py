"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected positions are kept: the minimisers of the
word k-grams. Every passage of ``PASSAGE`` words has one in its first half,
at the same place wherever the passage stands. The kept suffixes are sorted
by their first words and the words around them. Where more than two contexts
share the first words, as around a common line, the passages that selected
the suffixes are sorted by all their words, so that equal ones always meet.
Each match of neighbours is extended to the left and right over the
documents' words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, small
from .words import MULTIPLIER, WordHashes, mix, shingle_hashes, words

PASSAGE = 50             # words a repeated passage has at least
GRAM = 8                 # words whose hash selects a position
BROADCAST_IDS = 500_000


def spans_of(passage: int, gram: int) -> tuple[int, int]:
    """(k-grams of the first half, words of a suffix that the passage holds)."""
    window = max(1, passage // 2 - gram + 1)
    return window, passage - window + 1


def selected(hashes: np.ndarray, passage: int, gram: int) -> np.ndarray:
    """Position that each passage of a text selects: its minimiser, the leftmost of equals."""
    if len(hashes) < passage:
        return np.empty(0, np.int64)
    window, _ = spans_of(passage, gram)
    grams = shingle_hashes(hashes, gram)[:len(hashes) - passage + window]
    found = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1)
    return found + np.arange(len(found))


def anchors(hashes: np.ndarray, passage: int, gram: int) -> np.ndarray:
    """Positions that the passages of a text select."""
    return np.unique(selected(hashes, passage, gram))


def run_hashes(hashes: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hash of every run of each of the sizes: the runs of a power of two by
    doubling, others from two that overlap."""
    out, acc, width = {}, hashes, 1
    while True:
        for size in sizes:
            if width <= size < 2 * width:
                n = max(0, len(hashes) - size + 1)
                out[size] = mix(acc[:n] * MULTIPLIER + acc[size - width:size - width + n])
        if 2 * width > max(sizes):
            return [out[size] for size in sizes]
        n = max(0, len(acc) - width)
        acc = mix(acc[:n] * MULTIPLIER + acc[width:width + n])
        width *= 2


def _suffixes(docs: DataFrame, passage: int, gram: int) -> DataFrame:
    """(key, ctx, id, pos) of every kept suffix: the hash of its first words,
    and of all words that a passage selecting this position can hold."""
    id_type = dict(docs.dtypes)["id"]
    window, length = spans_of(passage, gram)
    margin = window - 1

    def scan(batches):
        memo = WordHashes()
        for batch in batches:
            rows, keys, contexts, places = [], [], [], []
            for k, text in enumerate(batch.column(1)):
                h = memo.of(words(text.as_py()))
                pos = anchors(h, passage, gram)
                if not len(pos):
                    continue
                end = np.zeros(margin, np.uint64)
                key, ctx = run_hashes(np.r_[end, h, end], length, passage + margin)
                rows.append(np.full(len(pos), k))
                keys.append(key[pos + margin])
                contexts.append(ctx[pos])
                places.append(pos)
            empty = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys or empty).view(np.int64)),
                 pa.array(np.concatenate(contexts or empty).view(np.int64)),
                 batch.column(0).take(pa.array(np.concatenate(rows or empty))),
                 pa.array(np.concatenate(places or empty).astype(np.int32), pa.int32())], ["key", "ctx", "id", "pos"])

    return docs.mapInArrow(frugal(scan), f"key long, ctx long, id {id_type}, pos int")


def _grouped(suffixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, open): neighbours that need no look at passages, and the
    suffixes (id, pos) whose passages are to be chained one by one.

    Suffixes of one key and context agree in every passage around them:
    they are chained, and the first stands for all. The firsts of a key with
    two contexts are a pair; those of a key with more are open, and so are
    those of a batch's first and last key, which may go on in another batch.
    """
    id_type = dict(suffixes.dtypes)["id"]

    def scan(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, ctx = (batch.column(c).to_numpy() for c in (0, 1))
            new_key = np.r_[True, key[1:] != key[:-1]]
            first = new_key | np.r_[True, ctx[1:] != ctx[:-1]]
            group = np.cumsum(new_key) - 1
            contexts = np.bincount(group[first])
            contexts[[0, -1]] = n + 3      # unknown
            paired = ~first | ~new_key & (contexts[group] == 2)
            opened = first & (contexts[group] > 2)
            at = np.flatnonzero(paired | opened)
            own, before = batch.take(pa.array(at)), batch.take(pa.array(np.maximum(at - 1, 0)))
            yield pa.RecordBatch.from_arrays(
                [own.column(2), own.column(3), before.column(2), before.column(3), pa.array(paired[at])],
                ["id", "pos", "other", "other_pos", "paired"])

    order = ["key", "ctx", "id", "pos"]
    found = cut(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).select(*order)
                .mapInArrow(frugal(scan), f"id {id_type}, pos int, other {id_type}, other_pos int, paired boolean"),
                "suffix-order")
    return found.where("paired").drop("paired"), found.where("not paired").select("id", "pos")


def _passages(opened: DataFrame, docs: DataFrame, passage: int, gram: int) -> DataFrame:
    """(key, id, pos) of every passage that selects an open suffix: the hash
    of its words and its first position."""
    id_type = dict(docs.dtypes)["id"]

    def scan(batches):
        memo = WordHashes()
        for batch in batches:
            rows, keys, places = [], [], []
            for k, (at, text) in enumerate(zip(batch.column(1), batch.column(2))):
                h = memo.of(words(text.as_py()))
                starts = np.flatnonzero(np.isin(selected(h, passage, gram), at.values.to_numpy()))
                rows.append(np.full(len(starts), k))
                keys.append(run_hashes(h, passage)[0][starts])
                places.append(starts)
            empty = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys or empty).view(np.int64)),
                 batch.column(0).take(pa.array(np.concatenate(rows or empty))),
                 pa.array(np.concatenate(places or empty).astype(np.int32), pa.int32())], ["key", "id", "pos"])

    places = cut(opened.groupBy("id").agg(F.collect_list("pos").alias("at")), "suffix-open")
    return places.join(docs, "id").select("id", "at", "t").mapInArrow(frugal(scan), f"key long, id {id_type}, pos int")


def _neighbours(passages: DataFrame) -> DataFrame:
    """Each passage with the one before it in the order (key, id, pos) where
    their keys agree.

    The sort is split by range, so a hot key spreads over many tasks; a task
    compares neighbours as they stream by, and the first and last passages
    of the tasks are compared afterwards.
    """
    id_type = dict(passages.dtypes)["id"]

    def scan(batches):
        part, carry, first = TaskContext.get().partitionId(), None, True

        def emit(table: pa.Table, lo: int, hi: int, last: bool) -> pa.RecordBatch:
            """Rows lo..hi-1 that repeat the key of the row before, with that
            row; the task's first and last row in any case."""
            key = table.column("key").to_numpy()
            same = np.r_[False, key[1:] == key[:-1]]
            edge = np.zeros(len(key), np.int32)
            edge[0] |= first
            edge[-1] |= 2 * last
            at = np.arange(lo, hi)
            at = at[same[at] | (edge[at] > 0)]
            own, before = table.take(pa.array(at)), table.take(pa.array(np.maximum(at - 1, 0)))
            one = lambda column: column.combine_chunks()
            return pa.RecordBatch.from_arrays(
                [*(one(own.column(c)) for c in ("key", "id", "pos")), one(before.column("id")),
                 one(before.column("pos")), pa.array(same[at]), pa.array(edge[at]),
                 pa.array(np.full(len(at), part, np.int32))],
                ["key", "id", "pos", "other", "other_pos", "paired", "edge", "part"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            lo = 0
            if carry is not None:      # its last row has not been emitted yet
                lo = carry.num_rows - 1
                table = pa.concat_tables([carry, table])
            n = table.num_rows
            if lo < n - 1:
                yield emit(table, lo, n - 1, False)
                first = False
            carry = table.slice(max(0, n - 2))
        if carry is not None:
            yield emit(carry, carry.num_rows - 1, carry.num_rows, True)

    order = ["key", "id", "pos"]
    found = cut(passages.repartitionByRange(*order).sortWithinPartitions(*order).select(*order)
                .mapInArrow(frugal(scan), f"key long, id {id_type}, pos int, other {id_type}, other_pos int, "
                                          "paired boolean, edge int, part int"), "suffix-chains")
    # two rows a task
    ends = Window.orderBy("part", "edge_at")
    edges = found.where("edge > 0").withColumn("edge_at", F.explode(F.expr(
        "case edge when 1 then array(1) when 2 then array(2) else array(1, 2) end")))
    edges = edges.select("*", *[F.lag(c).over(ends).alias(f"last_{c}") for c in ("key", "id", "pos", "part")]) \
        .where("edge_at = 1 and last_part <> part and last_key = key")
    return found.where("paired").select("id", "pos", "other", "other_pos").unionByName(
        edges.select("id", "pos", F.col("last_id").alias("other"), F.col("last_pos").alias("other_pos")))


def _extended(pairs: DataFrame, docs: DataFrame, passage: int) -> DataFrame:
    """The maximal matches of at least ``passage`` words around the pairs."""
    id_type = dict(docs.dtypes)["id"]
    ids = cut(pairs.select(F.explode(F.array("id", "other")).alias("id")).distinct(), "suffix-ids")
    texts = cut(docs.join(small(ids, BROADCAST_IDS), "id", "left_semi"), "suffix-texts")

    def extend(batches):
        memo = WordHashes()
        for batch in batches:
            rows, found = [], []
            for k, (at, x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4))):
                x, y = memo.of(words(x.as_py())), memo.of(words(y.as_py()))
                by_shift: dict[int, list[int]] = {}
                for p in at:
                    by_shift.setdefault(p["pos"] - p["other_pos"], []).append(p["pos"])
                for shift, places in by_shift.items():
                    lo, hi = max(0, shift), min(len(x), len(y) + shift)
                    unlike = np.flatnonzero(x[lo:hi] != y[lo - shift:hi - shift]) + lo
                    bounds = np.r_[lo - 1, unlike, hi]
                    for b in np.unique(np.searchsorted(bounds, np.unique(places), "left")):
                        start, end = int(bounds[b - 1]) + 1, int(bounds[b])
                        if end - start >= passage:
                            rows.append(k)
                            found.append((start, end, start - shift))
            start, end, other = zip(*found) if found else ((), (), ())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                 batch.column(1).take(at), pa.array(other, pa.int64())], ["id", "start", "end", "other", "other_start"])

    places = pairs.distinct().groupBy("id", "other").agg(F.collect_list(F.struct("pos", "other_pos")).alias("at"))
    both = cut(places, "suffix-pairs").join(texts.select("id", F.col("t").alias("x")), "id") \
        .join(texts.select(F.col("id").alias("other"), F.col("t").alias("y")), "other")
    return both.select("id", "other", "at", "x", "y") \
        .mapInArrow(frugal(extend), f"id {id_type}, start long, end long, other {id_type}, other_start long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      passage: int = PASSAGE, gram: int = GRAM) -> DataFrame:
    """(id, start_word, end_word, other_id, other_start): the passages of at
    least ``passage`` words that stand in two places, reported at both.

    Words are A-Z lower-cased; ends are exclusive. A group of copies of a
    passage is reported as a chain: each copy with a neighbour in the sort
    by (suffix, words around it, id, position) or by (passage, id,
    position), so every word of every copy is reported. Matches are maximal.
    Places may lie in one text, and overlap there. Null, empty and shorter
    texts have none. Rows that repeat an id, or have none, are texts of their
    own and are all searched; rows equal in id and text are one. An empty
    table gives no rows. Other columns are not read.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t")) \
        .where("t is not null")
    odd = cut(source.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").select("id"),
              "suffix-twins")
    apart = not odd.isEmpty()
    if apart:
        # texts that share an id, or have none, are told apart by their hash
        twins = small(odd.where("id is not null"), BROADCAST_IDS)
        known = source.where("id is not null")
        others = known.join(twins, "id", "left_semi").unionByName(source.where("id is null")) \
            .groupBy(F.struct("id", F.md5("t").alias("text")).alias("id")).agg(F.min("t").alias("t"))
        alone = known.join(twins, "id", "left_anti").select(F.struct("id", F.lit("").alias("text")).alias("id"), "t")
        source = cut(alone.unionByName(others), "suffix-source")
    suffixes = cut(_suffixes(source, passage, gram), "suffixes")
    pairs, opened = _grouped(suffixes)
    chains = _neighbours(_passages(opened, source, passage, gram))
    pairs = pairs.unionByName(chains).select(
        *[F.when(F.struct("id", "pos") > F.struct(F.col("other"), F.col("other_pos")), F.col(a)).otherwise(F.col(b)).alias(c)
          for a, b, c in (("id", "other", "id"), ("pos", "other_pos", "pos"),
                          ("other", "id", "other"), ("other_pos", "pos", "other_pos"))])
    matches = cut(_extended(pairs, source, passage), "suffix-matches").distinct()
    if apart:
        matches = matches.withColumns({"id": F.col("id.id"), "other": F.col("other.id")})
    length = F.col("end") - F.col("start")
    return matches.select(F.col("id").alias(id_col), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
                          F.col("other").alias("other_id"), F.col("other_start")).unionByName(
        matches.select(F.col("other").alias(id_col), F.col("other_start").alias("start_word"),
                       (F.col("other_start") + length).alias("end_word"), F.col("id").alias("other_id"),
                       F.col("start").alias("other_start")))
