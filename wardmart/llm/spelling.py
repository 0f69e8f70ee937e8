"""Spelling variants: words one edit apart, found through Bloom filters.

The neighbourhood of a word (one code point deleted or replaced; insertions
are deletions seen from the other word) is generated in numpy and probed
against blocked Bloom filters of the vocabulary, one shard for each word
length. Only positive edits are shuffled to a join with the vocabulary,
which removes the filters' false positives. Each word then points to its
most frequent neighbour that is frequent enough, and pointers are followed
to the last word by doubling.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, cut, frugal, ship
from .words import mix

# Fixed value: the letters of a word.
LETTERS = r"A-Za-zÀ-ÿ"

LONGEST_SHARD = 64           # longer words share this shard
BITS_A_WORD = 20
SEGMENT = 1 << 13            # blocks of 64 bits that one task fills
FILTER_BYTES = 32 << 20      # filters of one pass over the vocabulary
HELD_WORDS, HELD_CHARS = 200_000, 16_000_000    # counted words a task holds
CELLS = 200_000              # (word, position) pairs probed at once

CODE, PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# a key sets four bits of one block
MASKS = np.bitwise_or.reduce(np.uint64(1) << np.array(
    [[(i * 2654435761 >> (6 * j)) & 63 for j in range(4)] for i in range(1, 4097)], np.uint64), axis=1)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                min_count: int = 2, drop_every: int | None = None) -> DataFrame:
    """(word, n) of all maximal letter runs of the whole texts, A-Z lower-cased.

    With ``drop_every`` = d, a run whose h = crc32("<id>:<run>") is divisible
    by d loses the code point at h % length first. Words shorter than
    ``min_length`` code points or rarer than ``min_count`` are left out. Null
    texts hold no words, a null id counts as the empty text. Counts are
    summed in each task before the shuffle.
    """
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def scan(batches):
        held: dict[str, int] = {}
        chars = 0

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()),
                                               pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                # bytes.lower leaves all but A-Z alone
                found = Counter(run.findall(text.encode().lower().decode()))
                start = crc32(f"{key or ''}:".encode())
                for word, n in found.items():
                    if drop_every:
                        h = crc32(word.encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_length:
                                continue
                    if word in held:
                        held[word] += n
                    else:
                        held[word] = n
                        chars += len(word)
                if len(held) > HELD_WORDS or chars > HELD_CHARS:
                    yield counted()
                    held, chars = {}, 0
        if held:
            yield counted()

    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t")) \
        .mapInArrow(frugal(scan), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def code_matrix(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length)


def placed(code, at) -> np.ndarray:
    """Hash of a code point at a position; a word's hash mixes their sum."""
    code, at = (np.atleast_1d(np.asarray(x, np.uint64)) for x in (code, at))
    return mix(code * CODE + (at + np.uint64(1)) * PLACE)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, indices of the words of that length)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(part):
            yield int(lengths[part[0]]), part


def blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Block of each hash in a filter of ``size`` blocks (below 2^32)."""
    return ((hashes >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def masks(hashes: np.ndarray) -> np.ndarray:
    return MASKS[(hashes & np.uint64(4095)).astype(np.int64)]


@dataclass
class Shard:
    """Blocks ``low`` onwards of the filter of one word length."""
    size: int
    low: int
    bits: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the (mixed) hash of an edit may be that of a word here."""
        at = blocks(hashes, self.size)
        if len(self.bits) < self.size:
            at -= self.low
            inside = (at >= 0) & (at < len(self.bits))
            at[~inside] = 0
        want = masks(hashes)
        found = (self.bits[at] & want) == want
        return found & inside if len(self.bits) < self.size else found


def shard_sizes(vocabulary: DataFrame) -> dict[int, int]:
    """Blocks of each length's filter, from the exact number of its words."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST_SHARD)).alias("shard")
    return {r.shard: max(1, math.ceil(r["count"] * BITS_A_WORD / 64))
            for r in vocabulary.groupBy(shard).count().collect()}


def bloom_segments(vocabulary: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(shard, segment, bits): the filters in pieces of ``SEGMENT`` blocks,
    each filled by one task from the hashes of some 26,000 words."""
    def hash_words(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            out = [np.empty(len(words), np.int64) for _ in range(4)]
            for length, rows in by_length(words):
                shard = min(length, LONGEST_SHARD)
                matrix = code_matrix([words[i] for i in rows], length)
                total = np.zeros(len(rows), np.uint64)
                for at in range(length):
                    total += placed(matrix[:, at], at)
                hashes = mix(total)
                block = blocks(hashes, sizes[shard])
                for column, values in zip(out, (shard, block // SEGMENT, block % SEGMENT,
                                                (hashes & np.uint64(4095)).astype(np.int64))):
                    column[rows] = values
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in out],
                                             ["shard", "segment", "block", "mask"])

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard, segment = int(key[0]), int(key[1])
        bits = np.zeros(min(SEGMENT, sizes[shard] - segment * SEGMENT), np.uint64)
        np.bitwise_or.at(bits, pdf["block"].to_numpy(), MASKS[pdf["mask"].to_numpy()])
        return pd.DataFrame({"shard": [shard], "segment": [segment], "bits": [bits.tobytes()]})

    return vocabulary.select("word") \
        .mapInArrow(frugal(hash_words), "shard int, segment int, block int, mask int") \
        .groupBy("shard", "segment").applyInPandas(fill, "shard int, segment int, bits binary")


def passes(sizes: dict[int, int], limit: int) -> list[list[tuple[int, int, int]]]:
    """Runs of (shard, first segment, end segment) of at most ``limit`` bytes
    (one segment at least)."""
    room, out = 0, []
    for shard in sorted(sizes):
        for segment in range(math.ceil(sizes[shard] / SEGMENT)):
            need = 8 * min(SEGMENT, sizes[shard] - segment * SEGMENT)
            if not out or need > room:
                out.append([])
                room = max(limit, need)
            if out[-1] and out[-1][-1][0] == shard:
                out[-1][-1] = (shard, out[-1][-1][1], segment + 1)
            else:
                out[-1].append((shard, segment, segment + 1))
            room -= need
    return out


def load_pass(segments: DataFrame, sizes: dict[int, int], ranges: list[tuple[int, int, int]]) -> dict[int, Shard]:
    """The filters of one pass, at most ``FILTER_BYTES`` (and one segment)."""
    wanted = " or ".join(f"(shard = {s} and segment >= {a} and segment < {b})" for s, a, b in ranges)
    pieces = {(r.shard, r.segment): r.bits for r in segments.where(wanted).collect()}
    return {s: Shard(sizes[s], a * SEGMENT, np.frombuffer(
        b"".join(bytes(pieces[s, k]) for k in range(a, b)), np.uint64)) for s, a, b in ranges}


def edits(words: list[str], length: int, filters: dict[int, Shard],
          letters: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(indices of words, edits) for the edits of words of one length that
    the filters may hold: every deletion, and every replacement by a greater
    letter (the lesser word of a pair finds the greater).

    Long words are probed by ranges of positions, so the arrays stay bounded.
    """
    less, same = filters.get(min(length - 1, LONGEST_SHARD)), filters.get(min(length, LONGEST_SHARD))
    if less is None and same is None:
        return
    matrix = code_matrix(words, length)
    n = len(words)
    total = np.zeros(n, np.uint64)
    moved = np.zeros(n, np.uint64)          # sum of the code points right of `low`, one place left
    for at in range(length):
        total += placed(matrix[:, at], at)
        if at:
            moved += placed(matrix[:, at], at - 1)
    before = np.zeros(n, np.uint64)         # sum of the code points left of `low`
    width = max(1, min(length, CELLS // n))
    for low in range(0, length, width):
        spots = np.arange(low, min(length, low + width))
        here = placed(matrix[:, spots], np.broadcast_to(spots, (n, len(spots))))
        if low:
            moved -= placed(matrix[:, low], low - 1)
        if less is not None:
            shifted = placed(matrix[:, spots[1:]], np.broadcast_to(spots[1:] - 1, (n, len(spots) - 1)))
            left = before[:, None] + np.concatenate(
                [np.zeros((n, 1), np.uint64), np.cumsum(here[:, :-1], axis=1, dtype=np.uint64)], axis=1)
            right = moved[:, None] - np.concatenate(
                [np.zeros((n, 1), np.uint64), np.cumsum(shifted, axis=1, dtype=np.uint64)], axis=1)
            row, col = np.nonzero(less.holds(mix(left + right).ravel()).reshape(n, -1))
            # of a run of equal code points one deletion gives the same word
            at = spots[col]
            once = (at == 0) | (matrix[row, at] != matrix[row, at - 1])
            row, at = row[once], at[once]
            if len(row):
                keep = np.ones((len(row), length), bool)
                keep[np.arange(len(row)), at] = False
                cutout = matrix[row][keep].reshape(len(row), length - 1)
                yield row, _strings(cutout)
        if same is not None:
            rest = (total[:, None] - here).ravel()
            rank = np.searchsorted(letters, matrix[:, spots].ravel())
            order = np.argsort(rank, kind="stable")
            rest, where = rest[order], order
            ends = np.searchsorted(rank[order], np.arange(len(letters)))   # cells with a lesser letter
            column = where % len(spots)
            for k, letter in enumerate(letters.tolist()):
                if not ends[k]:
                    continue
                new = placed(letter, spots)
                hit = np.flatnonzero(same.holds(mix(rest[:ends[k]] + new[column[:ends[k]]])))
                if len(hit):
                    cell = where[hit]
                    row = cell // len(spots)
                    changed = matrix[row]
                    changed[np.arange(len(row)), spots[cell % len(spots)]] = letter
                    yield row, _strings(changed)
        if width < length:
            before += here.sum(axis=1, dtype=np.uint64)
            if len(spots) > 1:
                moved -= placed(matrix[:, spots[1:]], np.broadcast_to(spots[1:] - 1, (n, len(spots) - 1))) \
                    .sum(axis=1, dtype=np.uint64)


def _strings(matrix: np.ndarray) -> list[str]:
    return np.ascontiguousarray(matrix, np.uint32).view(f"<U{matrix.shape[1]}").ravel().tolist()


def candidates(vocabulary: DataFrame, filters: dict[int, Shard], letters: np.ndarray) -> DataFrame:
    """(word, n, edit) for every edit of a word that the filters may hold."""
    held = ship(vocabulary.sparkSession, (filters, letters))

    def probe(batches):
        shards, alphabet = held()
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for length, rows in by_length(words):
                step = max(1, CELLS // length)
                for low in range(0, len(rows), step):
                    part = rows[low:low + step]
                    for row, found in edits([words[i] for i in part], length, shards, alphabet):
                        at = part[row]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([words[i] for i in at], pa.string()), pa.array(n[at], pa.int64()),
                             pa.array(found, pa.string())], ["word", "n", "edit"])

    return vocabulary.select("word", "n").mapInArrow(frugal(probe), "word string, n long, edit string")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of words one edit apart.

    ``vocabulary`` is a written table (word, n) of distinct words. The
    filters are broadcast ``FILTER_BYTES`` at a time, a pass over the
    vocabulary for each; every pass keeps only the positives of its own part.
    """
    spark = vocabulary.sparkSession
    sizes = shard_sizes(vocabulary)
    # distinct code points: bounded by Unicode
    letters = np.array(sorted(ord(r.c) for r in vocabulary.select(
        F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c != ''").distinct().collect()), np.uint64)
    segments = cut(bloom_segments(vocabulary, sizes), "spelling-filters")
    found = None
    for ranges in passes(sizes, FILTER_BYTES):
        lengths = {s for s, _, _ in ranges} | {s + 1 for s, _, _ in ranges}
        shard = F.least(F.char_length("word"), F.lit(LONGEST_SHARD))
        probing = vocabulary.where(shard.isin(sorted(min(s, LONGEST_SHARD) for s in lengths)))
        part = cut(candidates(probing, load_pass(segments, sizes, ranges), letters), "spelling-candidates")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vocabulary.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    both = F.explode(F.array(
        F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
        F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"),
                 F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return found.join(known, "edit").select(both.alias("p")).select("p.*")


def spelling_variants(vocabulary: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``vocabulary`` holds words and their counts (word, n); rows of one word
    are summed, null words and words without a positive count left out. Two
    words are near if one inserted, deleted or replaced code point makes one
    the other. ``form`` is the near word of largest n (ties: the smallest in
    code-point order) if that n is at least ``ratio`` times the word's own,
    else null; ``root`` is the last word that forms lead to. An empty table
    gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word: ratio >= 2")
    spark = vocabulary.sparkSession
    bound_batches(spark)
    words = cut(vocabulary.where("word is not null and n > 0").groupBy("word").agg(F.sum("n").cast("long").alias("n")),
                "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), "near")).alias("best"))
    form_n = -F.col("best.neg")
    chosen = form_n >= ratio * F.col("n")
    formed = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, form_n).alias("form_n")), "spelling-forms")
    # a hop multiplies n by the ratio, so hops are few; doublings fewer
    span = formed.agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    hops = int(math.log(span.high / span.low, ratio)) + 1 if span.low else 0
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    covered = 1
    while covered < hops:
        roots = cut(roots, "spelling-roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        covered *= 2
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
