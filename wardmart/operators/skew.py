"""Joins with sides too large to broadcast: hot keys apart, misses early.

Both operators give the rows of the plain join, whatever the sketches say:
a key wrongly taken for hot is joined by broadcast, one wrongly not by
shuffle; a key that a Bloom filter wrongly lets through is verified exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of, quote
from .joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, has_at_most

HOT_SHARE = 0.01        # of all rows: a key with more is joined apart
TRACKED = 8_192         # counters of the frequent-items sketch, per task
BLOOM_BITS = 16         # bits a key
BLOCK_WORDS = 1_024     # 64-bit words of one row of the filter


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold at least ``share`` of the rows, by a frequent-items
    sketch: counters of bounded size in each task, merged in one row. None
    with that share is missed as long as it exceeds 2 / ``TRACKED``."""
    if not 2 / TRACKED < share <= 1:
        raise ValueError("share must be over 2 / TRACKED")
    row = df.select(col_of(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {int(1 / share) + 1}, {TRACKED})").alias("top")).first()
    # an item's count may miss as many rows as the sketch's error
    least = share * row.n - 2 * row.n / TRACKED
    return [t["item"] for t in row.top or [] if t["item"] is not None and t["count"] >= max(1, least)]


def split_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", share: float = HOT_SHARE,
               hot: list | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for inner and left joins, where a few
    keys of ``left`` may hold any share of its rows.

    Rows of the hot keys stay where they are: only the right rows of these
    keys are broadcast, if they are few. The other rows are shuffled, and no
    key among them is hot. NULL keys, which match nothing, are not shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner and left joins only")
    hot = hot_keys(left, on, share) if hot is None else hot
    key = col_of(on)
    columns = [*left.columns, *[c for c in right.columns if c != on]]
    cold = left.where(key.isNotNull() & ~key.isin(hot)) if hot else left.where(key.isNotNull())
    parts = [cold.join(right.where(~key.isin(hot)) if hot else right, on, how)]
    if hot:
        few = right.where(key.isin(hot))
        if has_at_most(few, DEFAULT_BROADCAST_ROWS):
            few = F.broadcast(few)
        parts.append(left.where(key.isin(hot)).join(few, on, how))
    if how == "left":
        types = {f.name: f.dataType for f in right.schema.fields}
        parts.append(left.where(key.isNull()).select(
            "*", *[F.lit(None).cast(types[c]).alias(c) for c in right.columns if c != on]))
    out = parts[0].select([col_of(c) for c in columns])
    for p in parts[1:]:
        out = out.unionByName(p.select([col_of(c) for c in columns]))
    return out


def bloom_filter(parent: DataFrame, key: str, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, int] | None:
    """(block, words) rows of a blocked Bloom filter of the non-NULL keys,
    and its number of words; None if it would exceed ``max_bytes``.

    A key sets four bits of one 64-bit word. Bits are or-ed in one grouped
    aggregate, combined before its shuffle; words come packed in blocks.
    """
    keys = parent.select(col_of(key).alias("k")).where("k IS NOT NULL")
    n = keys.agg(F.approx_count_distinct("k", 0.02).alias("n")).first().n
    words = max(1, math.ceil(1.1 * n * BLOOM_BITS / 64))
    if 8 * words > max_bytes:
        return None
    bits = _bits(keys, words).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    place = (F.col("word") / BLOCK_WORDS).cast("int")
    blocks = bits.groupBy(place.alias("block")).agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("word") % BLOCK_WORDS).cast("int").alias("at"), "mask"))).alias("held"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)),
                        lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("bigint")))
    return blocks.select("block", dense.alias("words")), words


def _bits(df: DataFrame, words: int) -> DataFrame:
    """``df`` with the word and the mask of its column ``k``."""
    hashed = df.withColumns({"word": F.pmod(F.xxhash64("k"), F.lit(words)), "__h": F.xxhash64(F.lit(1), "k")})
    four = " | ".join(f"shiftleft(1L, cast(shiftright(__h, {6 * i}) & 63 as int))" for i in range(4))
    return hashed.withColumn("mask", F.expr(four)).drop("__h")


def with_possible(child: DataFrame, key: str, bloom: tuple[DataFrame, int], name: str = "__possible") -> DataFrame:
    """``child`` with a flag: False where its key is certainly not among the
    filter's, or NULL; nothing of ``child`` is shuffled."""
    blocks, words = bloom
    own = child.columns
    rows = _bits(child.withColumn("k", col_of(key)), words) \
        .withColumn("__block", (F.col("word") / BLOCK_WORDS).cast("int"))
    j = rows.join(F.broadcast(blocks.withColumnRenamed("block", "__b")), F.col("__block") == F.col("__b"), "left")
    held = F.get("words", (F.col("word") % BLOCK_WORDS).cast("int"))
    possible = F.coalesce(F.col("k").isNotNull() & (held.bitwiseAND(F.col("mask")) == F.col("mask")), F.lit(False))
    return j.select(*[F.col(quote(c)) for c in own], possible.alias(name))


def pruned_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row, for large parents.

    Rows whose key misses the parent's Bloom filter are orphans for certain
    and leave without a shuffle. Of the others each distinct key is looked
    up exactly, once a task at most, and the few keys that the filter let
    through wrongly bring back their rows.
    """
    bloom = bloom_filter(parent, parent_key)
    known = child.where(col_of(key).isNotNull())
    parents = parent.select(col_of(parent_key).alias("__pk")).where("__pk IS NOT NULL").distinct()
    if bloom is None:
        return known.join(parents, col_of(key) == F.col("__pk"), "left_anti")
    flagged = with_possible(known, key, bloom)
    certain = flagged.where(~F.col("__possible")).drop("__possible")
    survivors = flagged.where("__possible").drop("__possible")
    false = survivors.select(col_of(key).alias("__k")).distinct() \
        .join(parents, F.col("__k") == F.col("__pk"), "left_anti")
    return certain.unionByName(survivors.join(false, col_of(key) == F.col("__k"), "left_semi"))


def pruned_join(left: DataFrame, right: DataFrame, on: str, hot: list | None = None) -> DataFrame:
    """Inner join that drops left rows without a match before the shuffle and
    keeps hot keys out of it.

    ``hot`` lists the hot keys where a caller knows them, for instance from a
    table that ``left`` was joined from: looking for them in ``left`` would
    run that join once more.
    """
    bloom = bloom_filter(right, on)
    if bloom is not None:
        left = with_possible(left, on, bloom).where("__possible").drop("__possible")
    return split_join(left, right, on, hot=hot)
