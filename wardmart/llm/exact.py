"""Exact deduplication by content hash with byte comparison.

Rows are grouped by the 128-bit MD5 of their normalised text (every
character of space and \\t..\\r deleted). Hash equality alone never merges
rows: the texts of every group with two rows or more are compared byte by
byte, as keys of a hash aggregation that combines before the shuffle, so a
group holding a third of all rows moves one text per map task. Groups in
which unlike texts met are split by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, small, text_of

# The characters of [\x20\x09-\x0D].
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
# Keys of multi-row groups are broadcast up to this count (32-byte keys:
# under 100 MB as a hash relation); beyond it the texts are shuffled.
BROADCAST_KEYS = 500_000


def squeeze(text: Column) -> Column:
    """Delete all white space of ``WHITE``."""
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def content_hash(norm: Column) -> Column:
    """128-bit content hash as lowercase hex."""
    return F.md5(norm.cast("binary"))


def _best(id_col: str) -> Column:
    """Orders the rows of a group: most code points, smallest id, null last,
    first row."""
    return F.struct((-F.col("n_chars")).alias("neg"), F.col(id_col).isNull().alias("no_id"),
                    F.col(id_col).alias("id"), F.col("row").alias("row"))


def _keepers(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(_best(id_col)).alias("best"),
                                 F.count(F.lit(1)).alias("group_size")) \
        .select(*keys, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_fn: Callable[[Column], Column] = content_hash, row_col: str | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and form one group with the empty ones. The
    kept row of a group has the most code points in its original text, then
    the smallest id (null ids last); of rows alike in both one is kept, so
    every group keeps a single row, whatever ids repeat or are null. An
    empty table gives an empty result. Other columns of ``docs`` are not
    read, whatever their names.

    ``row_col`` names a column of whole numbers that tells rows apart; it
    decides between rows alike and is returned as ``row``. Without it rows
    are numbered as they are first written.
    """
    row = F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()
    texts = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("__text"), row.alias("row"))
    normed = texts.select(id_col, "row", F.char_length("__text").cast("long").alias("n_chars"),
                          squeeze(F.col("__text")).alias("norm"))
    keyed = cut(normed.select(id_col, "row", "n_chars", hash_fn(F.col("norm")).alias("hash"),
                              F.sha2("norm", 256).alias("text_sha256")), "exact-keys")
    groups = cut(_keepers(keyed, ["hash"], id_col).where("group_size > 1"), "exact-groups")

    # byte comparison inside the multi-row groups
    again = texts.select(squeeze(F.col("__text")).alias("norm")) \
        .withColumn("hash", hash_fn(F.col("norm")))
    inside = again.join(small(groups.select("hash"), BROADCAST_KEYS), "hash", "left_semi")
    collided = cut(inside.groupBy("hash", "norm").count().groupBy("hash")
                   .count().where("count > 1").select("hash"), "exact-collided")

    def verdict(keyed_rows: DataFrame, keepers: DataFrame, on: list[str]) -> DataFrame:
        j = keyed_rows.join(keepers, on, "left")
        # rows without a group (n = 1) are kept as they are; a null id is
        # its own keeper only when no other row of its group has an id
        alone = F.col("group_size").isNull()
        keep = F.when(alone, F.col(id_col)).otherwise(F.col("keep_id"))
        return j.select(F.col(id_col), keep.alias("keep_id"),
                        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256",
                        *(["row"] if row_col else []))

    if collided.isEmpty():
        return verdict(keyed, groups, ["hash"])
    # unlike texts share a hash: their rows are grouped by their bytes
    clean = keyed.join(collided, "hash", "left_anti")
    mixed = cut(normed.withColumn("hash", hash_fn(F.col("norm")))
                .withColumn("text_sha256", F.sha2("norm", 256)).join(collided, "hash", "left_semi"), "exact-mixed")
    split = cut(_keepers(mixed, ["hash", "norm"], id_col), "exact-split")
    return verdict(clean, groups, ["hash"]).unionByName(verdict(mixed, split, ["hash", "norm"]))
