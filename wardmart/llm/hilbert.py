"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into equi-depth cells, the cells of a row give
one index on the Hilbert curve, rows are sorted by that index and the sorted
run is cut into shards whose row counts differ by at most one. Neighbours on
the curve are neighbours in every dimension, so each shard covers a narrow
range of each dimension and min/max statistics prune files for filters on
any of them. DataFrame and SQL functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .shared import cut, text_of

BITS = 5                 # 2^5 cells per dimension
ROW_OVERHEAD = 16


def _before(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Rows (value, n) with the sum of n over all smaller values and over
    all, from a range sort: a task's running sums start at the sums of the
    tasks before it."""
    run = cut(counts.orderBy(value).withColumn("at", F.monotonically_increasing_id()), name)
    run = run.withColumn("piece", F.shiftright("at", 33))
    sums = run.groupBy("piece").agg(F.sum("n").alias("held"))
    ahead = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)    # one row a task
    sums = cut(sums.select("piece", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("offset"),
                           F.sum("held").over(Window.partitionBy()).alias("total")), name + "-offsets")
    inside = Window.partitionBy("piece").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return run.join(F.broadcast(sums), "piece") \
        .select(value, "total", (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))


def boundaries(docs: DataFrame, dim: str, bits: int = BITS) -> list:
    """Least values of the equi-depth cells of a dimension but the first, at
    most 2^bits - 1, from the counts of all its values.

    A value lies in the cell that the rows with smaller values fill up to,
    so cells differ in depth by one value's rows at most, whatever the
    values look like. Null is the lowest value.
    """
    counts = docs.where(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    nulls = docs.where(F.col(dim).isNull()).count()
    placed = _before(counts, "v", "hilbert-values")
    depth = F.expr(f"((before + {nulls}L) * {1 << bits}L) div (total + {nulls}L)")
    rows = placed.groupBy(depth.alias("cell")).agg(F.min("v").alias("v")).where("cell > 0").orderBy("cell").collect()
    return [r.v for r in rows]


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Hilbert curve index of integer cell coordinates in [0, 2^bits).

    The published transpose method: undo the rotations from the highest bit
    down, Gray-code the coordinates, then interleave their bits. Each step
    is one element of a fold, so the expression stays small.
    """
    n = len(cells)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])
    start = F.array(*[c.cast("int") for c in cells])

    def turn(x: Column, s: Column) -> Column:
        q, p = s["q"], s["q"] - 1
        xi = F.get(x, s["i"])
        is_set = xi.bitwiseAND(q) != 0
        t = F.get(x, F.lit(0)).bitwiseXOR(xi).bitwiseAND(p)
        return F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(F.when(is_set, p).otherwise(t)))
                           .when((j == s["i"]) & ~is_set, v.bitwiseXOR(t)).otherwise(v))

    def let(value: Column, body) -> Column:
        """Evaluate ``value`` once and use it in ``body``."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def gray(x: Column) -> Column:
        xs = [F.get(x, F.lit(0))]
        for i in range(1, n):
            xs.append(F.get(x, F.lit(i)).bitwiseXOR(xs[-1]))
        return F.array(*xs)

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        flip = reduce(lambda a, b: a.bitwiseXOR(
            F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0))),
            range(bits - 1, 0, -1), F.lit(0))

        def weave(t: Column) -> Column:
            out = F.lit(0).cast("long")
            for b in range(bits):
                for i in range(n):
                    bit = F.get(x, F.lit(i)).bitwiseXOR(t).bitwiseAND(F.lit(1 << b)) != 0
                    out = out + F.when(bit, F.lit(1 << (b * n + n - 1 - i))).otherwise(0)
            return out
        return let(flip, weave)

    turned = F.aggregate(steps, start, turn) if bits > 1 else start
    return let(let(turned, gray), finish)


def curve_keys(docs: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``docs`` with ``curve_index``; cells are taken from all rows."""
    types = {f.name: f.dataType for f in docs.schema.fields}

    def cell(dim: str) -> Column:
        edges = [F.lit(v).cast(types[dim]) for v in boundaries(docs, dim, bits)]
        value = F.col(f"`{dim}`")
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(F.array(*edges), lambda e: e <= value))) \
            if edges else F.lit(0)

    return docs.withColumn("curve_index", hilbert_index([cell(d) for d in dims], bits))


def hilbert_shards(docs: DataFrame, shards: int, dims: list[str], id_col: str = "doc_id",
                   text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Shard and slot of every row; shard sizes differ by at most one row.

    Rows are ordered by (curve index, text checksum, id): copies of a text
    with equal metadata are adjacent. Null texts have size 16 and checksum
    0, null dimension values sort lowest, rows equal in all of these take
    neighbouring slots. An empty table gives no rows.

    The order is materialised in the shared folder by a range sort (a hot
    cell is split by checksum, id and at last the rows' places in the
    input, so that a row that repeats is spread too), and ranks follow from the positions
    inside the sorted files plus per-file counts, so no task sees more than
    its share of rows.
    """
    return _placed(docs, shards, dims, id_col, text_col, bits)


def _placed(docs: DataFrame, shards: int, dims: list[str], id_col: str, text_col: str, bits: int,
            *carried: str) -> DataFrame:
    """Shard and slot of every row beside the ``carried`` columns."""
    text = text_of(text_col)
    meta = curve_keys(docs, dims, bits).select(
        F.col(id_col), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + ROW_OVERHEAD)
        .cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "curve_index", *carried,
        F.monotonically_increasing_id().alias("place"))
    # monotonically_increasing_id: sorted partition number and row in it
    run = cut(meta.orderBy("curve_index", "text_crc32", id_col, "place")
              .withColumn("at", F.monotonically_increasing_id()), "hilbert-run")
    piece, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = run.groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    # one row per sorted partition
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                                F.sum("n").over(Window.partitionBy()).alias("total")), "hilbert-offsets")
    ranked = run.withColumn("piece", piece).join(F.broadcast(offsets), "piece") \
        .withColumn("rank", F.col("offset") + row)
    # exact integer arithmetic: shard s starts at ceil(s * total / shards)
    shard = F.expr(f"(rank * {shards}L) div total")
    start = F.expr(f"(shard * total + {shards - 1}L) div {shards}L")
    return ranked.withColumn("shard", shard).select(
        id_col, "size", "text_crc32", "curve_index", F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - start).cast("long").alias("slot"), *carried)


def write_shards(docs: DataFrame, shards: int, dims: list[str], path: str, id_col: str = "doc_id",
                 text_col: str = "text", bits: int = BITS) -> None:
    """Write every row of ``docs`` as ``path/shard=N``, each shard sorted by
    slot, at the place ``hilbert_shards`` gives it. The first columns are
    those of ``docs``, as they are.

    The rows go through the ranked run itself, so those with a null id or an
    id that repeats have places of their own. Where the rows have columns
    named shard or slot, those of the places end with an underscore.
    """
    taken = {c.lower() for c in docs.columns}
    shard, slot = (n if n not in taken else n + "_" for n in ("shard", "slot"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    placed = _placed(docs.withColumn("__row", whole), shards, dims, id_col, text_col, bits, "__row")
    placed.select("__row.*", F.col("shard").alias(shard), F.col("slot").alias(slot)) \
        .repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
