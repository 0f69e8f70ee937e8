"""Global ranking and exact percentiles without a single-task stage.

``rank() over (order by x)`` with no partition makes Spark move every row
into one task. Here the rows are dealt to buckets, ranges of the value cut
at approximate quantiles (a short list, bounded by the bucket count), and
shuffled once: a window ranks the rows of each bucket, and the counts of the
buckets (one row each) give the ranks that come before. Rows of a value that
fills a bucket or more are ties of one rank; they are counted apart and
spread over many tasks, so no value makes a task large.

Ranks within partitions, and exact percentiles by position, come from the
distribution of the values:

1. collapse rows to distinct values with counts (partial aggregation, so a
   value held by a third of all rows becomes one row early);
2. deal the distinct values to buckets as above;
3. inside each bucket a window sums the counts of smaller values -- buckets
   are sorted in parallel;
4. bucket totals (one row per bucket) give each bucket's offset;
5. rows get ``rank = 1 + rows with a smaller value`` by joining back on the
   value, which is exactly SQL ``rank()`` including ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of
from .cache import keep, settled
from .joins import DEFAULT_BROADCAST_ROWS

MAX_BUCKETS = 8192
# a frame of at most so many rows is ranked by one window, in one task
WINDOW_ROWS = 50_000
# up to this many bounds the bucket is found by a comparison tree, which
# compiles into generated code; beyond it by a binary search over one
# literal array (the tree would grow with the bound count)
TREE_BOUNDS = 63


def _default_buckets(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, min(MAX_BUCKETS, 2 * n))


def _bucket_of(v: Column, bounds: list) -> Column:
    """Index of the first bound >= v (``len(bounds)`` when above all),
    in log2(len(bounds)) comparisons per row."""
    if len(bounds) <= TREE_BOUNDS:
        def build(lo: int, hi: int) -> Column:
            # answer lies in [lo, hi]
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(v <= F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))
        return build(0, len(bounds))
    arr = F.array(*[F.lit(b) for b in bounds])
    steps = max(1, len(bounds).bit_length())
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(acc: Column, _i: Column) -> Column:
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        go_left = v <= F.element_at(arr, mid + 1)
        moved = F.when(go_left, F.struct(lo.alias("lo"), mid.alias("hi"))) \
            .otherwise(F.struct((mid + 1).alias("lo"), hi.alias("hi")))
        return F.when(lo < hi, moved).otherwise(acc)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def value_distribution(df: DataFrame, col: str, ascending: bool = True,
                       nulls_last: bool = True, buckets: int | None = None,
                       stats: dict | None = None, partition_by=()) -> DataFrame:
    """Distinct (partition, value) pairs of ``col`` with ``cnt`` and
    ``before`` (rows of the same partition ordered strictly before the
    value). NULL is one value, placed last or first.

    One small job reads the distinct values once for the bucket bounds,
    the number of distinct pairs and the row total (returned in ``stats``).
    Buckets are value ranges shared by all partitions, so a partition
    holding a third of all rows is still split over every bucket; the
    per-(partition, bucket) offsets come from a window over at most
    ``buckets + 1`` rows per partition.
    """
    v = col_of(col)
    parts = [col_of(c).alias(f"__p{i}") for i, c in enumerate(partition_by)]
    pcols = [f"__p{i}" for i in range(len(parts))]
    # read twice (bounds, then the running sums): persisted once
    counts = keep(df.groupBy(*parts, v.alias("__v")).agg(F.count(F.lit(1)).alias("cnt"))
                  .withColumn("__k", key_expr(F.col("__v"), ascending)))
    buckets = buckets or _default_buckets(df)
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    row = counts.agg(
        F.percentile_approx(F.col("__k"), probs, 10000).alias("b"),
        F.count(F.lit(1)).alias("n_values"),
        F.sum(F.when(F.col("__k").isNotNull(), F.col("cnt"))).alias("n_rows")).first()
    if stats is not None:
        stats.update(n_values=row["n_values"], n_rows=row["n_rows"] or 0)
    bounds = sorted({b for b in (row["b"] or []) if b is not None}) if buckets > 1 else []
    nb = len(bounds) + 1
    null_bucket = nb if nulls_last else -1
    counts = counts.withColumn(
        "__b", F.when(F.col("__k").isNull(), F.lit(null_bucket))
        .otherwise(_bucket_of(F.col("__k"), bounds) if bounds else F.lit(0)))
    within = Window.partitionBy(*pcols, "__b").orderBy(F.col("__k").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__in", F.coalesce(F.sum("cnt").over(within), F.lit(0)))
    # one row per (partition, bucket): at most buckets + 1 rows per partition
    per_bucket = counts.groupBy(*pcols, "__b").agg(F.sum("cnt").alias("__rows"))
    offsets = per_bucket.withColumn(
        "__off", F.coalesce(F.sum("__rows").over(
            Window.partitionBy(*pcols).orderBy("__b")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .select(*[F.col(p).alias(f"{p}o") for p in pcols], F.col("__b").alias("__bo"), "__off")
    if not pcols:
        # a single partition: one row per bucket, bounded by the bucket count
        offsets = F.broadcast(offsets)
    cond = F.col("__b") == F.col("__bo")
    for p in pcols:          # NULL partition keys form one partition
        cond = cond & F.col(p).eqNullSafe(F.col(f"{p}o"))
    out = counts.join(offsets, cond)
    return out.select(*[F.col(p).alias(c) for p, c in zip(pcols, partition_by)],
                      F.col("__v").alias(col), "cnt",
                      (F.col("__off") + F.col("__in")).alias("before"))


def key_expr(v: Column, ascending: bool) -> Column:
    return v if ascending else -v


def global_rank(df: DataFrame, order_col: str, rank_col: str = "rank", ascending: bool = True,
                nulls_last: bool = True, buckets: int | None = None,
                max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                partition_by=(), settle: bool = True) -> DataFrame:
    """Add ``rank_col`` (bigint) equal to SQL ``rank() over ([partition by
    ...] order by order_col)``.

    The rows are read for the values' distribution and again to carry their
    ranks, so they are written first, unless the caller says that ``df``
    already reads written rows (``settle=False``).

    Ties share a rank and leave gaps, as in SQL. NULLs rank last by default
    (ascending), first when ``nulls_last=False``; NULL partition keys form
    one partition, as in SQL. Numeric order columns.
    """
    if settle:
        df = settled(df)
    if not partition_by:
        return _ranked_once(df, order_col, rank_col, ascending, nulls_last, buckets)
    stats: dict = {}
    partition_by = list(partition_by)
    dist = value_distribution(df, order_col, ascending, nulls_last, buckets, stats, partition_by)
    dist = dist.select(*[F.col(c).alias(f"__dp{i}") for i, c in enumerate(partition_by)],
                       F.col(order_col).alias("__dv"),
                       (F.col("before") + 1).cast("bigint").alias(rank_col))
    # one row per distinct (partition, value): its size is known from the bounds job
    if max_broadcast_rows and stats["n_values"] <= max_broadcast_rows:
        dist = F.broadcast(dist)
    cond = col_of(order_col).eqNullSafe(F.col("__dv"))
    for i, c in enumerate(partition_by):
        cond = cond & col_of(c).eqNullSafe(F.col(f"__dp{i}"))
    return df.join(dist, cond, "inner").drop("__dv", *[f"__dp{i}" for i in range(len(partition_by))])


def _ranked_once(df: DataFrame, order_col: str, rank_col: str, ascending: bool, nulls_last: bool,
                 buckets: int | None) -> DataFrame:
    """``df`` with its global rank, its rows shuffled once."""
    v = col_of(order_col)
    key = key_expr(v, ascending)
    nan = F.isnan(v) if dict(df.dtypes)[order_col] in ("double", "float") else F.lit(False)
    n = buckets or _default_buckets(df)
    probs = [i / n for i in range(1, n)] or [0.5]
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.percentile_approx(F.when(~nan, key), probs, 10000).alias("b")).first()
    if buckets is None and row["rows"] <= WINDOW_ROWS:
        order = getattr(v, f"{'asc' if ascending else 'desc'}_nulls_{'last' if nulls_last else 'first'}")()
        return df.withColumn(rank_col, F.rank().over(Window.orderBy(order)).cast("bigint"))
    found = [b for b in row["b"] or [] if b is not None]
    bounds = sorted(set(found))
    # a bound that stands for two quantiles or more fills a bucket
    hot = sorted({a for a, b in zip(found, found[1:]) if a == b})
    # buckets in order: below the first bound, the bound itself if hot, ...
    at = 2 * (_bucket_of(key, bounds) if bounds else F.lit(0))
    end = 2 * len(bounds) + 1
    tied = key.isin(hot) if hot else F.lit(False)
    bucket = (F.when(v.isNull(), F.lit(end + 2 if nulls_last else -2))
              .when(nan, F.lit(end + 1 if ascending else -1))
              .when(tied, at + 1).otherwise(at))
    # rows of one value are spread; their rank in the bucket is 1 everywhere
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(n))
    rows = df.withColumns({"__k": key, "__b": bucket,
                           "__s": F.when(v.isNull() | nan | tied, spread).otherwise(F.lit(0).cast("bigint"))})
    # one row per bucket
    counts = df.select(bucket.alias("__at")).groupBy("__at").agg(F.count(F.lit(1)).alias("cnt"))
    before = Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__at", F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("__off"))
    ranked = rows.withColumn("__r", F.rank().over(Window.partitionBy("__b", "__s").orderBy("__k")))
    return ranked.join(F.broadcast(offsets), F.col("__b") == F.col("__at")) \
        .select(*[col_of(c) for c in df.columns], (F.col("__off") + F.col("__r")).cast("bigint").alias(rank_col))


def exact_percentiles(df: DataFrame, col: str, probs: list[float], prefix: str = "p",
                      buckets: int | None = None) -> DataFrame:
    """One row with the exact (linearly interpolated) percentiles of ``col``.

    Same definition as SQL ``percentile_cont``: position ``p * (n - 1)``
    between the sorted non-NULL values. Works on the per-value distribution,
    so no task ever holds all values.
    """
    stats: dict = {}
    dist = value_distribution(df.where(col_of(col).isNotNull()), col, True, True, buckets, stats)
    n = stats["n_rows"]
    v = F.col(col).cast("double")
    lo_end = F.col("before") + F.col("cnt")
    aggs, outs = [], []
    for i, p in enumerate(probs):
        pos = p * (n - 1) + 1 if n else 1.0
        lo, hi = int(pos // 1), int(-(-pos // 1))
        frac = pos - lo
        aggs.append(F.max(F.when((F.col("before") < lo) & (lo <= lo_end), v)).alias(f"__lo{i}"))
        aggs.append(F.max(F.when((F.col("before") < hi) & (hi <= lo_end), v)).alias(f"__hi{i}"))
        name = f"{prefix}{int(round(p * 100))}" if prefix else str(p)
        outs.append((F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.lit(frac))
                    .alias(name))
    return dist.agg(*aggs).select(*outs)
