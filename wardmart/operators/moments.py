"""Mergeable moments: counts, means, variances and covariances.

A state is one row: n, means, centred squares and products. A mean is kept
as a point near it and the distance from there, so that means far from zero
still differ exactly. States are
built per group and per part of its rows, the part being a hash of the
values, so a state depends on its values only, not on how rows were split or
ordered: its sums are exact (see ``exact``), first around nothing for the
mean, then around that mean. States can be kept as a table, added to by
later extracts, and merged in the fixed order of their parts; a result from
stored states is the direct result, bit by bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of
from .exact import exact_sums
from .joins import DEFAULT_BROADCAST_ROWS, keyed_join

PARTS = 16
_FIELDS = ["n", "at_x", "off_x", "at_y", "off_y", "m2_x", "m2_y", "c_xy"]


def moment_states(df: DataFrame, groups: list[str], x: str, y: str | None = None, parts: int = PARTS) -> DataFrame:
    """(groups, part, n, at_x, off_x, at_y, off_y, m2_x, m2_y, c_xy) over the
    rows whose ``x`` (and ``y``, if given) is known; the means are at + off.

    The rows are read twice; each time they are combined before the shuffle,
    so a group may hold any share of them.
    """
    cols = {"__x": x, **({"__y": y} if y else {})}
    rows = df.select(*[col_of(g).alias(f"__k{i}") for i, g in enumerate(groups)],
                     *[col_of(c).cast("double").alias(n) for n, c in cols.items()])
    for n in cols:
        rows = rows.where(F.col(n).isNotNull())
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int"))
    keys = [f"__k{i}" for i in range(len(groups))]
    means = exact_sums(rows, [*keys, "part"], {f"__s{n}": n for n in cols}, None, {f"__m{n}": f"__s{n}" for n in cols}) \
        .select(*keys, "part", *[f"__m{n}" for n in cols])
    near = keyed_join(rows, means, ["part"], keys, "inner", DEFAULT_BROADCAST_ROWS)
    dx = F.col("__x") - F.col("__m__x")
    dy = F.col("__y") - F.col("__m__y") if y else None
    sums = {"__dx": dx, "__dxx": dx * dx}
    if y:
        sums |= {"__dy": dy, "__dyy": dy * dy, "__dxy": dx * dy}
    # the mean rides along: the sum of a constant's rows would not be it
    near = near.withColumns({"__cx": F.col("__m__x"), "__cy": F.col("__m__y") if y else F.lit(None).cast("double")})
    total = exact_sums(near, [*keys, "part", "__cx", "__cy"], sums, {"n": F.lit(1)})
    nothing = F.lit(None).cast("double")

    def left(square: str, a: str, b: str) -> Column:
        return F.col(square) - F.col(a) * F.col(b) / F.col("n")

    return total.select(
        *[F.col(k).alias(g) for k, g in zip(keys, groups)], "part", "n",
        F.col("__cx").alias("at_x"), (F.col("__dx") / F.col("n")).alias("off_x"),
        F.col("__cy").alias("at_y"), (F.col("__dy") / F.col("n") if y else nothing).alias("off_y"),
        left("__dxx", "__dx", "__dx").alias("m2_x"), (left("__dyy", "__dy", "__dy") if y else nothing).alias("m2_y"),
        (left("__dxy", "__dx", "__dy") if y else nothing).alias("c_xy"))


def merge_moments(states: DataFrame, groups: list[str], order: list[str] | None = None) -> DataFrame:
    """One state per ``groups`` from all of its states, merged one by one in
    the order of ``order`` (default: the part). What is gathered for a group
    are its states, as many as it has parts and extracts, never its rows."""
    order = order or ["part"]
    held = F.array_sort(F.collect_list(F.struct(*[col_of(o).alias(f"o{i}") for i, o in enumerate(order)], *_FIELDS)))

    def merged(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy = ((b[f"at_{c}"] - a[f"at_{c}"]) + (b[f"off_{c}"] - a[f"off_{c}"]) for c in "xy")
        weight = a["n"].cast("double") * b["n"] / n

        def joined(field: str, p: Column, q: Column) -> Column:
            return (a[field] + b[field] + p * q * weight).alias(field)

        return F.struct(n.alias("n"), a["at_x"].alias("at_x"), (a["off_x"] + dx * b["n"] / n).alias("off_x"),
                        a["at_y"].alias("at_y"), (a["off_y"] + dy * b["n"] / n).alias("off_y"),
                        joined("m2_x", dx, dx), joined("m2_y", dy, dy), joined("c_xy", dx, dy))

    def fields(s: Column) -> Column:
        return F.struct(*[s[f].alias(f) for f in _FIELDS])

    listed = states.where("n > 0").groupBy(*[col_of(g) for g in groups]).agg(F.transform(held, fields).alias("__s"))
    first, rest = F.get("__s", F.lit(0)), F.slice("__s", F.lit(2), F.size("__s"))
    one = F.when(F.size("__s") > 0, F.aggregate(rest, first, merged))
    return listed.select(*[col_of(g) for g in groups], one.alias("__m")).select(
        *[col_of(g) for g in groups], F.coalesce("__m.n", F.lit(0).cast("bigint")).alias("n"),
        *[F.col(f"__m.{f}").alias(f) for f in _FIELDS[1:]])


def correlation() -> Column:
    """Pearson's correlation from a state; NULL without rows, NaN where a
    column does not vary."""
    spread = F.sqrt("m2_x") * F.sqrt("m2_y")
    return F.when(F.col("n") > 0, F.when(spread == 0, F.lit(float("nan"))).otherwise(F.col("c_xy") / spread))


def sample_stddev() -> Column:
    """Sample standard deviation of x from a state; NULL under two rows."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2_x") / (F.col("n") - 1)))
