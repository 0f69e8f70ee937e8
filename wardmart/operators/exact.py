"""Exact sums of doubles.

A double is an integer of 53 bits times a power of two. It is cut into limbs
of 21 bits at fixed positions, its lowest limb's position being its bin, and
the limbs are added per bin as 64-bit integers: associative, so neither the
order of rows nor their splits change a bit. Only then the bins of a group,
about a hundred at most, are carried into one number and rounded to the
nearest double, once. The sum is the true one wherever it is representable,
for any magnitudes and any cancellation.

A group may have 2^41 rows before a limb could overflow, which raises.
Everything is a built-in expression; rows are combined before each shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of

LIMB = 21
LOWEST = 1074                   # 2^-1074 is the smallest double
PLACES = 2046 // LIMB + 1       # bins of a double's lowest limb
TOP = PLACES + 6                # positions that a sum of 2^41 doubles can reach
_NAN, _UP, _DOWN = 1, 2, 4


def _power(exponent: int) -> tuple[float, float]:
    """2^exponent as two factors, neither of which leaves the doubles."""
    half = exponent // 2
    return math.ldexp(1.0, half), math.ldexp(1.0, exponent - half)


def _table(exponents) -> list[str]:
    """SQL arrays of the two factors."""
    pairs = [_power(e) for e in exponents]
    return ["array(" + ", ".join(f"{p[i]!r}D" for p in pairs) + ")" for i in (0, 1)]


def _limbs(rows: DataFrame, keep: list) -> DataFrame:
    """Columns ``keep`` and, of the double ``x``: flag, bin and l0 to l3.

    Each step is a projection of its own, so that no expression is repeated.
    """
    size = F.abs("x")
    finite = F.col("x").isNotNull() & ~F.isnan("x") & (size < float("inf"))
    flag = F.when(F.isnan("x"), _NAN).when(size < float("inf"), 0) \
        .when(F.col("x") > 0, _UP).otherwise(_DOWN)
    # one below the true exponent at most, so nothing falls under the lowest limb
    place = F.floor((F.floor(F.log2(size)) + (LOWEST - 54)) / LIMB).cast("int")
    rows = rows.select(*keep, F.when(F.col("x").isNotNull(), flag).alias("flag"),
                       F.when(finite, F.signum("x").cast("bigint")).alias("sign"), size.alias("size"),
                       F.when(finite & (size > 0), F.greatest(place, F.lit(0))).alias("bin"))
    up, down = _table(LOWEST - LIMB * k for k in range(PLACES))
    rows = rows.select(*keep, "flag", "sign", "bin",
                       F.expr(f"size * get({up}, bin) * get({down}, bin)").alias("y"))
    for j in (3, 2, 1):
        unit = float(1 << LIMB * j)
        rows = rows.select("*", F.floor(F.col("y") / unit).alias(f"p{j}"))
        rows = rows.withColumn("y", F.col("y") - F.col(f"p{j}") * unit)
    signed = [F.col("y").cast("bigint"), *[F.col(f"p{j}") for j in (1, 2, 3)]]
    return rows.select(*keep, "flag", "bin", *[(F.col("sign") * p).alias(f"l{j}") for j, p in enumerate(signed)])


def _rounded_sql(bins: str) -> str:
    """The nearest double (ties to even) of a map position -> limbs.

    The limbs are carried into digits of base 2^21; a negative number shows
    as a carry out and is complemented. Its 56 highest bits or more, the
    last one set if anything is below them, round like the whole number when
    cast to a double.
    """
    base = 1 << LIMB
    limbs = " + ".join(f"coalesce(try_element_at({bins}, k - {j}).l{j}, 0L)" for j in range(4))
    carried = (f"aggregate(sequence(0, {TOP}), named_struct('d', cast(array() as array<bigint>), 'c', 0L), (a, k) -> "
               f"transform(array(a.c + {limbs}), t -> named_struct('d', concat(a.d, array(t & {base - 1}L)), "
               f"'c', shiftright(t, {LIMB})))[0])")
    lowest = "array_min(filter(transform(u.d, (d, i) -> if(d <> 0, i, null)), i -> i is not null))"
    complement = (f"transform(array({lowest}), z -> transform(u.d, (d, i) -> "
                  f"CASE WHEN i < z THEN 0L WHEN i = z THEN {base}L - d ELSE {base - 1}L - d END))[0]")
    size = (f"transform(array({carried}), u -> if(u.c >= 0, named_struct('s', 1.0D, 'd', u.d), "
            f"named_struct('s', -1.0D, 'd', {complement})))[0]")
    found = (f"transform(array({size}), m -> named_struct('s', m.s, 'd', m.d, "
             f"'t', array_max(transform(m.d, (d, i) -> if(d <> 0, i, null)))))[0]")
    digit = "if(v.t >= {j}, v.d[greatest(v.t - {j}, 0)], 0L)"
    head = f"v.d[v.t] * {base * base}L + {digit.format(j=1)} * {base}L + {digit.format(j=2)}"
    parts = (f"named_struct('s', v.s, 't', v.t, 'h', {head}, 'f', {digit.format(j=3)}, "
             f"'k', greatest(14 - length(bin(v.d[v.t])), 0), "
             f"'r', v.t > 3 and exists(slice(v.d, 1, greatest(v.t - 3, 0)), d -> d <> 0))")
    # k bits of the fourth digit still belong to the head
    bits = (f"(shiftleft(w.h, w.k) + shiftright(w.f, {LIMB} - w.k)) "
            f"| if(w.r or w.f % shiftleft(1L, {LIMB} - w.k) <> 0, 1L, 0L)")
    at = f"((w.t - 2) * {LIMB} - w.k - {LOWEST})"
    scale = f"pow(2.0D, floor({at} / 2)) * pow(2.0D, {at} - floor({at} / 2))"
    return (f"transform(array({found}), v -> if(v.t is null, 0.0D, "
            f"transform(array({parts}), w -> w.s * cast({bits} as double) * {scale})[0]))[0]")


def exact_sums(df: DataFrame, groups: list[str], sums: dict[str, str | Column],
               others: dict[str, Column] | None = None, means: dict[str, str] | None = None) -> DataFrame:
    """Group by ``groups`` (none: one row) with exact sums of doubles.

    ``sums`` maps a result name to the column summed; NULLs are skipped and
    a group without values has a NULL sum, NaN and infinities count as in
    any order of plain additions. ``means`` maps a result name to the name
    of a sum, divided by its number of values. ``others`` maps a result name
    to a column that is summed plainly beside them (whole numbers).
    """
    others, means = others or {}, means or {}
    keys = [f"__g{i}" for i in range(len(groups))]
    names = list(sums)
    plain = [F.col(f"__o{i}") for i in range(len(others))]
    rows = df.select(*[col_of(g).alias(k) for g, k in zip(groups, keys)],
                     *[c.alias(f"__o{i}") for i, c in enumerate(others.values())],
                     *[col_of(c).cast("double").alias(f"__x{i}") for i, c in enumerate(sums.values())])
    parts = F.array(*[F.struct(F.lit(i).alias("m"), F.col(f"__x{i}").alias("x")) for i in range(len(names))])
    # whole numbers beside the sums ride on the first sum's rows
    first = [F.when(F.col("v.m") == 0, c).alias(f"__o{i}") for i, c in enumerate(plain)]
    each = rows.select(*keys, *plain, F.explode(parts).alias("v")).select(*keys, *first, "v.m", "v.x")
    binned = _limbs(each, [*keys, *plain, "m"]).groupBy(*keys, "m", "bin").agg(
        *[F.sum(f"l{j}").alias(f"l{j}") for j in range(4)], F.count("flag").alias("n"),
        F.bit_or("flag").alias("flag"), *[F.sum(f"__o{i}").alias(f"__o{i}") for i in range(len(others))])
    aggs = []
    for i in range(len(names)):
        mine = F.col("m") == i
        entry = F.struct(F.col("bin").alias("key"), F.struct(*[f"l{j}" for j in range(4)]).alias("value"))
        aggs += [F.map_from_entries(F.collect_list(F.when(mine & F.col("bin").isNotNull(), entry))).alias(f"__b{i}"),
                 F.sum(F.when(mine, F.col("n"))).alias(f"__n{i}"),
                 F.coalesce(F.bit_or(F.when(mine, F.col("flag"))), F.lit(0)).alias(f"__f{i}")]
    totals = binned.groupBy(*keys).agg(*aggs, *[F.sum(f"__o{i}").alias(f"__o{i}") for i in range(len(others))])

    def value(i: int) -> Column:
        flag, n = F.col(f"__f{i}"), F.coalesce(F.col(f"__n{i}"), F.lit(0))
        return (F.when(n == 0, F.lit(None).cast("double"))
                .when((flag.bitwiseAND(_NAN) != 0) | (flag.bitwiseAND(_UP | _DOWN) == _UP | _DOWN), F.lit(float("nan")))
                .when(flag.bitwiseAND(_UP) != 0, F.lit(float("inf")))
                .when(flag.bitwiseAND(_DOWN) != 0, F.lit(float("-inf")))
                .otherwise(F.expr(_rounded_sql(f"__b{i}"))))

    summed = totals.select(
        *keys, *[f"__o{i}" for i in range(len(others))], *[f"__n{i}" for i in range(len(names))],
        *[value(i).alias(f"__s{i}") for i in range(len(names))])
    at = {name: i for i, name in enumerate(names)}
    return summed.select(
        *[F.col(k).alias(g) for g, k in zip(groups, keys)],
        *[F.when(F.col(f"__n{at[s]}") > 0, F.col(f"__s{at[s]}") / F.col(f"__n{at[s]}")).alias(name)
          for name, s in means.items()],
        *[F.col(f"__s{i}").alias(name) for i, name in enumerate(names)],
        *[F.col(f"__o{i}").alias(name) for i, name in enumerate(others)])
