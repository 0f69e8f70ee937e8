import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardmart.llm import hard_negatives as hn
from wardmart.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, slot int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows, every=5, positives=5, negatives=3):
    kept = {(i, l, tuple(math.floor(256 * float(x)) for x in v)) for i, v, l in rows
            if i is not None and l is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in kept:
        if a[0] % every:
            continue
        ranked = sorted(((sum(x * y for x, y in zip(a[2], r[2])), r) for r in kept), key=lambda s: (-s[0], s[1][0]))
        for s, p in [x for x in ranked if x[1] != a and x[1][1] == a[1]][:positives]:
            hard = [x for x in ranked if x[1][1] != a[1] and 50 * s <= 100 * x[0] <= 95 * s][:negatives]
            out += [(a[0], p[0], k, n[1][0], s, n[0]) for k, n in enumerate(hard, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                       "negative_score").collect()))


def vectors(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(4, dims))
    out = []
    for i in range(n):
        v = hubs[rng.integers(4)] + spread * rng.normal(size=dims)
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(3))))
    return out


def test_scores_are_exact():
    rng = np.random.default_rng(3)
    for dims in (1, 7, 8, 9, 64):
        for reach in (1, 100, 5_000, 1 << 20):
            rows, anchors = (rng.integers(-reach, reach, (50, dims)) for _ in range(2))
            rows[0], anchors[0] = -reach, -reach
            assert (hn.scores(hn.bit_planes(rows), hn.subset_sums(anchors)) == rows @ anchors.T).all()
    ones = np.ones((3, 5), np.int64)
    assert (hn.scores(hn.bit_planes(ones * 0), hn.subset_sums(ones)) == 0).all()


def test_negatives_match_brute_force(spark):
    rows = vectors(1, 300, 13)
    # ties, equal vectors, zero and negative scores, hostile rows
    rows += [(300 + i, rows[5][1], i % 3) for i in range(12)] + [(400, [0.0] * 13, 1), (405, [-x for x in rows[0][1]], 0)]
    rows += [(410, None, 1), (415, [None] * 13, 1), (420, [math.nan] * 13, 1), (425, [math.inf] * 13, 2),
             (430, rows[1][1], None), (None, rows[1][1], 1), (435, [], 1), (440, [1.0], 1), (445, [1.0] * 20, 2)]
    rows += [rows[10], rows[10], (10, rows[11][1], 0), (10, rows[12][1], 1)]
    random.Random(2).shuffle(rows)
    assert got(hard_negatives(frame(spark, rows), F.col("id") % 5 == 0)) == brute(rows)


def test_blocks_and_passes_change_nothing(spark, monkeypatch):
    rows = vectors(7, 120, 8, 0.4)
    for name, value in (("PASS_BYTES", 8 * 8 * 7), ("ANCHORS", 3), ("ROWS", 11)):
        monkeypatch.setattr(hn, name, value)
    assert got(hard_negatives(frame(spark, rows), F.col("id") % 5 == 0)) == brute(rows)


def test_a_label_with_a_third_of_the_rows_and_larger_numbers(spark):
    rows = [(i, [float(np.float32(x * 300)) for x in v], 0 if i % 3 else l + 1) for i, v, l in vectors(9, 150, 5)]
    assert got(hard_negatives(frame(spark, rows), F.col("id") % 5 == 0)) == brute(rows)


def test_empty_few_and_too_large(spark):
    assert got(hard_negatives(frame(spark, []), F.col("id") % 5 == 0)) == []
    assert got(hard_negatives(frame(spark, [(1, [1.0], 1)]), F.col("id") % 5 == 0)) == []
    assert got(hard_negatives(frame(spark, [(0, [1.0], 1)]), F.col("id") % 5 == 0)) == []
    few = [(0, [1.0], 1), (1, [0.5], 1), (2, [0.4], 2)]
    assert got(hard_negatives(frame(spark, few), F.col("id") % 5 == 0)) == brute(few) != []
    with pytest.raises(ValueError):
        hard_negatives(frame(spark, [(0, [1e30], 1)]), F.col("id") % 5 == 0)
