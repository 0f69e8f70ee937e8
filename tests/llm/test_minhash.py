import random

import numpy as np
import pytest

from wardmart.llm import minhash
from wardmart.llm.minhash import Circulant, banding, near_duplicates
from wardmart.llm.words import WordHashes, shingle_set, words

from .conftest import gibberish


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append(frozenset(tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1)))
                                      if w else frozenset())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in a for y in b):
                p, q = find(i), find(j)
                comp[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def cases():
    rng = random.Random(4)
    rows = []
    for _ in range(12):
        base = gibberish(rng, rng.randint(8, 120)).split()
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "word", gibberish(rng, 1)])
            rows.append(" ".join(copy).upper() if rng.random() < .2 else "\n".join(copy))
    rows += ["", None, "  ", "one", "one", "One", "one two", "two one"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_match_brute_force(make_docs):
    rows = cases()
    for size, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: r for r in near_duplicates(make_docs(rows), shingle_words=size, percent=percent).collect()}
        want = brute(rows, size, percent)
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_a_group_over_many_blocks(make_docs, monkeypatch):
    # copies of one text whose own differences overlap little: many pairs are
    # near the threshold, and the comparison runs over several blocks
    monkeypatch.setattr(minhash, "BLOCK", 300)
    rng = random.Random(7)
    base = gibberish(rng, 60).split()
    rows = []
    for i in range(120):
        copy = list(base)
        for p in rng.sample(range(60), rng.randint(1, 4)):
            copy[p] = f"w{rng.randrange(30)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in near_duplicates(make_docs(rows), shingle_words=3, percent=85).collect()}
    assert got == brute(rows, 3, 85)


def test_repeated_ids_null_ids_and_empty_table(make_docs, empty):
    rng = random.Random(1)
    a, b = gibberish(rng, 30), gibberish(rng, 40)
    rows = [(5, a), (5, b), (2, a), (9, b), (None, a), (7, ""), (7, "")]
    out = near_duplicates(make_docs(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == {5: 2, 2: 2, 9: 2, None: None, 7: 7}
    assert len(out) == 7 and all(r.kept for r in out if r.doc_id in (None, 7))
    assert near_duplicates(empty).count() == 0


def test_low_thresholds_get_the_bands_they_need(make_docs):
    for t in (0.05, 0.2, 0.3):
        rows, bands = banding(t)
        assert rows == 1 and (1 - t) ** bands <= 1e-5
    assert banding(1.0)[1] == 1
    for t in (0, -0.1, 1.1):
        with pytest.raises(ValueError):
            banding(t)
    rng = random.Random(12)
    words_ = gibberish(rng, 60).split()
    docs = [" ".join(rng.sample(words_, 40)) for _ in range(30)] + [gibberish(rng, 40) for _ in range(10)]
    got = {r.doc_id: r.component_id for r in near_duplicates(make_docs(docs), shingle_words=1, percent=20).collect()}
    assert got == brute(list(enumerate(docs)), 1, 20)


def test_two_large_near_groups_are_joined_by_few_links(spark, monkeypatch):
    # two groups of k members, all of one group near all of the other
    k = 1_000
    found = []
    real = minhash.cut
    monkeypatch.setattr(minhash, "cut", lambda df, name: found.append((name, real(df, name))) or found[-1][1])
    docs = spark.range(2 * k).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> concat('w', i)), "
        "IF(id % 2 = 0, 'left left1 left2', 'right right1 right2'), concat('own', id)) AS text")
    rows = near_duplicates(docs, shingle_words=1, percent=85).collect()
    assert {r.component_id for r in rows} == {0}
    links = [df.count() for name, df in found if name in ("minhash-found", "minhash-links")]
    assert sum(links) <= 6 * k


def test_banding_misses_few_pairs():
    for t in (0.8, 0.85, 0.95):
        rows, bands = banding(t)
        assert (1 - t ** rows) ** bands <= 1.1e-5 and bands <= minhash.MAX_BANDS


def test_signature_is_circulant_and_estimates_similarity():
    c = Circulant(128, bits=16)
    memo = WordHashes()
    rng = random.Random(3)
    w = gibberish(rng, 400).split()
    x, y = (shingle_set(memo.of(words(" ".join(v).encode())), 3) for v in (w, w[:360]))
    direct = [min(int(c.runs[cell][k]) for cell in c.sigma[(minhash.mix(x) >> c.shift).astype(np.int64)])
              for k in (0, 1, 127)]
    assert [int(c.signature(x)[k]) for k in (0, 1, 127)] == direct
    assert abs((c.signature(x) == c.signature(y)).mean() - 0.9) < 0.1
