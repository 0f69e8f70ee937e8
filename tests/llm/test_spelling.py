import random
import re
from collections import Counter
from zlib import crc32

from wardmart.llm import spelling
from wardmart.llm.spelling import spelling_variants, word_counts

VOCAB = "word string, n long"


def brute_counts(rows, drop_every=31, min_length=7, min_count=2):
    seen = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(vocab, ratio=10):
    out = {}
    for w, n in vocab.items():
        near = [v for v in vocab if one_edit(w, v)]
        best = min(near, key=lambda v: (-vocab[v], v)) if near else None
        form = best if best is not None and vocab[best] >= ratio * n else None
        out[w] = [form, n, len(near), vocab[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in rows}


def vocabulary(seed=5, size=150):
    rng = random.Random(seed)
    words = Counter()
    for _ in range(size):
        base = "".join(rng.choice("abcßéÉ") for _ in range(rng.choice([1, 2, 7, 8, 9, 30, 70])))
        words[base] = rng.choice([2, 3, 30, 300, 3000, 30000])
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(base))
            kind = rng.random()
            made = base[:at] + ("" if kind < .4 else rng.choice("abcßéÉ😀")) + base[at + (kind < .7):]
            if made:
                words[made] = rng.choice([2, 3, 25, 250, 2500])
                base = made if rng.random() < .5 else base
    return dict(words)


def test_variants_match_brute_force(spark):
    vocab = vocabulary()
    df = spark.createDataFrame(list(vocab.items()), VOCAB).repartition(3)
    assert got(spelling_variants(df)) == brute_variants(vocab)


def test_small_passes_and_position_ranges_change_nothing(spark, monkeypatch):
    vocab = vocabulary(6, 60)
    monkeypatch.setattr(spelling, "FILTER_BYTES", 16)
    monkeypatch.setattr(spelling, "SEGMENT", 2)
    monkeypatch.setattr(spelling, "CELLS", 13)
    df = spark.createDataFrame(list(vocab.items()), VOCAB).repartition(2)
    assert len(spelling.passes(spelling.shard_sizes(df), 16)) > 5
    assert got(spelling_variants(df, ratio=3)) == brute_variants(vocab, 3)


def test_chains_lead_to_the_last_form(spark):
    chain = {"a" * 7 + "b" * k: 2 * 10 ** k for k in range(7)}
    chain["a" * 7 + "c"] = 20          # ties with aaaaaaab, later in order
    df = spark.createDataFrame(list(chain.items()), VOCAB)
    assert got(spelling_variants(df)) == brute_variants(chain)
    assert got(spelling_variants(df))["a" * 7][4] == "a" * 7 + "b" * 6


def test_counts_match_brute_force(make_docs):
    rng = random.Random(9)
    words = ["Überlänge", "überlange", "Straßenbahn", "strassenbahn", "ÉCOLIERS", "écoliers", "tiny", "x×÷y×÷z×÷"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "1", "!", "\n"]) for _ in range(rng.randint(0, 40))))
            for i in range(120)]
    rows += [(None, "nullified nullified identical"), (None, None), (7, ""), (7, "repeated Repeated REPEATED"),
             (8, "L" * 50_000 + " " + "L" * 50_000), (8, rows[8][1])]
    for drop in (31, 2, None):
        counted = {r.word: r.n for r in word_counts(make_docs(rows), drop_every=drop).collect()}
        assert counted == brute_counts(rows, drop)


def test_counts_do_not_depend_on_what_a_task_holds(make_docs, monkeypatch):
    rows = [(i, f"common words {'abcdefghij'[i % 7:]}tail number{i % 3}") for i in range(50)]
    want = brute_counts(rows)
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    assert {r.word: r.n for r in word_counts(make_docs(rows), drop_every=31).collect()} == want


def test_empty_repeated_and_null_words(spark, empty):
    assert spelling_variants(word_counts(empty)).collect() == []
    df = spark.createDataFrame([("abcdefg", 1), ("abcdefg", 2), (None, 5), ("abcdefh", 30), ("zero", 0)], VOCAB)
    assert got(spelling_variants(df)) == brute_variants({"abcdefg": 3, "abcdefh": 30})
