import math
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wardmart.llm import shared
from wardmart.llm.queries import table, tokenizer_path
from wardmart.llm.toxicity import GRAMS, THRESHOLD, buckets, train_model, training_fold

from .conftest import gibberish

SMALL = "/root/testdata/sf0.001"


def brute(spark, sf_dir, rows):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the documents that stay."""
    model = train_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training_fold)

    def toxic(text):
        score = model.intercept + float(sum(model.weights[b] for b in set(buckets(text or "").tolist())))
        return 1 / (1 + math.exp(-score)) >= THRESHOLD
    rows = [(i, t) for i, t in rows if not toxic(t)]

    norm = {i: re.sub(r"[ \t-\r]", "", t or "") for i, t in rows}
    best = {}
    for i, t in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0])):
        best.setdefault(norm[i], i)
    rows = [(i, t) for i, t in rows if best[norm[i]] == i]

    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    rows = [(i, t) for i, t in rows if find(i) == i]

    split = lambda t: re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (t or "").lower()).split()
    shingles = lambda w: Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
    items = [split(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    df = Counter(x for w in items for x in set(shingles(w)))
    weight = lambda x: math.log1p(len(items) / df.get(x, 1))

    def leaked(text):
        w = split(text)
        known = {x for x in shingles(w) if x in df}
        for item in items if known else ():
            own, n = shingles(item), min(len(item), len(w))
            for a in range(len(w) - n + 1) if known & own.keys() else ():
                c = shingles(w[a:a + n])
                if sum(weight(x) * v for x, v in (c & own).items()) >= \
                        (0.8 - 1e-12) * sum(weight(x) * v for x, v in (c | own).items()):
                    return True
        return False
    rows = [(i, t) for i, t in rows if not leaked(t)]

    tok = Tokenizer.from_file(tokenizer_path())
    tok.no_truncation()
    tok.no_padding()
    out = set()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.add((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_pipeline_matches_brute_force(spark):
    assert max(GRAMS) >= 4
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = corpus_pipeline.run(spark, SMALL).collect()
    want = brute(spark, SMALL, rows)
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert 100 < len(want) < len(rows) and len(got) == len(want)
    assert all(sha256(bytes(r.ids)).hexdigest() == r.ids_sha256 for r in got)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns_and_takes_odd_rows(spark, make_docs, empty, name, stage):
    docs = make_docs([(1, "some clean words"), (1, "some clean words"), (2, None), (3, ""), (None, "other words"),
                      (4, "long words " * 20_000)])
    out = stage(spark, docs, SMALL)
    if name != "bpe":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids = sorted((r.doc_id or 0) for r in out.collect())
        # of the null and the empty text one stays as an exact copy, of equal rows one
        want = {"exact dedup": [0, 1, 2, 4], "minhash near dedup": [0, 1, 2, 3, 4]}
        assert ids == want.get(name, [0, 1, 1, 2, 3, 4])
    else:
        assert out.count() == 6 and {"doc_id", "lang", "score", "ids", "n_tokens"} <= set(out.columns)
    assert stage(spark, empty, SMALL).count() == 0


def test_rows_without_or_with_repeated_ids_are_cleaned_too(spark, make_docs, tmp_path):
    item = table(spark, SMALL, "benchmark").first().text
    rng = random.Random(3)
    base = gibberish(rng, 60).split()
    copy = " ".join(base[:-1] + ["changed"])
    rows = [(None, f"words before {item}"), (5, f"{item} words after"), (5, "clean words of five"),
            (None, "same text"), (None, "same  text"), (7, " ".join(base)), (None, copy), (7, copy + "  ")]
    docs = make_docs(rows)
    path = f"file://{tmp_path}/docs"
    docs.repartition(3).write.parquet(path)
    for source in (docs, spark.read.parquet(path)):
        left = [sorted(r.text for r in stage(spark, source, SMALL).collect()) for _, stage in corpus_pipeline.STAGES[1:4]]
        texts = sorted(t for _, t in rows)
        assert left[0] == sorted(set(texts) - {"same text", copy})              # the longer copy stays
        kinds = ["changed" in t or t == rows[5][1] for t in left[1]], [item in t for t in left[1]]
        assert len(left[1]) == 4 and [sum(k) for k in kinds] == [1, 1] and rows[2][1] in left[1]
        assert left[2] == sorted(t for t in texts if item not in t)


def test_encoding_keeps_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "some words"), (2, None)]).withColumns({
        "ids": F.lit("mine"), "decoded": F.lit(3), "n_tokens": F.lit("x"), "IDS_SHA256": F.lit(True)})
    out = corpus_pipeline.encode(spark, docs, SMALL)
    assert out.columns == [c for c in docs.columns if c != "text"] + ["_ids", "_n_tokens", "_ids_sha256", "decoded_sha256"]
    row = out.where("doc_id = 1").first()
    assert (row.ids, row.decoded, row.n_tokens, row["IDS_SHA256"]) == ("mine", 3, "x", True)
    assert row["_n_tokens"] == len(row["_ids"]) // 4 == 2


def test_run_leaves_its_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_root", lambda spark: f"file://{tmp_path}")
    out = corpus_pipeline.run(spark, SMALL)
    assert [f.name.rsplit("-", 1)[0] for f in (tmp_path / "llm").iterdir()] == ["bpe"]
    assert out.count() > 100


def test_every_stage_drops_what_it_finds(spark):
    docs = table(spark, SMALL, "documents")
    item = table(spark, SMALL, "benchmark").first().text
    text = docs.where("n_chars > 400").first().text
    changed = text.split(" ")
    changed[len(changed) // 2] = "changed"
    planted = spark.createDataFrame(
        [(10_001, "before it " + item + " after it"), (10_002, text.replace(" ", "  ")), (10_003, " ".join(changed))],
        "doc_id long, text string")
    docs = docs.unionByName(planted, allowMissingColumns=True)
    for (name, stage), doc in zip(corpus_pipeline.STAGES[1:4], (10_002, 10_003, 10_001)):
        left = stage(spark, docs, SMALL).where(F.col("doc_id") == doc).count()
        # the exact copy has more characters: its original goes instead
        assert left == (1 if name == "exact dedup" else 0)
