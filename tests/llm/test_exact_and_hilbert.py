import math
import random
import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmart.llm.exact import content_hash, exact_dedup
from wardmart.llm.hilbert import boundaries, hilbert_index, hilbert_shards, write_shards
from wardmart.llm.queries import ORACLE_SQL


def brute(rows):
    """Verdicts by id, for unique ids."""
    norm = {i: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r") for i, t in rows}
    out = {}
    for i, t in rows:
        group = [(-len(u or ""), j) for j, u in rows if norm[j] == norm[i]]
        out[i] = (min(group)[1], len(group))
    return out


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (7, "x"), (8, "ab "),
        (9, "a\x0bb\x0c"), (10, "long " * 50_000), (11, "long" * 50_000), (12, "Ab")]


def test_exact_matches_brute_force(make_docs):
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(make_docs(ROWS)).collect()}
    assert got == brute(ROWS)
    kept = {r.doc_id for r in exact_dedup(make_docs(ROWS)).where("kept").collect()}
    assert kept == {k for k, _ in got.values()}


def test_exact_compares_bytes_when_hashes_collide(make_docs):
    weak = lambda norm: F.char_length(norm).cast("string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(make_docs(ROWS), hash_fn=weak).collect()}
    assert got == brute(ROWS)


def test_exact_keeps_one_row_of_a_group(make_docs, empty):
    rows = [(1, "a  b"), (1, "ab"), (2, "a b"), (3, "x"), (3, "x"), (None, "x"), (None, "y"), (None, "y"), (4, None), (4, "")]
    weak = lambda norm: F.char_length(norm).cast("string")
    for hash_fn in (content_hash, weak):
        got = exact_dedup(make_docs(rows).repartition(3), hash_fn=hash_fn).collect()
        assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in got) == \
            [(0, 0, 2)] * 2 + [(0, 3, 3)] + [(1, 1, 3)] * 2 + [(2, 1, 3)] + [(3, 3, 3)] * 2 + [(4, 4, 2)] * 2
        kept = [r for r in got if r.kept]
        assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 3, 4]
        assert len({r.text_sha256 for r in kept}) == len(kept)
    assert exact_dedup(empty).count() == 0


def test_exact_decides_by_the_given_row(make_docs):
    docs = make_docs([(1, "ab"), (1, "a b"), (1, "a b"), (None, "q"), (None, "q")]) \
        .withColumn("line", F.row_number().over(Window.orderBy(F.length("text").desc(), "text")).cast("long"))
    got = {r.row: r.kept for r in exact_dedup(docs, row_col="line").collect()}
    lines = {r.line: r.text for r in docs.collect()}
    first = {t: min(k for k, u in lines.items() if u == t) for t in ("a b", "q")}
    assert {k for k, v in got.items() if v} == set(first.values()) and len(got) == 5


def test_exact_query_has_sql():
    assert "op10_exact_dedup" in ORACLE_SQL


def test_hilbert_index_visits_neighbouring_cells(spark):
    for n, bits in ((2, 3), (3, 2)):
        cells = [F.expr(f"cast(shiftright(id, {bits * i}) & {(1 << bits) - 1} as int)") for i in range(n)]
        rows = spark.range(1 << (n * bits)).select(F.array(*cells).alias("c"), hilbert_index(cells, bits).alias("h")) \
            .orderBy("h").collect()
        assert [r.h for r in rows] == list(range(len(rows)))
        assert all(sum(abs(x - y) for x, y in zip(p.c, q.c)) == 1 for p, q in zip(rows, rows[1:]))


def test_cells_have_equal_depth_whatever_the_values(spark):
    rng = random.Random(4)
    urls = [f"https://example.com/a/long/common/path/{i:03d}" for i in range(20)]
    numbers = [None, None, -5, 0, 0, 0, 7, 10 ** 15] + [rng.randint(0, 99) for _ in range(300)]
    rows = [(urls[i % 20], numbers[i % len(numbers)], rng.choice([None, 0.5, float("nan"), -1.0])) for i in range(900)]
    df = spark.createDataFrame(rows, "u string, n long, x double").repartition(4)
    assert boundaries(df, "u") == urls[1:]          # twenty values, twenty cells
    for bits in (1, 3, 5):
        for k, dim in enumerate(df.columns):
            values = [r[k] for r in rows]
            order = lambda v: (v is not None, v is not None and math.isnan(v), v) if dim != "u" else (True, False, v)
            cells = {}
            for v in {str(v): v for v in values}.values():
                before = sum(order(w)[:2] < order(v)[:2] or (order(w)[:2] == order(v)[:2] and w is not None and
                                                             w == w and w < v) for w in values)
                cells.setdefault(before * (1 << bits) // len(values), []).append(v)
            want = [min(cells[c], key=lambda v: (order(v)[:2], v)) for c in sorted(cells)][1:]
            assert str(boundaries(df, dim, bits)) == str(want), (dim, bits)
    assert boundaries(df.limit(0), "u") == []


def test_hilbert_shards_match_an_independent_curve(make_docs):
    """Rows in the order of a curve drawn by the textbook recursion."""
    rng = random.Random(6)
    texts = [(i, "w" * rng.choice([1, 2, 2, 2, 5, 9, 30, 200])) for i in range(160)] + [(3, "w" * 9), (None, "w")]
    docs = make_docs(texts)

    def curve(bits):
        def walk(x, y, ax, ay, bx, by, depth):
            if depth == 0:
                yield x, y
                return
            n = depth - 1
            step = 1 << n
            # quadrants: turned, straight, straight, turned back
            yield from walk(x, y, bx, by, ax, ay, n)
            yield from walk(x + step * ax, y + step * ay, ax, ay, bx, by, n)
            yield from walk(x + step * (ax + bx), y + step * (ay + by), ax, ay, bx, by, n)
            yield from walk(x + (2 * step - 1) * bx + (step - 1) * ax, y + (2 * step - 1) * by + (step - 1) * ay,
                            -bx, -by, -ax, -ay, n)
        return list(walk(0, 0, 1, 0, 0, 1, bits))
    bits = 3
    path = curve(bits)
    assert len(set(path)) == 64 and all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(path, path[1:]))
    edges = [boundaries(docs, d, bits) for d in ("source", "n_chars")]
    rows = docs.collect()
    cell = lambda r: tuple(sum(e <= v for e in es) for es, v in zip(edges, (r.source, r.n_chars)))
    got = hilbert_shards(docs, 7, ["source", "n_chars"], bits=bits).collect()
    want = {}
    for r in rows:
        want.setdefault((r.doc_id, zlib.crc32(r.text.encode())), set()).add(cell(r))
    # the curve's index of a cell is its place on one of the curve's symmetric forms
    index = {}
    for r in got:
        for c in want[r.doc_id, r.text_crc32]:
            index[r.curve_index] = c
    forms = [lambda c, a=a, b=b, s=s: ((c[s] ^ a), (c[1 - s] ^ b)) for a in (0, 7) for b in (0, 7) for s in (0, 1)]
    assert any(all(path[i] == f(c) for i, c in index.items()) for f in forms)
    # shards: the rows in order of (curve index, checksum, id), cut evenly
    order = sorted(got, key=lambda r: (r.curve_index, r.text_crc32, r.doc_id is not None, r.doc_id or 0))
    total = len(order)
    places = sorted((r.shard, r.slot) for r in got)
    assert [(k * 7 // total) for k in range(total)] == [s for s, _ in places]
    assert [(r.curve_index, r.text_crc32, r.doc_id) for r in sorted(got, key=lambda r: (r.shard, r.slot))] \
        == [(r.curve_index, r.text_crc32, r.doc_id) for r in order]


def test_written_shards_keep_clashing_columns(spark, make_docs, tmp_path):
    docs = make_docs([(1, "a"), (2, "b"), (3, "c")]).withColumns({"shard": F.lit("mine"), "Slot": F.lit(9)})
    write_shards(docs, 2, ["lang"], str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["shard"], r["Slot"]) for r in rows} == {("mine", 9)} and sorted(r["shard_"] for r in rows) == [0, 0, 1]


def test_hilbert_shards_are_even_ordered_and_gapless(make_docs, empty):
    texts = [(i, "w" * (i * 7 % 50)) for i in range(95)] + [(None, None), (3, "w" * 21), (96, "copy"), (97, "copy")]
    docs = make_docs(texts)
    rows = hilbert_shards(docs, 8, ["lang", "source", "n_chars"]).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(8)]
    assert len(rows) == len(texts) and max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve_index for r in order] == sorted(r.curve_index for r in order)
    text = dict(texts)
    for r in rows:
        if r.doc_id not in (None, 3):
            assert r["size"] == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    null = next(r for r in rows if r.doc_id is None)
    assert null["size"] == 16 and null.text_crc32 == 0
    assert hilbert_shards(empty, 8, ["lang", "n_chars"]).count() == 0
    assert hilbert_shards(docs.limit(3), 8, ["lang", "source"]).count() == 3


def test_written_shards_hold_null_and_repeated_ids(spark, make_docs, tmp_path):
    texts = [(i, "w" * (i * 7 % 50)) for i in range(30)] + [(None, f"null {i}") for i in range(5)] + \
        [(3, f"hot {i}") for i in range(25)]
    write_shards(make_docs(texts), 8, ["lang", "n_chars"], str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.doc_id or -1, r.text) for r in rows) == sorted((i or -1, t) for i, t in texts)
    sizes = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
