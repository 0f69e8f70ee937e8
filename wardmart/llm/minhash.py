"""Near-duplicate documents by circulant MinHash.

Two permutations give every signature coordinate: ``sigma`` scatters the
shingles over the universe, and coordinate k is the least value of ``pi``
shifted circularly by k. A shingle's values for all coordinates are thus
one contiguous run of the (extended) ``pi`` table, and a signature is the
elementwise minimum of such runs. Signatures are cut into bands; documents
that share a band are candidates, and links are confirmed by the exact
Jaccard similarity of the full shingle sets.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import bound_batches, cut, frugal, small
from .words import WordHashes, mix, shingle_set, words

UNIVERSE_BITS = 20
SEED = 20_240_607
MAX_BANDS = 32           # wider bands are taken while so many suffice
MISS = 1e-5              # chance that a pair at the threshold shares no band
BROADCAST_IDS = 500_000  # 8-byte ids
BLOCK = 500_000          # set elements that a comparing task holds of either side


def banding(threshold: float, miss: float = MISS, max_bands: int = MAX_BANDS) -> tuple[int, int]:
    """(rows, bands): the most rows per band that miss a pair at the
    threshold with a chance of at most ``miss`` in at most ``max_bands``;
    bands of one row, as many as that chance takes, if there are none."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and is 1 at most")
    best = None
    for rows in range(1, 17):
        share = threshold ** rows
        bands = math.ceil(math.log(miss) / math.log1p(-share)) if share < 1 else 1
        if best and bands > max_bands:
            break
        best = (rows, bands)
    return best


class Circulant:
    """Signatures of shingle sets from two permutations of the universe."""

    def __init__(self, coordinates: int, bits: int = UNIVERSE_BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = 1 << bits
        self.shift = np.uint64(64 - bits)
        self.sigma = rng.permutation(size).astype(np.int32)
        pi = rng.permutation(size).astype(np.int32)
        extended = np.concatenate([pi, pi[:coordinates]])
        self.runs = np.lib.stride_tricks.sliding_window_view(extended, coordinates)
        self.coordinates = coordinates

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        cells = self.sigma[(mix(shingles) >> self.shift).astype(np.int64)]
        out = np.full(self.coordinates, np.iinfo(np.int32).max, np.int32)
        for at in range(0, len(cells), 2048):
            np.minimum(out, self.runs[cells[at:at + 2048]].min(axis=0), out=out)
        return out


def band_hashes(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    cut_up = signature[:rows * bands].reshape(bands, rows).astype(np.uint64)
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + cut_up[:, j])
    return acc.view(np.int64)


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int,
                  bands: int) -> DataFrame:
    """(id, n, set_key, bands) of every row; nothing for sets without words."""
    id_type = dict(docs.dtypes)[id_col]

    def scan(batches):
        memo, circulant = WordHashes(), Circulant(rows * bands)
        for batch in batches:
            ns, keys, found = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(memo.of(words(text.as_py())), size)
                ns.append(len(shingles))
                if len(shingles):
                    keys.append(blake2b(shingles.tobytes(), digest_size=16).hexdigest())
                    found.append(band_hashes(circulant.signature(shingles), rows, bands))
                else:
                    keys.append(None)
                    found.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(keys, pa.string()),
                 pa.array(found, pa.list_(pa.int64()))], ["id", "n", "set_key", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t")) \
        .mapInArrow(frugal(scan), f"id {id_type}, n long, set_key string, bands array<long>")


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, shingles) with the sorted 64-bit hashes as bytes, for ``ids`` only."""
    id_type = dict(docs.dtypes)[id_col]

    def scan(batches):
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_set(memo.of(words(t.as_py())), size).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())],
                                             ["id", "shingles"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return texts.join(small(ids, BROADCAST_IDS), "id", "left_semi") \
        .mapInArrow(frugal(scan), f"id {id_type}, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |A n B| >= percent * |A u B|."""
    id_type = dict(pairs.dtypes)["a"]

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b") \
        .select("a", "b", "sa", "sb").mapInArrow(frugal(check), f"a {id_type}, b {id_type}")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets in which more than one component is left,
    with their component and the bucket's largest one."""
    m = members.join(small(labels, BROADCAST_IDS), "id", "left") \
        .select("bucket", "id", "n", F.coalesce("component", "id").alias("c"))
    sizes = m.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("k"))
    live = cut(sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"),
        F.min(F.struct((-F.col("k")).alias("k"), F.col("c").alias("c")))["c"].alias("main"))
        .where("parts > 1").select("bucket", "main"), "minhash-live")
    return cut(m.join(small(live, BROADCAST_IDS), "bucket"), "minhash-open")


def _comparable(percent: int):
    """Set sizes that allow the similarity."""
    return F.expr(f"100 * least(n, other_n) >= {percent} * greatest(n, other_n)")


def _star_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """For every member of a bucket but the smallest id, one pair with the
    smallest id of one of its buckets, the one it shares most buckets with."""
    hubs = cut(open_.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("r"))
               .select("bucket", F.col("r.id").alias("other"), F.col("r.n").alias("other_n")), "minhash-hubs")
    shared = open_.join(hubs, "bucket").where((F.col("id") != F.col("other")) & _comparable(percent)) \
        .groupBy("id", "other").agg(F.count(F.lit(1)).alias("k"))
    best = shared.groupBy("id").agg(F.min(F.struct((-F.col("k")).alias("k"), F.col("other")))["other"]
                                    .alias("other"))
    return best.select(F.col("id").alias("a"), F.col("other").alias("b"))


def _open_links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every link between members of a bucket that lie in different components.

    Sets are compared through their differences to the bucket's hub B, a
    member of the largest component. With e the size of a set's symmetric
    difference to B, n its size, s the size of the intersection of two
    differences and t = (1 - j) / (1 + j), sets x and y are linked if and
    only if e_x + e_y - 2s <= t (n_x + n_y). Where x is not linked to B this
    needs s > 0. The members outside of the largest component that are not
    linked to B are compared with all members of the bucket block by block
    inside tasks, by the elements their differences share; only links leave
    a task, and a block holds about ``BLOCK`` elements however large the
    bucket is.
    """
    hubs = cut(open_.where("c = main").groupBy("bucket").agg(F.min("id").alias("hub")), "minhash-hubs")
    near = cut(open_.join(small(hubs, BROADCAST_IDS), "bucket").groupBy("id", "hub")
               .agg(F.first("c").alias("c"), F.max(F.col("c") != F.col("main")).alias("outside")), "minhash-near")
    id_type = dict(open_.dtypes)["id"]

    def differences(batches):
        for batch in batches:
            linked, sizes, diffs = [], [], []
            salts = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for x, hub, salt in zip(batch.column(5), batch.column(6), salts):
                x, hub = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(hub.as_buffer(), np.uint64)
                diff = np.setxor1d(x, hub, assume_unique=True)
                both = (len(x) + len(hub) - len(diff)) // 2
                linked.append(100 * both >= percent * (len(x) + len(hub) - both))
                sizes.append(len(x))
                # elements of different hubs never meet
                diffs.append(mix(diff + salt).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()),
                 pa.array(diffs, pa.binary())], ["id", "hub", "c", "outside", "linked", "n", "diff"])

    left = sets.select("id", F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("hub"), F.col("shingles").alias("sb"))
    apart = cut(near.join(left, "id").join(right, "hub")
                .select("id", "hub", "c", "outside", F.xxhash64("hub").alias("salt"), "sa", "sb")
                .mapInArrow(frugal(differences), f"id {id_type}, hub {id_type}, c {id_type}, outside boolean, "
                                         "linked boolean, n long, diff binary"), "minhash-apart")
    to_hub = apart.where("linked and id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))

    weight, probing = F.octet_length("diff") / 8 + 16, F.expr("outside and not linked")
    blocks = cut(apart.groupBy("hub").agg(
        F.ceil(F.sum(weight) / BLOCK).alias("ys"),
        F.ceil(F.sum(F.when(probing, weight)) / BLOCK).alias("xs")).where("xs > 0"), "minhash-blocks")
    groups = max(1, (apart.agg(F.sum(weight).alias("w")).first().w or 0) // BLOCK)
    rows = apart.join(small(blocks, BROADCAST_IDS), "hub")

    def dealt(df: DataFrame, probe: bool) -> DataFrame:
        own, other = ("xs", "ys") if probe else ("ys", "xs")
        mine = F.pmod(F.xxhash64("id"), F.col(own))
        df = df.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        key = F.xxhash64("hub", mine, "o") if probe else F.xxhash64("hub", "o", mine)
        # hubs of one block share groups of about one block
        return df.withColumn("task", F.when(F.col("ys") > 1, key).otherwise(F.pmod(F.xxhash64("hub"), F.lit(int(groups))))) \
            .select("task", F.lit(probe).alias("probe"), "id", "c", "n", "diff")

    def compare(table: pa.Table) -> pa.Table:
        ids, comps = table.column("id").combine_chunks(), table.column("c").combine_chunks()
        comp = comps.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        probe = table.column("probe").to_numpy()
        n = table.column("n").to_numpy()
        diffs = [np.frombuffer(d, np.uint64) for d in table.column("diff").to_pylist()]
        e = np.fromiter(map(len, diffs), np.int64, len(diffs))
        ys = np.flatnonzero(~probe)
        flat = np.concatenate([diffs[y] for y in ys]) if len(ys) else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(ys, e[ys])[order]
        a, b, joined = [], [], set()
        for x in np.flatnonzero(probe):
            lo, hi = np.searchsorted(flat, diffs[x], "left"), np.searchsorted(flat, diffs[x], "right")
            hit = hi > lo
            if not hit.any():
                continue
            found = np.concatenate([owner[i:j] for i, j in zip(lo[hit], hi[hit])])
            shared = np.bincount(found, minlength=len(diffs))
            y = np.flatnonzero(shared)
            apart_by = e[x] + e[y] - 2 * shared[y]
            near_enough = (100 + percent) * apart_by <= (100 - percent) * (n[x] + n[y])
            y = y[near_enough & (comp[y] != comp[x])]
            # one link joins two components, however many members are near
            other, first = np.unique(comp[y], return_index=True)
            for c, k in zip(other.tolist(), first.tolist()):
                pair = (min(c, comp[x]), max(c, comp[x]))
                if pair not in joined:
                    joined.add(pair)
                    a.append(x)
                    b.append(int(y[k]))
        return pa.table({"a": ids.take(pa.array(a, pa.int64())), "b": ids.take(pa.array(b, pa.int64()))})

    found = dealt(rows.where(probing), True).unionByName(dealt(rows, False)).groupBy("task") \
        .applyInArrow(compare, f"a {id_type}, b {id_type}")
    return to_hub.unionByName(cut(found, "minhash-found"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of
    ``shingle_words``-word shingles (a shorter text is one shingle) is at
    least ``percent`` / 100; component_id is the smallest id reachable over
    links, kept says that it is the row's own. Texts that are null or have
    no words link with nothing. Equal sets are collapsed before the search.
    Rows that repeat an id are one document with the links of all its
    texts; a null id links with nothing and is kept. Other columns are not
    read. An empty table gives no rows.

    Shingles are compared by 64-bit hashes. A pair at the threshold shares
    no band with a chance below ``MISS``. Each document is first compared
    with one smallest member of its buckets, which joins most of a group of
    copies of any size with a linear number of pairs; then the links between
    the components left in a bucket are found through the members'
    differences to its hub (``_open_links``), so no link is lost to a cap.
    """
    bound_batches(docs.sparkSession)
    rows, bands = banding(percent / 100)
    scanned = cut(_fingerprints(docs, id_col, text_col, shingle_words, rows, bands), "minhash-scan")

    usable = scanned.where("id is not null and n > 0")
    classes = cut(usable.groupBy("set_key", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"),
                                                     F.first("bands").alias("bands")), "minhash-classes")
    spread = classes.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("bucket"))
    shared = cut(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                 .select("bucket"), "minhash-buckets")
    members = cut(spread.join(small(shared, BROADCAST_IDS), "bucket"), "minhash-members")

    # rows with the representative of their set; a set without copies is its own
    same = classes.where("size > 1").select("set_key", "rep")
    placed = cut(scanned.join(small(same, BROADCAST_IDS), "set_key", "left")
                 .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")),
                 "minhash-placed")
    # an id that repeats with unlike texts links their representatives
    torn = cut(placed.where("id is not null").groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y"))
               .where("x <> y").select("id"), "minhash-torn")
    links = placed.join(small(torn, BROADCAST_IDS), "id", "left_semi") \
        .select(F.col("id").alias("a"), F.col("rep").alias("b"))
    links = links.unionByName(_search(docs, members, id_col, text_col, shingle_words, percent))

    labels = cut(components(links).select(F.col("id").alias("rep"), "component"), "minhash-labels")
    component = F.coalesce("component", "rep")
    return placed.join(small(labels, BROADCAST_IDS), "rep", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def _search(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, size: int,
            percent: int) -> DataFrame:
    """Verified links (a, b) between class representatives."""
    if members.isEmpty():
        return members.select(F.col("id").alias("a"), F.col("id").alias("b"))
    sets = cut(_sets(docs, members.select("id").distinct(), id_col, text_col, size), "minhash-sets")
    star = _star_pairs(members, percent)
    links = cut(_verified(cut(star, "minhash-star"), sets, percent), "minhash-links")
    open_ = _labelled(members, cut(components(links), "minhash-labels"))
    if open_.isEmpty():
        return links
    return links.unionByName(_open_links(open_, sets, percent))
