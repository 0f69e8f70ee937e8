"""Catalogue entries of the training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .decontaminate import contamination
from .exact import exact_dedup
from .hard_negatives import hard_negatives
from .hilbert import hilbert_shards
from .katz import katz_scores
from .minhash import near_duplicates
from .packing import pack_documents, packed_rows
from .pii import pii_spans
from .secret_scan import secret_spans, span_text
from .shared import cut, fold
from .spelling import spelling_variants, word_counts
from .suffixes import repeated_passages
from .toxicity import toxicity

SHARDS = 40


def tokenizer_path() -> str:
    """The installed public word-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity_nb_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets with their ownership class over the corpus:
    the owner of a document is its source, the repository its source and language."""
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", span_text(F.col("spans")).alias("spans"),
        F.expr("size(filter(values, v -> v.class = 'copied'))").cast("long").alias("n_copied"),
        F.expr("size(filter(values, v -> v.class = 'live'))").cast("long").alias("n_live"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near copies (3 words, 0.85)."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document's token ids and the text decoded from them, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_encode(docs, path or tokenizer_path(), decoded_col="decoded")
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that stands in two places."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packed_tokens(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every packed row of the documents' token ids, as written and read again."""
    packed = cut(pack_documents(table(spark, sf_dir, "documents"), path or tokenizer_path()), "packed", wide=True)
    return packed_rows(packed).select(
        "partition", "block", "row", "n_tokens", F.col("ids").alias("doc_ids"), "starts", "lengths", "cu_seqlens",
        F.sha2("input_ids", 256).alias("ids_sha256"), F.sha2("position_ids", 256).alias("positions_sha256"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards along a Hilbert curve over language, source and length."""
    docs = table(spark, sf_dir, "documents")
    return hilbert_shards(docs, SHARDS, ["lang", "source", "n_chars"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index")


def op9_katz_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by a Katz bigram model of the training fold."""
    held = fold("doc_id", 7) == 2
    return katz_scores(table(spark, sf_dir, "documents"), ~held, F.coalesce(held, F.lit(False)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row kept for its white-space-free text."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_spelling_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of 7 letters or more with its near words, form and root."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), drop_every=31))


def op12_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: fixed patterns and learned contexts."""
    return pii_spans(table(spark, sf_dir, "documents")).withColumn("spans", span_text(F.col("spans")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every positive of every fiftieth vector; every
    seventh vector passes for one of the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_nb_ngrams": op1_toxicity_nb_ngrams,
    "op2_secret_ownership": op2_secret_ownership,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_benchmark_windows": op6_benchmark_windows,
    "op7_packed_tokens": op7_packed_tokens,
    "op8_hilbert_shards": op8_hilbert_shards,
    "op9_katz_bigrams": op9_katz_bigrams,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_bloom": op11_spelling_bloom,
    "op12_pii_bootstrap": op12_pii_bootstrap,
    "op13_hard_negatives": op13_hard_negatives,
}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL: dict[str, str] = {
    "op10_exact_dedup": f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
             translate(coalesce(text, ''), {_WHITE}, '') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
  CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)""",
    # crc32 by its table of 256 entries; near words meet in what is left of
    # them without one code point, or with a gap in its place
    "op11_spelling_bloom": """
WITH RECURSIVE crc AS (SELECT list(list_reduce([i] || range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
runs AS (SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
held AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hexed
         FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
coded AS (SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(length(hexed) // 2),
            lambda k: CAST('0x' || substr(hexed, 2 * k + 1, 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM held, crc),
typed AS (SELECT CASE WHEN h % 31 <> 0 THEN run ELSE substr(run, 1, h % length(run))
            || substr(run, h % length(run) + 2) END AS word, n FROM coded),
vocab AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (SELECT DISTINCT a.word, a.n, b.word AS w, b.n AS wn FROM cuts a
           JOIN cuts b ON a.head || '*' || a.tail = b.head || '*' || b.tail AND a.word <> b.word
         UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN vocab b ON a.head || a.tail = b.word
         UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN vocab b ON a.head || a.tail = b.word),
best AS (SELECT word, count(*) AS n_near, max(wn) AS most FROM near GROUP BY word),
chosen AS (SELECT word, w AS form, wn AS form_n FROM near JOIN best USING (word) WHERE wn = most AND wn >= 10 * n
           QUALIFY row_number() OVER (PARTITION BY word ORDER BY w) = 1),
walk AS (SELECT word, word AS root FROM vocab
         UNION ALL SELECT walk.word, form FROM walk JOIN chosen ON chosen.word = walk.root)
SELECT word, form, (SELECT last.root FROM walk last WHERE last.word = v.word
                    AND last.root NOT IN (SELECT word FROM chosen)) AS root,
  v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM vocab v LEFT JOIN best USING (word) LEFT JOIN chosen USING (word)""",
    # sums of products below 2^53 are exact in doubles
    "op13_hard_negatives": """
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS alike,
        CAST(list_dot_product(a.q, e.q) AS BIGINT) AS score
      FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
