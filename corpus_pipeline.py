"""Corpus cleaning pipeline: each stage works on all that the one before kept.

Stages drop rows, not ids: a verdict falls on the very row it was reached
for, so rows that repeat a doc_id or have none are cleaned like all others.
Of exact copies, of rows that are near each other and of rows that hold a
benchmark item, all go but those that the operators keep. Null and empty
texts are clean, equal to each other, near nothing and hold no item. An
empty table passes through as an empty table. Every column of the input
passes through, whatever its name; the last stage's own columns get a
leading underscore where the input has one of their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardmart.llm.bpe import bpe_encode
from wardmart.llm.decontaminate import contamination
from wardmart.llm.exact import exact_dedup
from wardmart.llm.minhash import near_duplicates
from wardmart.llm.queries import table, tokenizer_path
from wardmart.llm.shared import cut, scratch, small
from wardmart.llm.toxicity import THRESHOLD, scorer, train_model, training_fold

# Rows to drop are broadcast up to this count (8 bytes each); beyond it the
# documents are shuffled on their row numbers.
BROADCAST_ROWS = 500_000
# Names of files are broadcast up to this count (some 200 bytes each).
BROADCAST_FILES = 100_000
FILE_ROWS = 40              # bits of a row's place in its file


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many leading underscores as it takes to be new."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that numbers its rows, and its name.

    Rows of a table that was read from files have a place in their file, the
    same at every reading; other tables are written first.
    """
    row = free_name("__row", docs.columns)
    try:
        path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        # files in order of their names; a job over the names alone
        files = docs.select(path.alias("f")).distinct()
        files = cut(files.withColumn("n", F.row_number().over(Window.orderBy("f")).cast("long")), "files")
        at = docs.withColumns({f"{row}f": path, f"{row}p": place})
        joined = at.join(small(files, BROADCAST_FILES), F.col(f"{row}f") == F.col("f"))
        return joined.select(*[F.col(f"`{c}`") for c in docs.columns],
                             (F.shiftleft("n", FILE_ROWS) + F.col(f"{row}p")).alias(row)), row
    except AnalysisException:
        return cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers are in ``gone``, and without
    the numbers."""
    kept = docs.join(small(cut(gone.select(F.col("row").alias(row)).distinct(), "dropped"), BROADCAST_ROWS), row,
                     "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns if c != row])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the threshold. It learns
    from the labels outside the held-out fold."""
    model = train_model(docs, table(spark, sf_dir, "labels"), training_fold)
    return docs.where(scorer(spark, model)(F.col("text")) < THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal but for white space: the longest,
    of these the one of the smallest doc_id."""
    rows, row = numbered(docs)
    return without(rows, row, exact_dedup(rows, row_col=row).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by 0.8 of their five-word shingles: that
    of the smallest doc_id."""
    rows, row = numbered(docs)
    found = cut(near_duplicates(rows, id_col=row, shingle_words=5, percent=80)
                .select(F.col(row).alias("row"), "component_id"), "near")
    groups = cut(found.groupBy("component_id").count().where("count > 1").select("component_id"), "near-groups")
    members = found.join(small(groups, BROADCAST_ROWS), "component_id") \
        .join(rows.select(F.col(row).alias("row"), "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    stays = cut(members.groupBy("component_id").agg(first).select(F.col("first.row").alias("row")), "near-kept")
    return without(rows, row, cut(members.select("row"), "near-members")
                   .join(small(stays, BROADCAST_ROWS), "row", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    rows, row = numbered(docs)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), id_col=row)
    return without(rows, row, found.select(F.col(row).alias("row")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids instead of the text, and digests
    of the ids and of the text decoded from them: ids, n_tokens, ids_sha256,
    decoded_sha256, by these names or with a leading underscore."""
    taken = [c for c in docs.columns if c != "text"]
    ids, count, ids_hash, text_hash = (free_name(n, taken) for n in ("ids", "n_tokens", "ids_sha256", "decoded_sha256"))
    decoded = free_name("decoded", [*taken, ids, count, ids_hash, text_hash])
    coded = bpe_encode(docs, tokenizer_path(), ids_col=ids, decoded_col=decoded)
    return coded.withColumns({
        count: (F.octet_length(F.col(f"`{ids}`")) / 4).cast("long"), ids_hash: F.sha2(F.col(f"`{ids}`"), 256),
        text_hash: F.sha2(F.col(f"`{decoded}`").cast("binary"), 256)}).drop(decoded)


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("minhash near dedup", near),
          ("benchmark decontamination", decontaminate), ("bpe", encode)]

# The classifier, the MinHash groups and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from the shared folder; all that the
    stages wrote on the way there is deleted."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as written:
        for name, stage in STAGES:
            docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        written.pop()           # the result's own folder
    return docs
