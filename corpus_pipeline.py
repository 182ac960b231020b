"""From raw documents to a training mix: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next one. All
but the last return the columns of documents, COLUMNS; further columns of the input are dropped. Empty tables of documents, labels
or benchmark items give empty or unchanged results: without labels every score is 0.5, so toxicity then rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import decontaminate, mixing, ngram_join, pii, toxicity
from matchloom.llm.base import BROADCAST_ROWS, stage, staged_alone, unstage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents at least as likely toxic as this go: the threshold from which the operator's query predicts label 1.
TOXIC = 0.3


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without the quarter that is held out for judging scores (crc32 of the id modulo 4 is 2)."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from labels, is below TOXIC; all of them where no labelled document is left."""
    labels = training_labels(spark, sf_dir)
    if not docs.join(labels.where("toxic IN (0, 1)"), "doc_id", "left_semi").limit(1).count():
        return docs.select(*COLUMNS)
    return toxicity.score_toxicity(docs, labels, carry=COLUMNS).where(F.col("score") < TOXIC).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more): the one of the smallest id,
    null last, of several texts under it the first by hash.

    Documents without words are no copies and stay; rows that repeat id and text, and are no null-id rows without words, are
    one document.
    """
    named = staged_alone(lambda: ngram_join.similar_documents(docs, with_key=True), "pipe-named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    groups = named.where("root IS NOT NULL").groupBy("root").agg(first, F.min("key").alias("lo"), F.max("key").alias("hi"))
    groups = stage(groups.where("lo <> hi").select("root", F.col("first.key").alias("kept")), "pipe-groups")
    gone = stage(named.join(groups, "root").where("key <> kept").select("key").distinct(), "pipe-gone")
    key = F.xxhash64("doc_id", "text")
    left = docs.select(*COLUMNS, key.alias("key")).join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "key", "left_anti")
    again = stage(named.where("doc_id IS NOT NULL OR root IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "pipe-again")
    if again.limit(1).count():
        bound = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
        left = left.join(bound, "key", "left_anti").union(left.join(bound, "key", "left_semi").dropDuplicates(["key"]))
    unstage(named, groups)
    return left.select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item, nor a whole shorter item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(docs, benchmark, carry=COLUMNS).where("n_hit = 0").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked; n_chars is that of the masked text."""
    masked = pii.redact_pii(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row for each copy that the mix takes of a document; sources weigh 1, 2, 3, repeating.

    COLUMNS, then copy (from 1), taken (words of this copy), size, source_size and target. Documents that the mix does not take
    are left out. Where rounding cuts a document's last copy, that row's text is its first ``taken`` words, joined by spaces.
    """
    mixed = mixing.mix_sources(docs, carry=COLUMNS).where("taken > 0")
    copies = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))
    each = mixed.select("*", F.explode(copies).alias("copy")).withColumn("part", F.least("size", F.col("taken") - (F.col("copy") - 1) * F.col("size")))
    cut = F.array_join(F.slice(mixing.words(F.col("text")), F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(F.col("part") < F.col("size"), cut).otherwise(F.col("text"))
    each = each.withColumn("n_chars", F.when(F.col("part") < F.col("size"), F.char_length(cut)).otherwise(F.col("n_chars"))).withColumn("text", text)
    return each.select(*COLUMNS, "copy", F.col("part").alias("taken"), "size", "source_size", "target")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix),
]

#: Scores, similarity components by prefix filtering, bootstrapped patterns and dual solutions are beyond SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each staged in the shared folder; what a stage has staged is deleted after it, and its input
    after the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        before, docs = docs, staged_alone(lambda f=f, docs=docs: f(spark, docs, sf_dir), f"pipe-{name}")
        unstage(before)
    return STAGES[-1][1](spark, docs, sf_dir)
