"""Business records derived from the driver's documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import with_clean


#: Words of a text that a record takes, and characters of it that are cleaned before the whole text is.
WORDS, HEAD = 14, 512


def first_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds _words: the first ``WORDS`` words of the cleaned text.

    Cleaning goes character by character and joins what it drops, so a cut can only change the last word before it: where a text's
    head gives more words than are asked for, these are the text's. Any other text is cleaned whole.
    """
    head = with_clean(docs.withColumn("_head", F.substring(text, 1, HEAD)), {"_clean": "_head"}).withColumn("_found", F.split("_clean", " "))
    more = (F.octet_length(text) > F.octet_length("_head")) & (F.size("_found") <= WORDS)
    whole = with_clean(head.withColumn("_rest", F.when(more, F.col(text))), {"_whole": "_rest"})
    words = F.when(F.col("_rest").isNull(), F.col("_found")).otherwise(F.split("_whole", " "))
    return whole.withColumn("_words", F.slice(words, 1, WORDS)).drop("_head", "_clean", "_found", "_rest", "_whole")


def biz_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, business_name, business_address, country, ordinal, copy_of) of every document.

    The source number, a name of the first four words with a legal suffix, an address of n_chars, a street word and the
    next ten words; ``copy_of`` (a digest of the text) is the weak ground truth.
    """
    docs = first_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    words = F.col("_words")
    number = F.substring("source", 4, 10).cast("int") % 3 + 1
    pick = lambda key, values: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col("doc_id") % len(values) + 1).cast("int"))
    suffix = pick("doc_id", ["", "pvt ltd", "corp", "sarl", "inc"])
    street = pick("doc_id", ["rd", "st", "ave", "blvd"])
    return docs.select(
        F.concat(F.lit("S"), number, F.lit("-"), "doc_id").alias("entity_id"),
        F.trim(F.concat_ws(" ", F.array_join(F.slice(words, 1, 4), " "), suffix)).alias("business_name"),
        F.concat_ws(" ", F.col("n_chars").cast("string"), street, F.array_join(F.slice(words, 5, 10), " ")).alias("business_address"),
        F.col("lang").alias("country"),
        F.col("doc_id").alias("ordinal"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("copy_of"),
    )


def of_source(records: DataFrame, number: int) -> DataFrame:
    return records.where(F.col("entity_id").startswith(f"S{number}-"))


def ground_truth(records: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): entities of the other sources with the same text; '' for none."""
    s1 = of_source(records, 1).select(F.col("entity_id").alias("s1_id"), "copy_of")
    others = records.where(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("cand_id"), "copy_of")
    pairs = s1.join(others, "copy_of", "left")
    return pairs.groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias("matched_entity_ids"))
