"""Target-distribution importance resampling: hashed n-gram bucket frequencies, and a draw by weights with Gumbel noise."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import carried, restored, stage, unstage

#: A-Z lower-cased, all other bytes as they are.
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
#: On UTF-8 bytes after that: runs of digits, letters and all that is not ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Bytes of a text whose words are cut at a time.
CHUNK = 1 << 18


@dataclass(frozen=True)
class Draw:
    """longest: words of a feature; buckets: that features fall in (what is shipped: one number each); least: words of a document that
    can be drawn; percent: of those, to be drawn; seed: of the noise."""

    longest: int = 1
    buckets: int = 10_000
    least: int = 20
    percent: int = 10
    seed: str = "2024"


def words(text: bytes) -> Iterator[list[bytes]]:
    """A text's words in order, some at a time, so that a long text takes no more memory than its own."""
    text = text.translate(LOWER)
    begin = 0
    while begin < len(text):
        gap = GAP.search(text, begin + CHUNK)
        end = gap.start() if gap else len(text)
        yield WORD.findall(text, begin, end)
        begin = end


def features(text: bytes, rule: Draw) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of a text's chunks, in one scan.

    A ring holds the running checksums of the last ``longest`` starts. Each word adds a start and extends the others by a space and
    itself; every state is then a feature's checksum.
    """
    live: list[int] = []
    for some in words(text):
        found: list[int] = []
        for word in some:
            live = [crc32(word), *[crc32(word, crc32(b" ", c)) for c in live[: rule.longest - 1]]] if rule.longest > 1 else [crc32(word)]
            found += live
        yield len(some), np.array(found, np.int64) % rule.buckets


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for t in batch.column("text").cast(pa.large_binary()):
        yield t.as_py() or b""


def bucket_counts(texts: DataFrame, text_col: str, rule: Draw) -> DataFrame:
    """(bucket, n) of all features of a table; a task sends a row for each bucket that it met."""

    def run(batches):
        total = np.zeros(rule.buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                for _, bucket in features(text, rule):
                    total += np.bincount(bucket, minlength=rule.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", rule: Draw = Draw()) -> DataFrame:
    """(bucket, gain): 1000 times the log of how much likelier the target has the bucket than the documents, floored, each bucket with
    one count more than it has. One row for each of ``rule.buckets``."""
    s, t = bucket_counts(docs, text_col, rule).withColumnRenamed("n", "s"), bucket_counts(target, target_col, rule).withColumnRenamed("n", "t")
    both = s.join(t, "bucket", "full").join(docs.sparkSession.range(rule.buckets).select(F.col("id").cast("int").alias("bucket")), "bucket", "right")
    both = stage(both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "gains", rule.buckets)
    totals = both.agg(F.sum("s"), F.sum("t")).first()
    there = lambda c: F.col(c).cast("double") + 1.0
    out = both.select("bucket", F.floor(1000.0 * F.log(there("t") * float(totals[0] + rule.buckets) / (there("s") * float(totals[1] + rule.buckets)))).alias("gain"))
    out._staged_at = both._staged_at
    return out


def noise(id_: Column, seed: str) -> Column:
    """Gumbel noise by a digest of the id, times 1000, floored; a null id is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, rule: Draw, carry: list[str]) -> tuple[DataFrame, list[str]]:
    """(id, n_words, n_features, weight, carried columns): a document's mean gain, floored; 0 without features."""
    shipped = docs.sparkSession.sparkContext.broadcast(gains)
    source, names, schema = carried(docs, id_col, text_col, carry)

    def run(batches):
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in _texts(batch):
                n, k, total = 0, 0, 0
                for w, bucket in features(text, rule):
                    n, k, total = n + w, k + len(bucket), total + int(shipped.value[bucket].sum())
                n_words.append(n)
                n_features.append(k)
                weight.append(total // k if k else 0)
            own = [batch.column("id"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(own + [batch.column(c) for c in names], ["id", "n_words", "n_features", "weight", *names])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long{schema}"), names


def ranked(rows: DataFrame, by: list[Column], rank: str, partitions: int) -> DataFrame:
    """Rows numbered from 1 in the order ``by``, without bringing them together: sorted ranges, whose sizes are summed up.

    A range is written with each row's place in it; the sizes are one row a range, so the table of offsets is as long as there are
    ranges. A key with many rows is split over ranges by the later columns of the order.
    """
    placed = rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id())
    placed = stage(placed, "ranked")
    sizes = placed.groupBy(F.shiftright("_m", 33).alias("_p")).count().collect()
    offsets, total = [], 0
    for p, n in sorted((r["_p"], r["count"]) for r in sizes):
        offsets.append((p, total))
        total += n
    table = rows.sparkSession.createDataFrame(offsets, "_p long, _o long")
    joined = placed.withColumn("_p", F.shiftright("_m", 33)).join(F.broadcast(table), "_p")
    out = joined.withColumn(rank, F.col("_o") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_p", "_o", "_m")
    out._staged_at = placed._staged_at
    return out


def importance_resample(docs: DataFrame, target: DataFrame, rule: Draw = Draw(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document: those with a rank are drawn, best score first.

    A document's weight is the mean gain of its features, its score the weight with Gumbel noise; of the documents with ``least`` words
    ``percent`` in 100 (rounded down) are drawn by score, ties by smaller id. Two passes over the texts; counts of
    ``buckets`` numbers reach the driver and the tasks, and one sort by ranges of what can be drawn.

    Null and empty texts have no features, weight 0, and are never drawn. A null id is drawn by the noise of an empty one and stands
    first among ties. Repeated rows score alike and each has a rank of its own. An empty target makes all buckets count alike but for
    how common they are; empty documents give an empty table. Columns to ``carry`` follow the result, others are not read.
    """
    gains = bucket_gains(docs, target, text_col, target_col, rule)
    table = gains.toArrow()
    unstage(gains)
    shipped = np.zeros(rule.buckets, np.int64)
    shipped[np.asarray(table["bucket"])] = np.asarray(table["gain"])
    found, names = weighed(docs, shipped, id_col, text_col, rule, list(carry))
    found = stage(found.withColumn("score", F.col("weight") + noise(F.col("id"), rule.seed)), "weighed")
    can, cannot = found.where(F.col("n_words") >= rule.least), found.where(F.col("n_words") < rule.least)
    drawn = can.count() * rule.percent // 100
    partitions = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ranked(can, [F.desc("score"), F.asc_nulls_first("id")], "rank", partitions)
    order = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    both = order.unionByName(cannot.withColumn("rank", F.lit(None).cast("long")))
    return restored(both, id_col, text_col, list(carry), ["n_features", "weight", "score", "rank"])
