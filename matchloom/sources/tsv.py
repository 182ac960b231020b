"""Tab-separated sources and sinks of the matching workload."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import NA_CELLS, RECORD_SCHEMA
from ..functions.lists import join_ids

GROUND_TRUTH_SCHEMA = "source1_entity_id string, matched_entity_ids string"


def na_to_null(df: DataFrame) -> DataFrame:
    """Cells that a dataframe reader would take for missing become null; padded ones are text."""
    return df.select(*(F.when(F.col(c).isin(NA_CELLS), None).otherwise(F.col(c)).alias(c) for c in df.columns))


def read_tsv(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA, pandas_na: bool = False) -> DataFrame:
    """A TSV file with a header and an explicit schema; quotes are doubled inside quotes, padding is kept.

    A missing path is an error. With ``pandas_na`` cells such as NA, None or null are null.
    """
    df = spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return na_to_null(df) if pandas_na else df


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 in the order of files by name, of their blocks, and within them, without bringing rows together:
    counts by block, then offsets. How Spark deals blocks to tasks does not matter. Rows that come from no file are
    numbered by partition."""
    marked = df.withColumn("_m", F.monotonically_increasing_id())
    if df.inputFiles():
        marked = marked.withColumns({"_f": F.col("_metadata.file_path"), "_b": F.col("_metadata.file_block_start")})
    else:
        marked = marked.withColumns({"_f": F.lit(""), "_b": F.shiftright("_m", 33)})
    blocks = marked.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_s"))
    # one row for each block of a file; broadcast where Spark finds it small
    offsets = blocks.select("_f", "_b", "_s", (F.sum("_n").over(W.orderBy("_f", "_b")) - F.col("_n")).alias("_o"))
    return marked.join(offsets, ["_f", "_b"]).withColumn(name, F.col("_o") + F.col("_m") - F.col("_s")).drop("_m", "_f", "_b", "_s", "_o")


def first_rows(df: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    """The first n rows in file order; all of them for a negative n."""
    return df if n < 0 else df.where(F.col(ordinal) < n)


def filtered_scan(df: DataFrame, needed: DataFrame, chunk: int = 100_000, prefix: int = 15_000, id_col: str = "entity_id", ordinal: str = "ordinal") -> DataFrame:
    """Rows whose id is needed, and the first ``prefix`` rows of every chunk of the file; of repeated ids the first row."""
    wanted = needed.select(F.col(needed.columns[0]).alias(id_col)).distinct().withColumn("_needed", F.lit(True))
    kept = df.join(wanted, id_col, "left").where(F.col("_needed") | (F.col(ordinal) % chunk < prefix)).drop("_needed")
    return first_by_key(kept, id_col, ordinal)


def first_by_key(df: DataFrame, key: str = "entity_id", ordinal: str = "ordinal") -> DataFrame:
    """Of rows with the same key, the first in file order (partial aggregation, no window)."""
    others = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*others), ordinal).alias("_r"))
    return picked.select(key, *(F.col(f"_r.{c}").alias(c) for c in others)).select(*df.columns)


def last_by_key(df: DataFrame, key: str = "entity_id", ordinal: str = "ordinal") -> DataFrame:
    """Of rows with the same key, the last in file order, at the first one's place."""
    others = [c for c in df.columns if c not in (key, ordinal)]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*others), ordinal).alias("_r"), F.min(ordinal).alias(ordinal))
    return picked.select(key, *(F.col(f"_r.{c}").alias(c) for c in others), ordinal).select(*df.columns)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no from 1, value) of a text file, quotes not interpreted."""
    return with_ordinal(spark.read.text(path), "line_no").withColumn("line_no", F.col("line_no") + 1)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed first cells after the header, blank lines skipped; a header that further files repeat is none."""
    lines = read_lines(spark, path)
    header = lines.where("line_no = 1").select("value")
    lines = lines.where((F.col("line_no") > 1) & (F.trim("value") != "")).join(F.broadcast(header), "value", "left_anti")
    return lines.select(F.trim(F.split("value", "\t")[0]).alias("entity_id")).distinct()


def merge_parts(spark: SparkSession, folder: str, path: str) -> None:
    """The text files of a folder as one file, in the order of their names; copied as a stream, and only then put in its place."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    at = fs_path(folder)
    fs = at.getFileSystem(conf)
    parts = sorted(str(x.getPath()) for x in fs.listStatus(at) if str(x.getPath().getName()).startswith("part-"))
    begun = fs_path(f"{path}.merging")
    out = fs.create(begun, True)
    for part in parts:
        stream = fs.open(fs_path(part))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
        stream.close()
    out.close()
    fs.delete(fs_path(path), True)
    fs.rename(begun, fs_path(path))


def write_id_lists(df: DataFrame, path: str, key: str, ids: Column, column: str, order: str, one_file: bool = False) -> None:
    """A header, then key, TAB and ids for every row in ``order``: text files in a folder, sorted by name and within; with ``one_file`` these
    are written beside ``path`` and merged into it."""
    if one_file:
        parts = f"{path}.parts"
        write_id_lists(df, parts, key, ids, column, order)
        merge_parts(df.sparkSession, parts, path)
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(parts)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        return
    body = df.select(F.col(order).alias("_o"), F.concat(F.col(key), F.lit("\t"), F.coalesce(ids, F.lit(""))).alias("value"))
    header = df.sparkSession.range(1).select(F.lit(-1).cast("long").alias("_o"), F.lit(f"{key}\t{column}").alias("value"))
    header.unionByName(body.withColumn("_o", F.col("_o").cast("long"))).orderBy("_o").select("value").write.mode("overwrite").text(path)


def write_matching_results(results: DataFrame, path: str, one_file: bool = False) -> None:
    """matching_results: sorted ids, empty for a single entity, in S1 order."""
    write_id_lists(results, path, "source1_entity_id", join_ids(F.col("matched")), "matched_entity_ids", "ordinal", one_file)


def write_candidate_pairs(results: DataFrame, path: str, one_file: bool = False) -> None:
    """candidate_pairs: ids in order of rank, in S1 order."""
    write_id_lists(results, path, "source1_entity_id", F.array_join("candidates", ","), "candidate_entity_ids", "ordinal", one_file)


def read_config(path: str, default_threshold: float = 0.70) -> dict:
    """The model's JSON; a missing file gives the default threshold alone."""
    p = Path(path)
    config = json.loads(p.read_text()) if p.exists() else {}
    return {"optimal_threshold": default_threshold, **config}


def write_config(path: str, threshold: float, features: list[str], metrics: dict[str, float]) -> None:
    Path(path).write_text(json.dumps({"optimal_threshold": threshold, "feature_columns": features, **metrics}, indent=2))


def run_summary(results: DataFrame) -> DataFrame:
    """One row: entities, single ones and their share, links, candidates and their average."""
    n, m = F.count(F.lit(1)), F.size("matched")
    return results.agg(
        n.alias("entities"),
        F.count_if(m == 0).alias("singletons"),
        F.round(F.count_if(m == 0) / F.greatest(n, F.lit(1)), 6).alias("singleton_share"),
        F.coalesce(F.sum(m), F.lit(0)).cast("long").alias("links"),
        F.coalesce(F.sum(F.size("candidates")), F.lit(0)).cast("long").alias("candidate_pairs"),
        F.round(F.coalesce(F.sum(F.size("candidates")), F.lit(0)) / F.greatest(n, F.lit(1)), 6).alias("avg_candidates"),
    )
