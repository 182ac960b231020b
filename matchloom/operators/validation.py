"""Checks of result files against the output contract."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tsv import read_ids, read_lines

FINDING = "rule string, level string, n long, examples array<string>"
MATCH_HEADER = "source1_entity_id\tmatched_entity_ids"
CANDIDATE_HEADER = "source1_entity_id\tcandidate_entity_ids"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def finding(df: DataFrame, rule: str, level: str, example: Column) -> DataFrame:
    """One row if ``df`` has any: how many offenders, and the first five of them in order."""
    return grouped(df.select(F.lit(rule).alias("rule"), example.cast("string").alias("e")), level)


def grouped(offenders: DataFrame, level: str = "error") -> DataFrame:
    """A row for each rule among offenders (rule, e): their number, and the first five in order. Counts are summed and examples
    cut to five in the tasks first, so a rule that every line breaks is no hot key."""
    by = W.partitionBy("rule")
    # pre-aggregated: equal examples are one row with a number
    some = offenders.groupBy("rule", "e").agg(F.count(F.lit(1)).alias("k"))
    n = some.groupBy("rule").agg(F.sum("k").alias("n"))
    top = some.withColumn("r", F.row_number().over(by.orderBy(F.col("e")))).where("r <= 5")
    five = top.groupBy("rule").agg(F.slice(F.flatten(F.array_sort(F.collect_list(F.array_repeat("e", F.least("k", F.lit(5)).cast("int"))))), 1, 5).alias("examples"))
    return n.join(F.broadcast(five), "rule").select("rule", F.lit(level).alias("level"), "n", "examples")


def note(spark: SparkSession, rule: str, level: str, text: str) -> DataFrame:
    return spark.createDataFrame([(rule, level, 1, [text])], FINDING)


def result_rows(lines: DataFrame) -> DataFrame:
    """(line_no, s1_id, ids, has_tab) of the non-blank lines after the header; ids are not trimmed, '' gives none."""
    rows = lines.where((F.col("line_no") > 1) & (F.trim("value") != ""))
    tab = F.instr("value", "\t")
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    return rows.select(
        "line_no",
        (tab > 0).alias("has_tab"),
        F.when(tab > 0, F.expr("substring(value, 1, instr(value, '\t') - 1)")).otherwise(F.col("value")).alias("s1_id"),
        F.when((tab > 0) & (F.trim(rest) != ""), F.split(rest, ",", -1)).otherwise(F.array().cast("array<string>")).alias("ids"),
    )


def list_findings(lines: DataFrame, header: str, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Findings V-02 to V-12 and V-18 of one result file: lines (line_no, value); required S1 ids; target ids if they are checked."""
    line = lines.select("line_no", "value")
    first = F.lower(F.trim("value"))
    comma = F.col("value").contains(",") & ~F.col("value").contains("\t")
    heads = line.where("line_no = 1").select(F.when(comma, "V-03").when(first != header, "V-04").alias("rule"), F.col("value").alias("e")).where("rule IS NOT NULL")
    rows = result_rows(lines)
    known = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    # one pass: what is wrong with a line by itself, and with each of its ids
    flaw = lambda when, rule, example: F.when(when, F.array(F.struct(F.lit(rule).alias("rule"), example.cast("string").alias("e")))).otherwise(F.array())
    of_line = F.concat(
        flaw(~F.col("has_tab"), "V-05", F.concat(F.lit("line "), F.lpad(F.col("line_no").cast("string"), 9, "0"))),
        flaw(F.col("has_tab") & (F.size("ids") != F.size(F.array_distinct("ids"))), "V-07", F.col("s1_id")),
        F.when(F.col("has_tab"), F.transform(
            F.filter("ids", lambda x: ~x.startswith("S2-") & ~x.startswith("S3-")),
            lambda x: F.struct(F.when(x.startswith("S1-"), "V-08").otherwise("V-09").alias("rule"), x.alias("e")),
        )).otherwise(F.array()),
    )
    lined = rows.select(F.inline(of_line))
    # one join: ids that stand twice, are missing, or are not asked for
    stands = rows.where("has_tab").groupBy(F.col("s1_id").alias("entity_id")).agg(F.count(F.lit(1)).alias("k"))
    both = stands.join(required.withColumn("asked", F.lit(True)), "entity_id", "full")
    of_id = F.concat(flaw(F.col("k") > 1, "V-06", F.col("entity_id")), flaw(F.col("k").isNull(), "V-11", F.col("entity_id")), flaw(F.col("asked").isNull(), "V-12", F.col("entity_id")))
    offenders = heads.unionByName(lined).unionByName(both.select(F.inline(of_id)))
    if valid is not None:
        ids = rows.where("has_tab").select(F.explode("ids").alias("id")).where(known).select(F.col("id").alias("entity_id")).distinct()
        offenders = offenders.unionByName(ids.join(valid, "entity_id", "left_anti").select(F.lit("V-10").alias("rule"), F.col("entity_id").alias("e")))
    empty = lines.agg(F.count(F.lit(1)).alias("c")).where("c = 0")
    totals = rows.where("has_tab").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("ids") == 0).alias("none"))
    parts = F.array(F.concat(F.lit("empty "), F.col("none").cast("string")), F.concat(F.lit("non-empty "), (F.col("n") - F.col("none")).cast("string")))
    return reduce(DataFrame.unionByName, [
        finding(empty, "V-02", "error", F.lit("file is empty")),
        grouped(offenders),
        totals.select(F.lit("V-18").alias("rule"), F.lit("info").alias("level"), "n", parts.alias("examples")),
    ])


def subset_findings(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """V-16: rows whose matches are not all candidates; of repeated rows the last counts."""
    last = lambda df, c: df.where("has_tab").groupBy("s1_id").agg(F.max_by("ids", "line_no").alias(c))
    both = last(result_rows(matches), "m").join(last(result_rows(candidates), "c"), "s1_id", "left")
    return finding(both.where(F.size(F.array_except("m", F.coalesce("c", F.array().cast("array<string>")))) > 0), "V-16", "warning", F.col("s1_id"))


def encoding_findings(spark: SparkSession, path: str) -> DataFrame:
    """V-17: files that are not UTF-8, told by their lines (their bytes are read as they are)."""
    bad = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("f")).where(~F.call_function("is_valid_utf8", F.col("value")))
    return finding(bad.select("f").distinct(), "V-17", "error", F.col("f"))


def validate(spark: SparkSession, matching: str, candidates: str | None, test_dir: str, check_ids: bool = False, sources: list[str] | None = None) -> DataFrame:
    """All findings (rule, level, n, examples); no row of level error means that the files pass. ``sources`` has the paths of the three test
    sources where they do not stand in ``test_dir`` under their usual names."""
    source1, *targets = sources or [f"{test_dir}/test_source{k}.tsv" for k in (1, 2, 3)]
    if not path_exists(spark, source1):
        return note(spark, "V-13", "error", source1)
    required = read_ids(spark, source1)
    out, valid = [], None
    if not check_ids:
        out.append(note(spark, "V-14", "warning", "ids are not checked"))
    elif not all(path_exists(spark, t) for t in targets):
        out.append(note(spark, "V-14", "warning", "target files are missing"))
    else:
        valid = read_ids(spark, targets[0]).union(read_ids(spark, targets[1])).distinct()
    if not path_exists(spark, matching):
        return reduce(DataFrame.unionByName, [*out, note(spark, "V-01", "error", matching)])
    lines = read_lines(spark, matching)
    out += [encoding_findings(spark, matching), list_findings(lines, MATCH_HEADER, required, valid)]
    if candidates is None or not path_exists(spark, candidates):
        out.append(note(spark, "V-15", "warning", "no candidate file"))
    else:
        other = read_lines(spark, candidates)
        out += [encoding_findings(spark, candidates), list_findings(other, CANDIDATE_HEADER, required, valid), subset_findings(lines, other)]
    return reduce(DataFrame.unionByName, out)


def exit_code(findings: DataFrame) -> int:
    """0 without an error, else 1."""
    return int(findings.where("level = 'error'").limit(1).count() > 0)


def report(findings: DataFrame) -> str:
    """Errors, numbered, then warnings; at most one line for each rule."""
    rows = findings.where("level <> 'info'").orderBy("level", "rule").collect()
    errors = [r for r in rows if r["level"] == "error"]
    lines = [f"{i}. {r['rule']}: {r['n']} ({', '.join(r['examples'])})" for i, r in enumerate(errors, 1)]
    return "\n".join(lines + [f"{r['rule']}: {', '.join(r['examples'])}" for r in rows if r["level"] != "error"])


def write_report(findings: DataFrame, path: str) -> None:
    Path(path).write_text(report(findings))
