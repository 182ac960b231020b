"""python -m matchloom infer|train|validate|profile: the matching plan over TSV files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import FEATURES
from .operators.records import normalize_records
from .operators.trees import write_trees
from .operators.validation import exit_code, report, validate, write_report
from .plans.matching import profile, run_inference, train
from .sources.tsv import GROUND_TRUTH_SCHEMA, last_by_key, read_tsv, with_ordinal, write_config


def with_sources(step: argparse.ArgumentParser, folder: str) -> None:
    step.add_argument(f"--{folder}-dir", help=f"folder of {folder}_source1.tsv to {folder}_source3.tsv")
    for k in (1, 2, 3):
        step.add_argument(f"--source{k}", help=f"path of source {k}, if it is not in the folder")


def paths_of(given: argparse.Namespace, folder: str) -> list[str]:
    """The three sources: their own paths, else those in the folder."""
    at = getattr(given, f"{folder}_dir")
    out = [getattr(given, f"source{k}") or (f"{at}/{folder}_source{k}.tsv" if at else None) for k in (1, 2, 3)]
    if None in out:
        raise SystemExit(f"name the folder with --{folder}-dir, or each source")
    return out


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="matchloom", description=__doc__)
    steps = out.add_subparsers(dest="step", required=True)
    infer = steps.add_parser("infer", help="match the test sources, write and validate both result files")
    with_sources(infer, "test")
    infer.add_argument("--out-dir", required=True)
    infer.add_argument("--model")
    infer.add_argument("--config")
    infer.add_argument("--threshold", type=float)
    infer.add_argument("--check-ids", action="store_true", help="also look up every matched id")
    infer.add_argument("--one-file", action="store_true", help="each result as one ordered file instead of a folder")
    infer.add_argument("--report", help="also write the validator's report to this file")
    fit = steps.add_parser("train", help="fit a model and choose the threshold")
    with_sources(fit, "train")
    fit.add_argument("--truth", help="path of the ground truth, if it is not train_ground_truth.tsv in the folder")
    fit.add_argument("--model", required=True)
    fit.add_argument("--config", required=True)
    fit.add_argument("--trees", type=int, default=300)
    fit.add_argument("--learner", choices=["pipeline", "leafwise"], default="leafwise")
    fit.add_argument("--sample-limit", type=int, default=-1, help="first S1 records to learn from; -1: all")
    check = steps.add_parser("validate", help="check result files; the exit code is 1 if there is an error")
    with_sources(check, "test")
    check.add_argument("--matching", required=True)
    check.add_argument("--candidates")
    check.add_argument("--check-ids", action="store_true", help="also look up every matched id")
    check.add_argument("--report", help="also write the report to this file")
    look = steps.add_parser("profile", help="print counts of the training records")
    with_sources(look, "train")
    look.add_argument("--truth", help="path of the ground truth, if it is not train_ground_truth.tsv in the folder")
    return out


def told(findings, path: str | None) -> int:
    """Print the report, write it if a path is given, and return the exit code."""
    findings = findings.persist()
    print(report(findings))
    if path:
        write_report(findings, path)
    code = exit_code(findings)
    findings.unpersist()
    return code


def main(argv: list[str] | None = None) -> int:
    given = parser().parse_args(argv)
    spark = SparkSession.builder.appName("matchloom").getOrCreate()
    if given.step == "infer":
        sources = paths_of(given, "test")
        summary, findings = run_inference(spark, given.test_dir, given.out_dir, given.model, given.config, given.threshold, sources, given.check_ids, given.one_file)
        print(summary.first().asDict())
        return told(findings, given.report)
    if given.step == "validate":
        return told(validate(spark, given.matching, given.candidates, given.test_dir, given.check_ids, paths_of(given, "test")), given.report)
    raw = [read_tsv(spark, path) for path in paths_of(given, "train")]
    truth = read_tsv(spark, given.truth or f"{given.train_dir}/train_ground_truth.tsv", GROUND_TRUTH_SCHEMA)
    if given.step == "profile":
        for name, table in profile(*raw, truth).items():
            print(name)
            for row in table.collect():
                print("  " + ", ".join(f"{k} {v}" for k, v in row.asDict().items()))
        return 0
    s1, s2, s3 = (normalize_records(last_by_key(with_ordinal(df))) for df in raw)
    trained = train(s1, s2, s3, truth, trees=given.trees, sample_limit=given.sample_limit, learner=given.learner)
    if given.learner == "leafwise":
        write_trees(trained.model, spark, given.model)
    else:
        trained.model.write().overwrite().save(given.model)
    write_config(given.config, trained.threshold, FEATURES, trained.metrics)
    print({"threshold": trained.threshold, **trained.metrics})
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
