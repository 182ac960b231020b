"""The command line over files: training, matching, validation, profiling."""

import random

import pytest

from matchloom.__main__ import main
from matchloom.sources.tsv import merge_parts

WORDS = ["acme", "orion", "delta", "zenith", "nova", "harbor", "summit", "vertex", "atlas", "lumen", "quartz", "cobalt"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """60 entities with a match in source 2 each, as files of both kinds of names."""
    at, rng = tmp_path_factory.mktemp("files"), random.Random(4)
    rows = {1: [], 2: [], 3: []}
    for i in range(60):
        name = " ".join(rng.sample(WORDS, 3))
        rows[1].append((f"S1-{i}", f"{name} corp", f"{i + 10} main st", "US" if i % 4 else "FR"))
        rows[2].append((f"S2-{i}", f"{name} corporation", f"{i + 10} main street", "US" if i % 4 else "FR"))
        rows[3].append((f"S3-{i}", " ".join(rng.sample(WORDS, 3)), f"{rng.randint(10, 99)} oak ave", "US"))
    for kind in ("train", "test"):
        for k, some in rows.items():
            lines = ["entity_id\tbusiness_name\tbusiness_address\tcountry", *("\t".join(r) for r in some)]
            (at / f"{kind}_source{k}.tsv").write_text("\n".join(lines) + "\n")
    truth = [f"S1-{i}\tS2-{i}{',S3-0' if i == 7 else ''}" for i in range(60)]
    (at / "train_ground_truth.tsv").write_text("\n".join(["source1_entity_id\tmatched_entity_ids", *truth]) + "\n")
    return at


@pytest.mark.parametrize("learner", ["leafwise", "pipeline"])
def test_train_then_infer_with_the_stored_model(spark, folder, tmp_path, capsys, learner):
    model, config = str(tmp_path / "model"), str(tmp_path / "config.json")
    assert main(["train", "--train-dir", str(folder), "--model", model, "--config", config, "--trees", "5", "--learner", learner]) == 0
    assert "val_macro_f05" in capsys.readouterr().out
    out = tmp_path / "out"
    assert main(["infer", "--test-dir", str(folder), "--out-dir", str(out), "--model", model, "--config", config, "--check-ids", "--one-file"]) == 0
    for name in ("matching_results", "candidate_pairs"):
        lines = (out / f"{name}.tsv").read_text().splitlines()
        assert lines[0].startswith("source1_entity_id\t") and [x.split("\t")[0] for x in lines[1:]] == [f"S1-{i}" for i in range(60)]
        assert not (out / f"{name}.tsv.parts").exists() and not (out / f"{name}.tsv.merging").exists()
    matched = dict(x.split("\t") for x in (out / "matching_results.tsv").read_text().splitlines()[1:])
    assert sum(f"S2-{i}" in matched[f"S1-{i}"].split(",") for i in range(60)) > 50


def test_sources_have_paths_of_their_own(spark, folder, tmp_path):
    given = [x for k in (1, 2, 3) for x in (f"--source{k}", str(folder / f"test_source{k}.tsv"))]
    assert main(["infer", *given, "--out-dir", str(tmp_path / "out")]) == 0
    with pytest.raises(SystemExit):
        main(["infer", *given[:4], "--out-dir", str(tmp_path / "out")])


def test_validate_has_an_exit_code(spark, folder, tmp_path, capsys):
    header = "source1_entity_id\tmatched_entity_ids\n"
    body = "".join(f"S1-{i}\tS2-{i}\n" for i in range(60))
    good, bad = tmp_path / "good.tsv", tmp_path / "bad.tsv"
    good.write_text(header + body)
    bad.write_text(header + body.replace("S2-5\n", "S2-999\n"))
    at = ["--test-dir", str(folder)]
    assert main(["validate", "--matching", str(good), *at, "--check-ids"]) == 0
    assert main(["validate", "--matching", str(bad), *at]) == 0  # ids are not looked up
    assert main(["validate", "--matching", str(bad), *at, "--check-ids", "--report", str(tmp_path / "report.txt")]) == 1
    assert "V-10" in capsys.readouterr().out and "S2-999" in (tmp_path / "report.txt").read_text()
    assert main(["validate", "--matching", str(tmp_path / "none.tsv"), *at]) == 1


def test_profile_prints_counts(spark, folder, capsys):
    assert main(["profile", "--train-dir", str(folder)]) == 0
    out = capsys.readouterr().out
    assert "country US, n 45" in out and "n_matches 2, n 1" in out and "s2 60, s3 1, total 61" in out and "found_in S3" in out


def test_parts_are_merged_in_order(spark, tmp_path):
    spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").selectExpr("cast(id as string)").write.text(str(tmp_path / "parts"))
    (tmp_path / "one").write_text("old")
    merge_parts(spark, str(tmp_path / "parts"), str(tmp_path / "one"))
    assert (tmp_path / "one").read_text().split() == [str(i) for i in range(1000)]
