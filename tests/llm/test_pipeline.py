"""Each stage of the pipeline against a brute-force version, on its own input."""

import re

import corpus_pipeline as P
from matchloom.llm import toxicity

from ..oracle import DATA
from .test_brute import brute_components, brute_hits, brute_pii, water


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None), (None, "x y z", "en", None, 5)], docs.schema)).withColumn("key", docs["lang"])
    labels = P.training_labels(spark, DATA)
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    kept = P.drop_toxic(spark, docs, DATA)
    assert sorted(map(str, rows_unsorted(kept))) == sorted(str(tuple(r)[:5]) for r in docs.collect() if score[r["doc_id"]] < P.TOXIC)
    assert kept.columns == P.COLUMNS

    kept = kept.union(spark.createDataFrame([(None, "same words of no id at all", "en", None, 5)] * 2 + [(None, None, "en", None, 0)] * 2, kept.schema))
    once = P.one_of_each_group(spark, kept, DATA)
    given = [tuple(r) for r in kept.collect()]
    known = list(dict.fromkeys(r for r in given if r[0] is not None))
    component = {r[0]: r[2] for r in brute_components([(r[0], r[1], None) for r in known], 5, 80, 100)}
    want = [r for r in known if component[r[0]] == r[0]] + [r for r in given if r[0] is None]
    want.remove((None, "same words of no id at all", "en", None, 5))
    assert sorted(map(str, rows_unsorted(once))) == sorted(map(str, want))

    clean = P.drop_contaminated(spark, once, DATA)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    own = rows_unsorted(once)
    hit = [h[2] for h in brute_hits_in_order(own, items)]
    assert sorted(map(str, rows_unsorted(clean))) == sorted(str(r) for r, h in zip(own, hit, strict=True) if not h)

    masked = P.mask_personal_data(spark, clean, DATA)
    texts = {r[1] for r in rows_unsorted(masked)}
    assert all(not brute_pii(t) for t in texts)
    assert len(rows_unsorted(masked)) == len(rows_unsorted(clean))
    assert all(r[4] == len(r[1]) for r in rows_unsorted(masked) if r[1] is not None)

    mixed = P.mix(spark, masked, DATA).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for r in rows_unsorted(masked):
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    whole = {r[0]: r for r in rows_unsorted(masked)}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["taken"] == size(r["text"]) <= r["size"] and 1 <= r["copy"] <= 3
        if r["taken"] == r["size"] and r["doc_id"] is not None:
            assert tuple(r)[:5] == whole[r["doc_id"]]
        elif r["doc_id"] is not None:
            assert r["text"].split() == whole[r["doc_id"]][1].split()[: r["taken"]]
    want = water(sizes)
    assert all(abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) for r in mixed)
    for s in sizes:
        assert abs(taken.get(s, 0) - want[s]) <= 0.05 * want[s] + 1
    assert len({(r["doc_id"], r["text"]) for r in mixed}) < len(mixed)


def test_one_document_of_a_group_stays(spark):
    """Different texts under one id, and groups of null ids alone, leave one row too."""
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join([*base[:k], "edited", *base[k:]]) for k in range(8)]
    rows = [(7, t, "en", "s", 1) for t in texts[:4]] + [(9, texts[4], "en", "s", 1)]
    rows += [(None, t.replace("w", "v"), "en", "s", 1) for t in texts] + [(3, "other words stand alone in here", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, root long")
    got = P.one_of_each_group(spark, docs, DATA).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "7", "None"]
    assert all((r["doc_id"], r["text"]) in {(x[0], x[1]) for x in rows} for r in got)


def test_stages_of_nothing(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{DATA}/{name}.parquet")
        (df.limit(0) if name != "documents" else df.limit(5)).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in P.STAGES:
        assert f(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert P.drop_toxic(spark, docs, str(tmp_path)).count() == 5 and P.drop_contaminated(spark, docs, str(tmp_path)).count() == 5


def rows_unsorted(df):
    return [tuple(r) for r in df.select(*P.COLUMNS).collect()]


def brute_hits_in_order(own, items):
    out = []
    for r in own:
        out += brute_hits([(r[0], r[1], None)], items, 10)
    return out


def test_run(spark):
    assert P.run(spark, DATA).count() > 0
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii", "mixing"]
