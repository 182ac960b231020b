"""Steps whose cost must not grow with the pairs that share a key."""

import random
import threading
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from matchloom import queries as Q
from matchloom.config import MatchConfig
from matchloom.functions import normalize as N
from matchloom.functions import similarity as S
from matchloom.operators import blocking as B
from matchloom.operators import matcher as MA
from matchloom.operators import passes as G
from matchloom.operators import tfidf as TF
from matchloom.operators import training as T
from matchloom.operators import trees as TR
from matchloom.sources import adapters as A


def rows(spark, prefix, n, seed):
    """Records over few words and numbers, so that a great many share keys; some repeat a number."""
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "to"]
    nums = lambda: r.choice([["10", "10"], ["10", "11"], ["11", "10"], ["12"], [], ["7", "11"]])
    cells = [(f"{prefix}-{k}", " ".join(r.choices(words, k=r.randint(1, 5))), r.choice("AB"), nums()) for k in range(n)]
    return spark.createDataFrame(cells, "entity_id string, norm_name string, norm_country string, addr_numbers array<string>")


def brute(asked, held):
    out = {}
    for a in asked:
        for b in held:
            if (a.country, a.kind, a.key) == (b.country, b.kind, b.key):
                pair = (a.entity_id, b.entity_id)
                out[pair] = out.get(pair, 0) + a.weight
    return out


def test_hits_and_best_hits(spark):
    asked, held = B.postings(rows(spark, "S1", 60, 1)), B.postings(rows(spark, "S2", 90, 2))
    want = brute(asked.collect(), held.collect())
    assert {(r.s1_id, r.cand_id): r.hits for r in B.hits(asked, held).collect()} == want
    got = {(r.s1_id, r.cand_id, r.hits) for r in B.best_hits(asked, held, MatchConfig(first_cut=5)).collect()}
    best = set()
    for s in {s for s, _ in want}:
        best |= {(s, c, n) for n, c in sorted(((n, c) for (x, c), n in want.items() if x == s), key=lambda x: (-x[0], x[1]))[:5]}
    assert got == best


def test_pairs_are_not_shuffled(spark):
    """No exchange carries the pairs that share a key, and no operator of the first cut makes them."""
    asked, held = B.postings(rows(spark, "S1", 400, 3)), B.postings(rows(spark, "S2", 400, 4))
    plan = B.hits(asked, held)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(s1_id" in plan and not any("cand_id" in x.split("]")[0] and "s1_id" in x.split("]")[0] for x in plan.split("hashpartitioning(")[1:])
    pairs = B.hits(asked, held).count()
    found = B.Blocker().fit(rows(spark, "S2", 400, 4).withColumn("norm_addr", F.lit(""))).pairs(rows(spark, "S1", 400, 3).withColumn("norm_addr", F.lit("")))
    assert found.count() <= 12 * 400 < pairs / 5
    # "hits" of pairs come from lists of at most 12 targets, one for each subset of keys
    assert "ids" in found._jdf.queryExecution().optimizedPlan().toString()


def test_native_lcs_of_long_texts(spark):
    """Several words of bits, letters beyond the first plane, and no more than a step a character."""
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcd \u00e9\U0001f600") for _ in range(n))
    cells = [(text(r.choice([0, 1, 59, 60, 61, 119, 121, 200])), text(r.choice([0, 1, 30, 60, 61, 180]))) for _ in range(200)] * 20
    df = spark.createDataFrame(cells, "a string, b string").repartition(8).cache()
    df.count()
    start = time.time()
    got = df.select("a", "b", S.lcs_column(F.col("a"), F.col("b")).alias("l")).collect()
    assert time.time() - start < 40
    assert [x.l for x in got] == S.lcs([x.a for x in got], [x.b for x in got]).tolist()


def test_phonetic_pass_makes_no_pairs_in_plans(spark, monkeypatch):
    """Blocks of few rows give what pairs give; no join of the plan makes pairs of an entity and a target."""
    s1, s23 = rows(spark, "S1", 60, 6), rows(spark, "S2", 90, 7)
    config = MatchConfig(first_cut=5)
    want = B.first_cut(B.hits(G.phonetic_postings(s1), G.phonetic_postings(s23)), config).collect()
    for name, size in (("ASKED_ROWS", 7), ("HELD_ROWS", 20), ("LEAST_ROWS", 1)):
        monkeypatch.setattr(B, name, size)
    got = G.phonetic_candidates(s1, s23, config)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert "CoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()


def test_cosines_in_blocks(spark, monkeypatch):
    """Blocks of few names give the same pairs, and pairs are made in tasks, not by a join."""
    s1, s23 = rows(spark, "S1", 60, 8), rows(spark, "S2", 60, 9)
    want = sorted(map(tuple, TF.similar_names(s1, s23).collect()))
    for name, size in (("ASKED_ROWS", 7), ("HELD_ROWS", 9), ("LEAST_ROWS", 1)):
        monkeypatch.setattr(TF, name, size)
    got = TF.similar_names(s1, s23)
    assert want and sorted(map(tuple, got.collect())) == want
    assert "CoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()


def test_matcher_compares_few_pairs_in_full():
    """Texts of few letters, so that counts of characters tell little: one pattern against all names and addresses does. Exact all the same."""
    r = random.Random(10)
    text = lambda k: " ".join("".join(r.choice("abcdeh") for _ in range(r.randint(2, 8))) for _ in range(k))
    cells = [(f"S2-{i}", f"{text(3)} {r.choice(['inc', 'corp', ''])}", f"{i % 40} {text(9)}", "US", [str(i % 40)], "") for i in range(3000)]
    table = lambda some: pa.table(list(zip(*some, strict=True)), ["id", "name", "addr", "country", "nums", "shown"])
    asked = [(f"S1-{k}", *cells[k][1:]) for k in range(8)] + [("S1-8", "ab " + "long " * 30, "", "US", [], ""), ("S1-9", "", "x é", "FR", [], "")]
    best = MA.Best(MA.Records(table(asked)), MA.MatcherRule(top=5), MatchConfig())
    for at in range(0, 3000, 1000):
        best.search(MA.Records(table(cells[at : at + 1000])))
    # 26108 before
    assert best.compared < 6000
    every, config = MA.Records(table(cells)), MatchConfig()
    for i in range(len(asked)):
        score = every.scores(np.arange(3000), best.asked, np.full(3000, i), every.fixed(best.asked, i), config)[0]
        assert [(x[1], -x[0]) for x in best.held[i]] == [(c, s) for s, c in sorted(zip((-score).tolist(), every.ids, strict=True))[:5] for s in [-s]]


def test_accepted_counts_make_no_pairs_of_settings(spark):
    """Every setting has a row; no exchange carries pairs times settings, and no distinct count expands them."""
    cells = [(f"S1-{i % 50}", f"S2-{i}", (i * 37 % 101) / 100) for i in range(400)]
    pairs = spark.createDataFrame(cells, "s1_id string, cand_id string, prob double")
    settings = [("a", 0.0), ("b", 0.5), ("c", 0.5), ("d", 0.99), ("e", 2.0)]
    got = T.accepted_counts(spark.createDataFrame(settings, "setting string, threshold double"), pairs)
    want = [(s, t, sum(p >= t for _, _, p in cells), len({x for x, _, p in cells if p >= t})) for s, t in settings]
    assert sorted(map(tuple, got.collect())) == want
    empty = T.accepted_counts(spark.createDataFrame(settings, "setting string, threshold double"), pairs.where("false"))
    assert sorted(map(tuple, empty.collect())) == [(s, t, 0, 0) for s, t in settings]


def test_thresholds_score_pairs_once(spark, monkeypatch, tmp_path):
    """The sweep and the settings read the same written scores."""
    from matchloom import queries as Q

    calls, scored = [], Q.scored
    monkeypatch.setattr(Q, "scored", lambda *a: (calls.append(1), scored(*a))[1])
    assert Q.m04_thresholds(spark, "/root/testdata/sf0.001").count() == 6 and len(calls) == 1


def test_trees_grow_in_one_stage(spark, monkeypatch):
    """No job for each pass: all trees of all models come out of one barrier stage, the same as by jobs, in however many tasks."""
    r = random.Random(11)
    cells = [(f"S1-{i // 3}", r.random(), round(r.random(), 1), None if i % 17 == 0 else r.random(), int(r.random() < 0.4)) for i in range(700)]
    df = spark.createDataFrame(cells, "s1_id string, a double, b double, c double, label int").withColumn("label", F.when(F.col("a") + F.col("b") > 1.1, 1).otherwise(F.col("label"))).cache()
    rule, got = TR.TreeRule(trees=6, depth=4, least_rows=5, restage=4), []
    for few, size in ((0, 100_000), (8, 100_000), (8, 300)):
        monkeypatch.setattr(TR, "FEW_TASKS", few)
        monkeypatch.setattr(TR, "TASK_ROWS", size)
        spark.sparkContext.setJobGroup(f"grow-{few}-{size}", "")
        got.append([sorted(map(tuple, x.table(spark).collect())) for x in TR.fit_trees(df, rule, ["a", "b", "c"], folds=2, id_col="s1_id")])
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"grow-{few}-{size}"))
        assert jobs < 20 or not few
    assert got[0] == got[1] == got[2] and len(got[0][0]) > 50


def test_records_clean_the_head_of_a_text(spark):
    """The first words of a text are those of the whole cleaned text, wherever its head ends; long texts are not cleaned whole for them."""
    r = random.Random(12)
    bits = ["a", "b", "e\u0301", "\u00e9", "\ufb01", "\u0130", "\u03a3", "&", " ", ".", "\n", "\U0001f600", "\u0301", "7", "\uac00", "\u00bd"]
    texts = [None, "", " ", "-" * 2000 + "late word", "x" * 511 + "yz and more", "x" * 2000 + " y", "ab " * 14, "ab " * 15, ("ab " * 14 + "." * 480) + "c d e"]
    texts += ["".join(r.choices(bits, k=r.choice([20, 500, 512, 513, 700, 3000]))) for _ in range(300)]
    texts += ["".join(r.choices(bits[:5], k=n)) + " " + "".join(r.choices(bits, k=40)) for n in range(440, 530)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {x.id: x._words for x in A.first_words(df).collect()}
    want = N.with_clean(df, {"c": "text"}).select("id", F.slice(F.split("c", " "), 1, 14).alias("w")).collect()
    assert got == {x.id: x.w for x in want}
    long = spark.range(1500).select(F.repeat(F.concat(F.lit("\u00c9t\u00e9 "), F.col("id").cast("string"), F.lit(". ")), 20_000).alias("text")).repartition(4)
    start = time.time()
    assert A.first_words(long).agg(F.sum(F.size("_words"))).first()[0] == 1500 * 14
    # 24.8 s before
    assert time.time() - start < 12


def test_blocks_travel_few_times(spark):
    """Both sides of a country are cut, so a row meets about the root of the tasks in blocks, not all of them."""
    side = lambda n, m: spark.range(n).select(F.lit("A").alias("country")).unionAll(spark.range(m).select(F.lit("B").alias("country")))
    grid = lambda k, **most: {x.country: (x.asked_parts, x.held_parts) for x in B.block_grid(side(20_000, 30), side(40_000, 10), k, *{"asked": 20_000, "held": 100_000, "least": 500, **most}.values()).collect()}
    # 40 asked blocks before, each with a copy of all that is held
    assert grid(40) == {"A": (7, 6), "B": (1, 1)}
    (a, b), small = grid(400)["A"], grid(1)
    assert a * b >= 400 and max(a, b) <= 25 and small == {"A": (1, 1), "B": (1, 1)}
    assert grid(1, asked=3000, held=7000)["A"] == (7, 6)


def test_best_cosines_of_blocks(spark, monkeypatch):
    """A block hands on an asked name's best alone; what it leaves out cannot be among the best of all."""
    s1, s23 = rows(spark, "S1", 300, 13), rows(spark, "S2", 400, 14)
    rule = TF.CosineRule(least=0.2, top=3)
    every, some = (TF.similar_names(s1, s23, rule, best).count() for best in (False, True))
    assert some < every / 3
    want = sorted(map(tuple, TF.cosine_candidates(s1, s23, rule).collect()))
    for name, size in (("ASKED_ROWS", 30), ("HELD_ROWS", 40), ("LEAST_ROWS", 1)):
        monkeypatch.setattr(TF, name, size)
    assert want and sorted(map(tuple, TF.cosine_candidates(s1, s23, rule).collect())) == want
    assert sorted(map(tuple, TF.similar_names(s1, s23, rule).where("cosine >= 0.6").collect())) == sorted(map(tuple, TF.similar_names(s1, s23, TF.CosineRule(least=0.6)).collect()))


def test_passes_are_written_once(spark):
    """The union reads four tables; the passes' own plans are no part of its plan."""
    from matchloom import queries as Q

    for df in Q._passes(spark, "/root/testdata/sf0.001").values():
        assert df.columns == ["s1_id", "cand_id", "score"]
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_passes_run_side_by_side(spark, monkeypatch):
    """No pass of the union waits for another one's end; with one after the other the barrier breaks."""
    meet = threading.Barrier(4, timeout=60)

    def together(f):
        def run(*args, **more):
            meet.wait()
            return f(*args, **more)

        return run

    for where, name in ((B.Blocker, "candidates"), (TF, "cosine_candidates"), (G, "sorted_neighbourhood"), (G, "phonetic_candidates")):
        monkeypatch.setattr(where, name, together(getattr(where, name)))
    found = Q._passes(spark, "/root/testdata/sf0.001")
    assert sorted(found) == ["cosine", "keys", "phonetic", "sorted"] and all(df.columns == ["s1_id", "cand_id", "score"] and df.count() for df in found.values())


def test_trees_are_asked_in_batches(spark):
    """Trees of any shape, up to 64 leaves by bits and beyond level by level, give each row its leaf; 300 of them, many rows in little time."""
    rng = np.random.default_rng(15)

    def grown(leaves: int) -> TR.Tree:
        cells, open_ = {0: None}, [0]
        while len(open_) < leaves:
            k = open_.pop(int(rng.integers(len(open_))))
            cells[k] = (int(rng.integers(4)), float(rng.normal()), len(cells), len(cells) + 1)
            open_ += [len(cells), len(cells) + 1]
            cells |= {len(cells): None, len(cells) + 1: None}
        of = lambda i, none: np.array([cells[k][i] if cells[k] else none for k in range(len(cells))])
        return TR.Tree(of(0, -1), of(0, 0), of(1, 0.0), of(2, -1), of(3, -1), np.where(of(0, -1) < 0, rng.normal(size=len(cells)), 0.0))

    def leaf(tree: TR.Tree, x: list, depth: int) -> float:
        k = 0
        for _ in range(depth):
            if tree.feature[k] >= 0:
                v = x[tree.feature[k]]
                k = int((tree.left if v is not None and v <= tree.threshold[k] else tree.right)[k])
        return tree.value[k]

    trees = [grown(n) for n in (1, 2, 3, 7, 31, 32, 33, 64, 65, 90)]
    rows = [[None if rng.random() < 0.1 else float(v) for v in rng.normal(size=4)] + [k] for k in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k int").repartition(3)
    for depth in (3, 100):
        # the second ensemble has the trees in reverse
        margin = TR.tree_margin(spark, [(0.5, trees), (0.25, trees[::-1])], ["a", "b", "c", "d"], depth, F.col("k") % 2)
        got = dict(df.select("k", margin).collect())
        for *x, k in rows:
            want = 0.25 if k % 2 else 0.5
            for tree in trees[::-1] if k % 2 else trees:
                want += leaf(tree, x, depth)
            assert got[k] == want
    many = spark.range(120_000).select(*(F.rand(k).alias(c) for k, c in enumerate("abcd"))).repartition(8)
    nodes = TR.Ensemble(0.0, [grown(31) for _ in range(300)], list("abcd")).table(spark)
    start = time.time()
    assert TR.score_by_trees(many, nodes, list("abcd"), TR.TreeRule(depth=31)).agg(F.count("prob")).first()[0] == 120_000
    # in the JVM 26,539 rows took 110 task seconds, with their features
    assert time.time() - start < 20


def test_pairs_are_dealt_before_their_features(spark):
    """A few megabytes of pairs are not left to one task: each pair costs far more than its bytes."""
    from matchloom.operators.features import spread

    pairs = spark.range(1000).select(F.concat(F.lit("S1-"), F.col("id").cast("string")).alias("s1_id"), F.lit("S2-1").alias("cand_id")).coalesce(1)
    assert len({k for k, n in spread(pairs).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect() if n}) >= spark.sparkContext.defaultParallelism // 2


def test_windows_are_compared_at_once():
    """Every window of the longer string gets its longest common subsequence from one pass over both: the scores of each window by itself, padded
    among pairs of other lengths, in little time."""
    r = random.Random(16)
    pairs = []
    for letters in ("ab", "abcdefg hi", "aé\U0001f600 b"):
        for _ in range(60):
            x, y = ("".join(r.choices(letters, k=r.choice([0, 1, 2, 5, 9, 20, 63, 66]))) for _ in range(2))
            pairs.append((x, y if r.random() < 0.6 else "q" + x[: len(y)] + "r"))

    def one(a: str, b: str) -> float:
        if not a:
            return float(not b)
        windows = [b[max(0, e - len(a)) : e] for e in range(1, len(a) + len(b))]
        return max(S.ratio([a] * len(windows), windows).tolist())

    for (a, b), got in zip(pairs, S.partial_ratio(*map(list, zip(*pairs, strict=True))).tolist(), strict=True):
        short, long = sorted((a, b), key=len)
        assert got == (max(one(a, b), one(b, a)) if len(a) == len(b) else one(short, long))
    names = ["".join(r.choices("etaoin shrdlu", k=r.randint(55, 80))) for _ in range(20_000)]
    start = time.process_time()
    S.partial_ratio(names[:10_000], names[10_000:])
    # 4 to 8 s before
    assert time.process_time() - start < 2.5


def test_the_smaller_sibling_is_counted():
    """Of two siblings the one with fewer rows is summed up; the other is what is left of their parent."""
    rng = np.random.default_rng(17)
    bins = rng.integers(0, 16, (2000, 3)).astype(np.int16)
    y = ((bins[:, 0] > 12) ^ (bins[:, 1] > 13) ^ (rng.random(2000) < 0.1)).astype(float)
    lists = pa.ListArray.from_arrays(np.arange(2001, dtype=np.int32) * 3, pa.array(bins.ravel()))
    rule, edges = TR.TreeRule(trees=1, bins=16, depth=5, columns=1.0), np.tile(np.arange(15.0), (3, 1))
    batch = pa.RecordBatch.from_arrays([lists, pa.array(y), pa.array(np.ones(2000)), pa.array(np.full(2000, -1, np.int32))], ["bins", "y", "w", "fold"])
    held, level, asked = TR._Held([batch], [0.0], 3, rule), 0, []

    def count(found, wanted):
        nonlocal level
        if level:
            held.descend(found, level - 1)
        level += 1
        rows = np.bincount(held.at[0], minlength=128)
        asked.extend((rows[k], rows[k ^ 1]) for k in wanted[0] if k > 1)
        full = np.moveaxis(held.histograms(wanted, [np.arange(3)])[0].reshape(3, len(wanted[0]), 3, 16), 0, -1) / np.array([TR.PARTS, TR.PARTS, 1.0])
        return [dict(zip(wanted[0], full, strict=True))]

    (tree,), _ = TR._grown(0, 1, 3, edges, rule, count)
    assert len(tree.feature) > 10 and len(asked) > 5 and all(own <= other for own, other in asked)
    assert np.array_equal(np.bincount(TR.leaf_of(tree, bins, 5), minlength=len(tree.feature)) > 0, tree.feature < 0)
