"""Quality, resampling and search against brute-force versions, with nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import quality, resample, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, id long, n long, q int, rank int, weight long, score double, bucket int"


def table(spark, rows):
    """documents with extra columns whose names the operators use themselves"""
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 0.5, 6) for i, t in rows], SCHEMA)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def terms(text):
    return TERM.findall(ascii_lower(text or ""))


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéÉß0") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    text = lambda k: " ".join(rng.choices(vocabulary, weights, k=k))
    rows = [(i, text(rng.choice([0, 1, 5, 19, 20, 21, 60, 200]))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \t.,\n"), (n + 3, "A-b " * 9000), (n + 4, text(30000)), (n + 5, "ÀÉ ıK x")]
    rows += [(n + 10 + i, rows[7][1]) for i in range(80)]
    return rows + [rows[5], rows[7]], [(j, text(rng.randint(1, 12))) for j in range(15)] + [(100, None), (101, ""), (102, "zzzzz"), (103, "zzzzz É"), (0, text(3))]


# --- quality -----------------------------------------------------------------------------------------------------------


def slow_vectors(texts, rule):
    """bucket -> value of each text, by a scan of characters"""
    out = []
    for text in texts:
        found = re.findall(r"\n+|[0-9A-Za-z\x80-\U0010ffff]+|[^\x00-\x20\x7f0-9A-Za-z\x80-\U0010ffff]+", text or "")
        names = [[ascii_lower(t) for t in found], []]
        for t in found:
            b = t.encode()
            if not re.match(r"[0-9A-Za-z\x80-\U0010ffff]", t):
                names[1].append(("mark", t))
                continue
            up, digits = sum(65 <= x <= 90 for x in b), sum(48 <= x <= 57 for x in b)
            case = 0 if not up else 1 if up == 1 and 65 <= b[0] <= 90 else 2 if 2 * up > len(b) else 3
            names[1].append((case, 0 if not digits else 1 if digits == len(b) else 2, min(3, len(b) // 4)))
        count = Counter()
        for family, (tokens, longest) in enumerate(((names[0], rule.words), (names[1], rule.shapes))):
            for k in range(1, longest + 1):
                count.update((family, *tokens[i : i + k]) for i in range(len(tokens) - k + 1))
        norm = math.sqrt(sum(c * c for c in count.values()))
        out.append(sorted(c / norm for c in count.values()))
    return out


def test_vectors_hold_all_runs():
    rule = quality.Fit(bits=40)
    texts = ["", None, "a", "The THE the 12 a1b2 --- --- x\n\ny", "ß É é, É", "one two three four five " * 50, "\n", "!!!"]
    row, _, value = quality.vectors(pa.array(texts, pa.string()), rule)
    for i, expected in enumerate(slow_vectors(texts, rule)):
        assert np.allclose(sorted(value[row == i]), expected)


def test_vectors_do_not_depend_on_neighbours():
    rule = quality.Fit()
    texts = ["b c", "", None, "a b\nc", "x" * 5000, "a b\nc"]
    all_rows = quality.vectors(pa.array(["zz", *texts], pa.string()).slice(1), rule)
    for i, t in enumerate(texts):
        _, bucket, value = quality.vectors(pa.array([t], pa.string()), rule)
        assert (bucket == all_rows[1][all_rows[0] == i]).all() and np.allclose(value, all_rows[2][all_rows[0] == i])


def test_learning_equals_plain_updates(spark):
    """Rounds of shards against the same updates over dictionaries, one number at a time."""
    rule = quality.Fit(bits=6, rounds=3, words=1, shapes=1)
    rng = random.Random(3)
    shards = []
    for _ in range(3):
        rows = [(rng.randint(0, 1), {b: rng.random() for b in rng.sample(range(64), 5)}) for _ in range(7)]
        shards.append(rows)
    cells = [([y for y, _ in s], np.cumsum([len(x) for _, x in s]).tolist(), [b for _, x in s for b in sorted(x)], [float(np.float32(x[b])) for _, x in s for b in sorted(x)]) for s in shards]
    z, n = quality.learn(spark.createDataFrame(cells, "y array<int>, ends array<int>, bucket array<int>, value array<float>"), rule)
    state = {b: (0.0, 0.0) for b in range(65)}

    def weight(zb, nb):
        return 0.0 if abs(zb) <= rule.l1 else -math.copysign(abs(zb) - rule.l1, zb) / ((rule.beta + math.sqrt(nb)) / rule.alpha + rule.l2)

    for _ in range(rule.rounds):
        steps = defaultdict(list)
        for rows in shards:
            own = dict(state)
            for y, x in rows:
                x = {b: float(np.float32(v)) for b, v in x.items()} | {64: 1.0}
                p = 1 / (1 + math.exp(-sum(weight(*own[b]) * v for b, v in x.items())))
                for b, v in x.items():
                    g, (zb, nb) = (p - y) * v, own[b]
                    own[b] = (zb + g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / rule.alpha * weight(zb, nb), nb + g * g)
            for b in own:
                if own[b][1] != state[b][1]:
                    steps[b].append((own[b][0] - state[b][0], own[b][1] - state[b][1]))
        state = {b: (zb + sum(s[0] for s in steps[b]) / max(1, len(steps[b])), nb + sum(s[1] for s in steps[b]) / max(1, len(steps[b]))) for b, (zb, nb) in state.items()}
    assert np.allclose(z, [state[b][0] for b in range(65)], atol=1e-6) and np.allclose(n, [state[b][1] for b in range(65)], atol=1e-6)


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    good = lambda: " ".join(rng.choice(["der", "the", "and", "haus", "of", "word" + str(rng.randint(0, 300))]) for _ in range(rng.randint(5, 80)))
    junk = [lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", " | "), lambda t: t.replace(" ", "### ")]
    rows = [(i, good() if i % 3 else junk[i % 9 // 3](good())) for i in range(n)]
    return rows, [(i, int(i % 3 > 0)) for i in range(n)]


def test_quality_tells_held_out_texts(spark):
    rows, labels = labelled()
    known = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, quality int")
    extra = [(900, None), (901, ""), (902, "the and of " * 40000), (3, rows[3][1])]
    first = {tuple(r) for r in quality.score_quality(table(spark, rows + extra), known).collect()}
    assert first == {tuple(r) for r in quality.score_quality(table(spark, rows + extra).repartition(7), known).collect()}  # reruns agree
    scores = dict(first)
    assert len(scores) == len(rows) + 3 and all(0 <= s <= 1 for s in scores.values())
    assert sum((scores[i] >= 0.5) == bool(y) for i, y in labels if i % 4 == 0) >= 98
    assert scores[900] == scores[901]


def test_quality_without_labels_or_rows(spark):
    rows, labels = labelled(20)
    none = spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_quality(table(spark, rows), none).collect()} == {0.5}
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    assert quality.score_quality(table(spark, []), known).count() == 0
    out = quality.score_quality(table(spark, rows), known, carry=["text", "score"])
    assert out.columns[:2] == ["doc_id", "score"] and dict(out.select("doc_id", "text").collect()) == dict(rows)


# --- resampling --------------------------------------------------------------------------------------------------------


def slow_resample(rows, target, rule):
    def buckets(text):
        w = [x.encode() for x in terms(text)]
        return [zlib.crc32(b" ".join(w[i : i + k])) % rule.buckets for i in range(len(w)) for k in range(1, rule.longest + 1) if i + k <= len(w)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for _, text in target:
        t.update(buckets(text))
    ss, tt = sum(s.values()) + rule.buckets, sum(t.values()) + rule.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * ss / ((s[b] + 1) * tt))) for b in range(rule.buckets)}
    out = []
    for i, text in rows:
        b = buckets(text)
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"{rule.seed}:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(text))])
    can = sorted((x for x in out if x[4] >= rule.least), key=lambda x: (-x[3], x[0]))
    k = len(can) * rule.percent // 100
    return sorted([(*x[:4], r + 1 if r < k else 0) for r, x in enumerate(can)] + [(*x[:4], 0) for x in out if x[4] < rule.least])


@pytest.mark.parametrize("rule", [resample.Draw(), resample.Draw(longest=3, buckets=50, percent=35, least=5), resample.Draw(longest=2, seed="x", percent=100, least=0)])
def test_resample_equals_brute_force(spark, rule):
    rows, target = corpus()
    found = resample.importance_resample(table(spark, rows), table(spark, target), rule)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((*r[:4], r[4] or 0) for r in found.collect()) == slow_resample(rows, target, rule)


def test_features_of_long_texts_cross_chunks(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abÉ") for _ in range(rng.randint(1, 9))) for _ in range(3000)) + "." + "x" * 500
    rule = resample.Draw(longest=3)
    whole = [b for _, x in resample.features(text.encode(), rule) for b in x]
    monkeypatch.setattr(resample, "CHUNK", 64)
    cut = list(resample.features(text.encode(), rule))
    assert [b for _, x in cut for b in x] == whole and sum(n for n, _ in cut) == 3001 and len(cut) > 50


def test_resample_of_empty_tables(spark):
    rows, target = corpus()
    assert resample.importance_resample(table(spark, []), table(spark, target)).count() == 0
    found = resample.importance_resample(table(spark, rows), table(spark, []), carry=["text", "rank", "bucket"])
    assert found.count() == len(rows) and found.columns[5:] == ["text", "rank", "bucket"]
    named = spark.createDataFrame([("b", "a " * 30), ("a", "a " * 30), (None, "a " * 30)], "doc_id string, text string")
    out = {r["doc_id"]: r["rank"] for r in resample.importance_resample(named, table(spark, target), resample.Draw(percent=100)).collect()}
    assert sorted(out.values()) == [1, 2, 3] and set(out) == {"a", "b", None}


@pytest.mark.parametrize("partitions", [1, 17])
def test_ranks_do_not_depend_on_partitions(spark, partitions):
    rows = spark.range(500).select((F.col("id") % 7).alias("score"), F.col("id"))
    found = resample.ranked(rows.repartition(5), [F.desc("score"), F.asc("id")], "rank", partitions)
    expected = sorted(((i % 7, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert [tuple(r) for r in found.orderBy("rank").select("score", "id", "rank").collect()] == [(*x, k + 1) for k, x in enumerate(expected)]


# --- search ------------------------------------------------------------------------------------------------------------


def slow_search(rows, items, rule):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    count, words = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, tf, n in docs:
            m = 100 - rule.share + (rule.share * n * count) // words
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + rule.damp * m)) for t in set(terms(text)) if t in tf)
            if score > 0:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[: rule.top])]
    return sorted(out)


@pytest.mark.parametrize("rule", [search.Rule(), search.Rule(top=3, first=50, most=200), search.Rule(top=7, block=8, first=1), search.Rule(top=100, share=0, damp=5)])
def test_search_equals_brute_force(spark, rule):
    rows, items = corpus(4)
    found = search.search(table(spark, rows).repartition(4), table(spark, items).withColumnRenamed("doc_id", "item_id"), rule)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == slow_search(rows, items, rule)


def test_shards_probe_only_what_can_qualify():
    """A common term that no document needs is not essential, and documents that hold it alone are not candidates."""
    rule, stats = search.Rule(top=1), search.Statistics(1000, 100_000, np.array([5, 9000], np.int64))
    n = np.full(1000, 100)
    row, term = np.append(np.arange(1000), 500), np.append(np.zeros(1000, np.int64), 1)
    shard = search.Shard(n, row, term, np.ones(1001, np.int64), stats, rule)
    least = int(shard.gives.max())
    rows, score = shard.best(np.array([0, 1]), least)
    assert rows.tolist() == [500] and score[0] > least and not shard.sum.any()
    assert len(shard.best(np.array([0, 1]), 0)[0]) == 1000 and not len(shard.best(np.array([0]), least)[0])


def test_search_of_empty_tables(spark):
    rows, items = corpus()
    queries = table(spark, items).withColumnRenamed("doc_id", "item_id")
    assert search.search(table(spark, []), queries).count() == 0
    assert search.search(table(spark, rows), queries.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.search(table(spark, rows), queries.where("item_id = 100")).count() == 0
    named = spark.createDataFrame([("b", "cat"), ("a", "cat"), (None, "cat")], "doc_id string, text string")
    asked = spark.createDataFrame([("q", "cat"), ("q", "cat")], "item_id string, text string")
    assert [tuple(r)[:3] for r in search.search(named, asked).orderBy("rank").collect()] == [("q", 1, None), ("q", 2, "a"), ("q", 3, "b")]
