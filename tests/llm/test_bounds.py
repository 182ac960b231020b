"""Both ways of operators that have two, adversarial texts, and threads that share a session."""

import random
import threading
import time

import pytest

from pyspark.sql import functions as F

from matchloom.llm import base, decontaminate, mixing, ngram_join, secrets, urls

PAGES = "page_id long, url string, host string, rule string"


def slow_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[2], max(fit)[1]) if fit else (host, path, None, default)


def judged(df):
    return {r["page_id"]: tuple(r)[1:] for r in df.collect()}


TIES = [("block", "z.com", "/"), ("block", "com", "/ab"), ("allow", "z.com", "/abc/"), ("block", "com", "/abc/de"), ("allow", "com", "/abc/de"), ("allow", "y.z.com", "/"), ("block", "z.com", "/a/"), ("block", "com", "")]


@pytest.mark.parametrize("way", ["trie", "join", "table", "table join"])
def test_urls_have_one_result_on_both_paths(spark, monkeypatch, way):
    paths = ["", "/", "/a", "/ab", "/abc", "/abc/", "/abc/d", "/abc/de", "/abc/de/f", "/a/b?c=/", "/?x", "#/abc"]
    found = [f"http://{h}{p}" for h in ("z.com", "y.z.com", "x.y.z.com", "com", "az.com", "Z.COM", "org") for p in paths] + [None, "", "z.com/ab", "x://"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(found + found[:9])], PAGES)
    rules = [urls.Rule(*r) for r in TIES]
    if "join" in way:
        monkeypatch.setattr(urls, "TRIE_NODES", 0)
    if "table" in way:
        rules = spark.createDataFrame([*TIES, ("block", None, "/"), ("block", "com", None)], "verdict string, host string, path string")
    assert judged(urls.judge_urls(pages, rules)) == {i: slow_judge(u, TIES) for i, u in enumerate(found + found[:9])}


def test_many_rules_of_one_host(spark, monkeypatch):
    rng = random.Random(1)
    rules = [("block" if i % 2 else "allow", "big.com", f"/p{i}") for i in range(100_000)]
    trie = urls.Trie([urls.Rule(*r) for r in rules])
    asked = [f"/p{rng.randrange(200_000)}/x" for _ in range(2000)]
    began = time.time()
    found = [trie.find("www.big.com", p) for p in asked]
    assert time.time() - began < 2
    assert all(r is None or p.startswith(r.path) for r, p in zip(found, asked, strict=True)) and found[0] is not None
    pages = spark.createDataFrame([(i, f"http://www.big.com{p}", "", "") for i, p in enumerate(asked)], PAGES)
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    out = judged(urls.judge_by_join(pages, table))
    assert {i: x[2] for i, x in out.items()} == {i: r and r.name for i, r in enumerate(found)}


@pytest.mark.parametrize("piece", ["ABCDEFGHIJKLMNOPQRa7", "ABCDEFGHIJKLMNOPQRa", "abcabcabcA1", "aB", "Abc1", "ab-", "A", "a7"])
def test_allow_list_takes_linear_time(piece):
    text = piece * (200_000 // len(piece))
    rng = random.Random(3)
    text = text[:150_000] + "".join(rng.choice(piece) for _ in range(50_000))
    began = time.time()
    secrets.entropy_spans(text, secrets.EntropyRule(), *(secrets.re.compile("|".join(f"(?:{p})" for p in ps), secrets.re.S) for ps in (secrets.ALLOW, secrets.CUT)))
    assert time.time() - began < 4


def test_scopes_of_threads_are_apart(spark):
    kept, errors, opened, staged = [], [], threading.Event(), threading.Event()

    def opens():
        with base.scope():
            opened.set()
            staged.wait(60)

    def stages():
        try:
            opened.wait(60)
            kept.append(base.stage(spark.range(7), "thread"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)
        staged.set()

    threads = [threading.Thread(target=f) for f in (opens, stages)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and kept[0].count() == 7
    with base.scope() as outer:
        with base.scope():
            inner = base.stage(spark.range(3), "inner")
        assert outer == [inner]  # an outer scope holds it too
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        spark.read.schema("id long").parquet(inner._staged_at).count()


def test_tokens_that_no_task_finds_frequent_are_dealt(spark):
    """A shingle that each of many tasks holds twice is in no table of frequent ones; its prefix rows are counted exactly."""
    rule = ngram_join.JoinRule(hot=30, shares=11)
    rows = [(7, 0, i) for i in range(60)] + [(8, 0, i) for i in range(29)] + [(9, 4, i) for i in range(50)] + [(i, -1, i) for i in range(60)]
    held = spark.createDataFrame(rows, "token long, share int, sid long").repartition(20)
    dealt = ngram_join.dealt_postings(held, rule)
    shares = {r["token"]: r["s"] for r in dealt.where("share >= 0").groupBy("token").agg(F.collect_set("share").alias("s")).collect()}
    assert set(shares[7]) == set(range(1, 12)) and shares[8] == [0] and shares[9] == [4]
    assert dealt.count() == len(rows) and dealt.where("share = -1").count() == 60


def test_near_copies_in_many_tasks(spark, monkeypatch):
    """The same components whether hot tokens are dealt and joined or not, and by a join instead of a broadcast."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base_text = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(60):
        text = list(base_text)
        text[rng.randrange(60)] = f"edit{i}"
        rows.append((i, " ".join(text if i % 3 else [rng.choice(words) for _ in range(40)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    plain = {r["doc_id"]: r["component"] for r in ngram_join.similar_documents(docs, ngram_join.JoinRule(num=60)).collect()}
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", -1)
    dealt = {r["doc_id"]: r["component"] for r in ngram_join.similar_documents(docs, ngram_join.JoinRule(num=60, hot=5, shares=3)).collect()}
    assert plain == dealt and len({plain[i] for i in range(60) if i % 3}) == 1


def test_mix_of_many_sources_takes_the_same(spark, monkeypatch):
    """Tables of a row each source, staged and joined instead of broadcast."""
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 60))), f"s{rng.randint(0, 5)}" if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = lambda: {r["doc_id"]: (r["size"], r["target"], r["taken"]) for r in mixing.mix_sources(docs).collect()}
    few = taken()
    monkeypatch.setattr(mixing, "FEW", 0)
    assert taken() == few and taken() == few


def test_items_without_words_are_not_shipped(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(f"i{k}", "" if k else "b c") for k in range(50)] + [(None, "x")], "item_id string, text string")
    found = {r["doc_id"]: r["items"] for r in decontaminate.contamination(docs, items).collect()}
    assert found == {1: ["i0"], 2: [None]}
