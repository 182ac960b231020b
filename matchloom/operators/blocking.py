"""Candidate generation: an inverted-index join with capped posting lists, then two cuts for each entity."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import MatchConfig
from ..functions.similarity import cut_similarities_udf
from ..sources.scratch import materialize


def postings(records: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """(entity_id, country, kind, key, weight): name beginnings of 4 (3 for names of 3) characters weigh 2; the first four
    distinct name tokens and the first two numbers weigh 1. Repeated numbers stay repeated."""
    name = F.col("norm_name")
    key = lambda kind, k, weight: F.struct(F.lit(kind).alias("kind"), k.alias("key"), F.lit(weight).alias("weight"))
    none = F.lit(None).cast("string")
    prefix = F.array(
        key("pfx4", F.when(F.length(name) >= 4, F.substring(name, 1, 4)).otherwise(none), 2),
        key("pfx3", F.when(F.length(name) == 3, name).otherwise(none), 2),
    )
    tokens = F.slice(F.array_distinct(F.filter(F.split(name, " "), lambda t: F.length(t) >= config.min_token_len)), 1, 4)
    numbers = F.filter(F.slice("addr_numbers", 1, 2), lambda t: F.length(t) >= 2)
    keys = F.concat(F.filter(prefix, lambda k: k["key"].isNotNull()), F.transform(tokens, lambda t: key("tok", t, 1)), F.transform(numbers, lambda t: key("num", t, 1)))
    return records.select("entity_id", F.col("norm_country").alias("country"), F.explode(keys).alias("k")).select("entity_id", "country", "k.kind", "k.key", "k.weight")


def key_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("country", "kind", "key").agg(F.count(F.lit(1)).alias("n"))


def prune_hot_keys(index: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Postings without those of keys that more than ``max_key_freq`` rows hold: what bounds the join's output.

    The list of hot keys is at most rows / max_key_freq long; adaptive execution broadcasts it where it is small.
    """
    hot = key_counts(index).where(F.col("n") > config.max_key_freq).select("country", "kind", "key")
    return index.join(hot, ["country", "kind", "key"], "left_anti")


def _elements(queries: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_id, asked) and (cand_id, held): the keys of each record as elements (h, g, w), two names of 64 bits each and a weight.

    A target that has a key m times holds its elements 1 to m, a record that has it a times asks for all of them at a times its
    weight: the weights of what is asked and held add up to the hits. A held element has the greatest weight that anyone asks for
    it. Keys that only one side has are left out.
    """
    key = ["country", "kind", "key"]
    held = index.groupBy(F.col("entity_id").alias("cand_id"), *key).agg(F.count(F.lit(1)).alias("m"))
    asked = queries.groupBy(F.col("entity_id").alias("s1_id"), *key).agg(F.sum("weight").cast("long").alias("w"))
    both = held.groupBy(*key).agg(F.max("m").alias("m")).join(asked.groupBy(*key).agg(F.max("w").alias("w")), key)
    element = F.struct(F.xxhash64(*key, "j").alias("h"), F.xxhash64("j", *reversed(key)).alias("g"), "w")
    # as many tasks as are set: what follows makes far more rows than it reads
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda df, id_, name: df.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).select(id_, element.alias("e")).repartition(n, id_).groupBy(id_).agg(F.array_sort(F.collect_list("e")).alias(name))
    return side(asked.join(both.drop("w"), key), "s1_id", "asked"), side(held.join(both.drop("m"), key), "cand_id", "held")


def hits(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(s1_id, cand_id, hits): weighted number of shared keys.

    Each record takes all its elements along to each of them, so a pair is made where its first shared element meets, and only there,
    with all its hits: postings are shuffled, pairs never. An element of weight w stands for w units, so hits are shared units.
    """
    asked, held = _elements(queries, index)
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = lambda c: F.flatten(F.transform(c, lambda e: F.transform(F.sequence(F.lit(1).cast("long"), e["w"]), lambda k: F.xxhash64(e["h"], k))))
    q = asked.select("s1_id", units("asked").alias("asked_units"), F.col("asked.h").alias("asked"), F.posexplode("asked.h").alias("p", "at"))
    q = q.select("s1_id", "asked_units", "at", F.slice("asked", F.lit(1), F.col("p")).alias("before")).repartition(n, "at")
    i = held.select("cand_id", units("held").alias("held_units"), F.col("held.h").alias("held"), F.explode("held.h").alias("at")).repartition(n, "at")
    first = q.join(i, "at").where(~F.arrays_overlap("before", "held"))
    return first.select("s1_id", "cand_id", F.size(F.array_intersect("asked_units", "held_units")).cast("long").alias("hits"))


def _subsets(elements: str, zero: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """All subsets of the elements but the empty one, each as the elements joined."""
    every = F.aggregate(elements, F.array(zero), lambda some, e: F.concat(some, F.transform(some, lambda x: joined(x, e))))
    return F.slice(every, 2, F.greatest(F.size(every) - 1, F.lit(0)))


def best_hits(queries: DataFrame, index: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """(s1_id, cand_id, hits): the ``first_cut`` best candidates of each entity by hits (ties: smaller id); what ``first_cut`` leaves of
    ``hits``, without making its pairs.

    A target is known under every subset of its elements, and a subset keeps its ``first_cut`` smallest ids. One of an entity's best is
    among those of the subset that both share: else so many others share as much and have smaller ids. What an entity needs is thus in
    the lists of its own subsets, of which a record with seven keys has 127, however many targets a key has. The weight of
    the heaviest subset that names a candidate is its hits.
    """
    asked, held = _elements(queries, index)
    none = F.lit(0).cast("long")
    both = lambda x, e: (x["h"].bitwiseXOR(e["h"]).alias("h"), x["g"].bitwiseXOR(e["g"]).alias("g"))
    q = asked.select("s1_id", F.explode(_subsets("asked", F.struct(none.alias("h"), none.alias("g"), none.alias("w")), lambda x, e: F.struct(*both(x, e), (x["w"] + e["w"]).alias("w")))).alias("s"))
    i = held.select("cand_id", F.explode(_subsets("held", F.struct(none.alias("h"), none.alias("g")), lambda x, e: F.struct(*both(x, e)))).alias("s"))
    q, i = q.select("s1_id", "s.h", "s.g", "s.w"), i.select("cand_id", "s.h", "s.g")
    least = W.partitionBy("h", "g").orderBy("cand_id")
    lists = i.withColumn("r", F.row_number().over(least)).where(F.col("r") <= config.first_cut).groupBy("h", "g").agg(F.collect_list("cand_id").alias("ids"))
    # lists travel to their entities as they are; what follows needs no other shuffle
    found = q.join(lists, ["h", "g"]).select("s1_id", "w", "ids").repartition("s1_id").select("s1_id", "w", F.explode("ids").alias("cand_id"))
    return first_cut(found.groupBy("s1_id", "cand_id").agg(F.max("w").alias("hits")), config)


#: Entities, and targets, that one task of ``block_hits`` has at most; rows of either that are worth a block of their own.
ASKED_ROWS, HELD_ROWS, LEAST_ROWS = 20_000, 200_000, 1_000
HITS = "sig binary, cand_id string, hits long"


def _count_block(top: int):
    """Best ``top`` rows of a block of targets for each row of a block of entities, by counts over posting lists."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        held = held.take(pc.sort_indices(held.column("cand_id")))  # of equal counts the smaller id is the smaller row
        keys = held.column("keys").combine_chunks()
        names, at = np.unique(np.asarray(keys.flatten()), return_inverse=True)
        rows = np.repeat(np.arange(len(held)), np.asarray(pc.list_value_length(keys)))[np.argsort(at, kind="stable")]
        ends = np.cumsum(np.bincount(at, minlength=len(names)))
        lists = dict(zip(names.tolist(), np.split(rows, ends[:-1]), strict=True)) if len(names) else {}
        who, row, hits = [], [], []
        for i, some in enumerate(asked.column("keys").to_pylist()):
            found = [lists[k] for k in some if k in lists]
            if not found:
                continue
            counts = np.bincount(np.concatenate(found), minlength=len(held))
            rows_of = np.bincount(counts)
            total, least = 0, len(rows_of)
            while least > 1 and total < top:
                least -= 1
                total += int(rows_of[least])
            best = np.flatnonzero(counts >= least)
            best = best[np.argsort(-counts[best], kind="stable")[:top]]
            who.append(np.full(len(best), i))
            row.append(best)
            hits.append(counts[best])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"sig": asked.column("sig").take(pa.array(join(who))), "cand_id": held.column("cand_id").take(pa.array(join(row))), "hits": pa.array(join(hits), pa.int64())})

    return run


def block_grid(asked: DataFrame, held: DataFrame, blocks: int, asked_rows: int, held_rows: int, least_rows: int) -> DataFrame:
    """(country, asked_parts, held_parts): into how many blocks the rows of either side of a country are cut, so that all countries together make
    about ``blocks`` meetings of two blocks, each country by its number of pairs.

    A row travels once for each block that it meets, so the sides of a country are cut alike: with k meetings each travels about the root
    of k times. (Cutting the side that asks alone would send the other one to every task.) A row that asks also brings back its best
    of each block, which counts as much as the row itself. Blocks have at most ``asked_rows`` and ``held_rows`` rows, and no fewer than
    ``least_rows`` unless the country has fewer.
    """
    count = lambda df, name: df.groupBy("country").agg(F.count(F.lit(1)).cast("double").alias(name))
    sizes = count(asked, "asked").join(count(held, "held"), "country").withColumn("pairs", F.col("asked") * F.col("held"))
    every = sizes.agg(F.sum("pairs").alias("all_pairs"))
    k = F.ceil(blocks * F.col("pairs") / F.col("all_pairs"))
    parts = lambda rows, wanted, most: F.greatest(F.ceil(F.col(rows) / most), F.least(wanted, F.ceil(F.col(rows) / least_rows))).cast("int")
    sizes = sizes.crossJoin(F.broadcast(every)).withColumn("k", k).withColumn("held_parts", parts("held", F.round(F.sqrt(F.col("k") * F.col("held") / (2 * F.col("asked")))), held_rows))
    return sizes.withColumn("asked_parts", parts("asked", F.ceil(F.col("k") / F.col("held_parts")), asked_rows)).select("country", "asked_parts", "held_parts")


def block_hits(queries: DataFrame, index: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """As ``best_hits``, for postings of many keys each, no key twice in a record, all of weight 1.

    Entities and targets of a country are dealt into blocks; each block of entities meets each block of targets in one task, which counts
    hits over posting lists in memory and keeps the ``first_cut`` best. Pairs never leave a task. Entities of one set of keys are asked once;
    of the targets of one set of keys only the ``first_cut`` smallest ids can be candidates. A key is known by 64 bits, a set by a digest.
    """
    key = ["country", "kind", "key"]
    used = queries.select(*key).distinct().join(index.select(*key).distinct(), key)
    keys = F.array_sort(F.collect_list(F.xxhash64(*key)))
    sig = F.unhex(F.md5(F.concat_ws(" ", F.col("country"), F.array_join(F.transform("keys", lambda x: x.cast("string")), " ")).cast("binary")))
    side = lambda df, id_: df.join(used, key).groupBy(F.col("entity_id").alias(id_), "country").agg(keys.alias("keys")).withColumn("sig", sig)
    # each is read several times
    entities = materialize(side(queries, "s1_id"), "asked-sets")
    asked = entities.groupBy("sig").agg(F.first("country").alias("country"), F.first("keys").alias("keys"))
    same = W.partitionBy("sig").orderBy("cand_id")
    held = materialize(side(index, "cand_id").withColumn("r", F.row_number().over(same)).where(F.col("r") <= config.first_cut).select("country", "cand_id", "keys"), "held-sets")
    n = max(1, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sizes = block_grid(asked, held, n, ASKED_ROWS, HELD_ROWS, LEAST_ROWS)
    block = lambda c, parts: F.pmod(F.xxhash64(c), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    asked = asked.join(F.broadcast(sizes), "country").withColumn("a", block("sig", "asked_parts")).withColumn("b", every("held_parts")).select("country", "a", "b", "sig", "keys")
    held = held.join(F.broadcast(sizes), "country").withColumn("b", block("cand_id", "held_parts")).withColumn("a", every("asked_parts")).select("country", "a", "b", "cand_id", "keys")
    at = ["country", "a", "b"]
    deal = lambda df: df.repartition(n, *at).groupBy(*at)
    found = deal(asked).cogroup(deal(held)).applyInArrow(_count_block(config.first_cut), HITS)
    best = W.partitionBy("sig").orderBy(F.desc("hits"), "cand_id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= config.first_cut).drop("r")
    return entities.select("s1_id", "sig").join(found, "sig").select("s1_id", "cand_id", "hits")


def first_cut(found: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The ``first_cut`` best candidates of each entity by hits (ties: smaller id)."""
    by = W.partitionBy("s1_id").orderBy(F.desc("hits"), "cand_id")
    return found.withColumn("pre_rank", F.row_number().over(by)).where(F.col("pre_rank") <= config.first_cut).drop("pre_rank")


def attributes(df: DataFrame, records: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """Adds a record's normalized columns under a prefix; pairs without a record go."""
    cols = {"norm_name": "name", "norm_addr": "addr", "norm_country": "country", "addr_numbers": "nums"}
    right = records.select(F.col("entity_id").alias(id_col), *(F.col(c).alias(f"{prefix}_{n}") for c, n in cols.items()))
    return df.join(right, id_col)


def second_cut(pairs: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Candidates above the floors, the ``max_candidates`` best by combined score (ties: hits, then smaller id).

    ``pairs`` has hits and both sides' names and addresses; the address comparison runs only on pairs over the name floor.
    """
    sims = pairs.withColumn("_s", cut_similarities_udf(config.name_floor)("s1_name", "c_name", "s1_addr", "c_addr"))
    both = sims.withColumns({"name_sim": F.col("_s.name"), "addr_sim": F.col("_s.addr")}).drop("_s").where(F.col("name_sim") >= config.name_floor)
    scored = both.withColumn("score", F.round(config.name_weight * F.col("name_sim") + config.addr_weight * F.col("addr_sim"), 9))
    kept = scored.where((F.col("score") >= config.min_score) | (F.col("name_sim") >= config.name_keep))
    by = W.partitionBy("s1_id").orderBy(F.desc("score"), F.desc("hits"), "cand_id")
    return kept.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= config.max_candidates)


class Blocker:
    """Index once, ask many times: ``fit`` on the target records, then ``candidates`` for any S1 records."""

    def __init__(self, config: MatchConfig = MatchConfig()):
        self.config = config
        self.targets: DataFrame | None = None
        self.index: DataFrame | None = None

    def fit(self, *targets: DataFrame) -> Blocker:
        """Index the union of normalized target sources (one row for each id)."""
        union = targets[0]
        for t in targets[1:]:
            union = union.unionByName(t)
        self.targets = union.select("entity_id", "norm_name", "norm_addr", "norm_country", "addr_numbers")
        self.index = prune_hot_keys(postings(self.targets, self.config), self.config)
        return self

    def keep(self) -> Blocker:
        """Hold the index and the targets, so that several calls build them once; ``release`` lets them go."""
        if self.index is None:
            raise ValueError("fit the blocker on target records first")
        self.targets, self.index = self.targets.persist(), self.index.persist()
        return self

    def release(self) -> None:
        for df in (self.targets, self.index):
            if df is not None:
                df.unpersist()

    def pairs(self, s1: DataFrame) -> DataFrame:
        """Pairs after the first cut with hits and both sides' attributes."""
        if self.index is None:
            raise ValueError("fit the blocker on target records first")
        cut = best_hits(postings(s1, self.config), self.index, self.config)
        return attributes(attributes(cut, self.targets, "cand_id", "c"), s1, "s1_id", "s1")

    def candidates(self, s1: DataFrame) -> DataFrame:
        """(s1_id, cand_id, hits, score, rank, name_sim, addr_sim and both sides' attributes)."""
        return second_cut(self.pairs(s1), self.config)


MultiStrategyBlocker = Blocker


def candidate_lists(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id, candidates): ids in order of rank; an empty list for entities without any."""
    lists = candidates.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("candidates"))
    left = s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return left.select("s1_id", F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"))
