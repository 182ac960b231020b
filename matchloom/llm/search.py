"""Ranked lexical search: the best documents of every query by a weighted sum over shared terms, with MaxScore in each shard."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .textbuf import NON_WORD, U64, Words, pieces, signed


@dataclass(frozen=True)
class Rule:
    """top: documents for each query; share: percent of the length norm that goes by a document's length; damp: how soon repeats of a term
    stop to count (20: two occurrences of a document of mean length give half of all that can be had); block: words of the queries
    that are answered together, which bounds what is shipped; first, most: words of a task's first shard of documents and of its
    largest (each is four times the one before)."""

    top: int = 50
    share: int = 50
    damp: int = 20
    block: int = 1 << 20
    first: int = 1 << 15
    most: int = 1 << 21


@dataclass
class Queries:
    """A block of queries: their ids (Arrow), names of all their terms (sorted), and for each query its terms' places in these."""

    ids: pa.Array
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def query_terms(items: DataFrame, id_col: str, text_col: str, rule: Rule) -> Iterator[Queries]:
    """Distinct queries with their distinct terms, in blocks dealt by hash; a block alone reaches the driver."""
    source = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                sets = [signed(np.unique(w.h[a : a + n])) for a, n in zip(w.first, w.count, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(w.count), pa.array(sets, pa.list_(pa.int64()))], ["id", "n", "terms"])

    total = source.mapInArrow(run, f"id {kind}, n long, terms array<long>").agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // rule.block))
    for b in range(blocks):
        part = source.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).mapInArrow(run, f"id {kind}, n long, terms array<long>")
        found = part.where("n > 0").select("id", "terms").orderBy("id", "terms").toArrow().combine_chunks()
        if len(found):
            sets = [np.asarray(x.values).view(U64) for x in found["terms"].combine_chunks()] if len(found) else []
            vocabulary = np.unique(np.concatenate(sets))
            yield Queries(found["id"].combine_chunks(), vocabulary, [np.searchsorted(vocabulary, s) for s in sets])


def occurrences(w: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the vocabulary's terms in a piece of the documents, by row and term."""
    at = np.minimum(np.searchsorted(vocabulary, w.h), len(vocabulary) - 1)
    hit = vocabulary[at] == w.h
    key, times = np.unique(w.doc[hit].astype(np.int64) * len(vocabulary) + at[hit], return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), times


@dataclass
class Statistics:
    """documents with a term, all their terms, and each vocabulary term's weight."""

    documents: int
    words: int
    weight: np.ndarray


def statistics(source: DataFrame, queries: Queries) -> Statistics:
    """Counts over all documents: each task sums its own first."""
    shipped = source.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def run(batches):
        vocabulary = shipped.value
        held = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                held[:-2] += np.bincount(occurrences(w, vocabulary)[1], minlength=len(vocabulary))
                held[-2:] += (w.count > 0).sum(), len(w)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "n"])

    counted = source.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(len(queries.vocabulary) + 2, np.int64)
    held[np.asarray(counted["term"])] = np.asarray(counted["n"])
    shipped.unpersist()
    documents, words = int(held[-2]), int(held[-1])
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held[:-2].tolist()]
    return Statistics(documents, words, np.array(weight, np.int64))


class Shard:
    """Postings of some documents, by term, with the upper bound of what a term gives any of them."""

    def __init__(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, times: np.ndarray, stats: Statistics, rule: Rule):
        norm = 100 - rule.share + (rule.share * n.astype(np.int64) * stats.documents) // max(1, stats.words)
        gives = stats.weight[term] * ((1_000_000_000 * times) // (1000 * times + rule.damp * norm[row]))
        order = np.lexsort((row, term))
        self.row, self.gives = row[order], gives[order]
        at = np.flatnonzero(np.append(True, np.diff(term[order]) != 0)) if len(term) else np.empty(0, np.int64)
        self.bound = np.zeros(len(stats.weight), np.int64)
        self.low, self.high = np.zeros((2, len(stats.weight)), np.int64)
        t = term[order][at]
        self.low[t], self.high[t] = at, np.append(at[1:], len(term))
        self.bound[t] = np.maximum.reduceat(self.gives, at) if len(at) else 0
        self.sum = np.zeros(len(n), np.int64)

    def best(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of all documents that score at least ``least`` and more than 0.

        Terms in order of their bounds: as long as all bounds together stay below ``least``, terms are not essential, for a document
        with no other term cannot qualify. The essential ones' postings give the candidates; the others, highest bound first, are
        only probed for those whose score with all bounds that remain still can reach ``least``.
        """
        terms = terms[self.bound[terms] > 0]
        terms = terms[np.argsort(self.bound[terms], kind="stable")]
        reach = np.cumsum(self.bound[terms])
        split = int(np.searchsorted(reach, least, "left"))
        if split == len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lists = [slice(self.low[t], self.high[t]) for t in terms]
        for x in lists[split:]:
            self.sum[self.row[x]] += self.gives[x]
        rows = np.unique(np.concatenate([self.row[x] for x in lists[split:]]))
        score = self.sum[rows]
        self.sum[rows] = 0
        for i in range(split - 1, -1, -1):
            can = score + reach[i] >= least
            rows, score = rows[can], score[can]
            if not len(rows):
                break
            held = self.row[lists[i]]
            at = np.minimum(np.searchsorted(held, rows), len(held) - 1)
            score = score + np.where(held[at] == rows, self.gives[lists[i]][at], 0)
        keep = (score >= least) & (score > 0)
        return rows[keep], score[keep]


class Tops:
    """The best documents so far of every query of a block, over a task's shards."""

    def __init__(self, queries: Queries, stats: Statistics, rule: Rule):
        self.queries, self.stats, self.rule = queries, stats, rule
        self.held: list[list[tuple]] = [[] for _ in queries.terms]
        self.clear()

    def clear(self) -> None:
        self.parts, self.ids, self.rows, self.words = [], [], 0, 0

    def add(self, ids: pa.Array, w: Words) -> None:
        row, term, times = occurrences(w, self.queries.vocabulary)
        self.parts.append((w.count, row + self.rows, term, times))
        self.ids.append(ids)
        self.rows, self.words = self.rows + len(ids), self.words + len(w)

    def search(self) -> None:
        """Answer all queries on what was added, and forget it."""
        if not self.parts:
            return
        shard = Shard(*(np.concatenate(x) for x in zip(*self.parts, strict=True)), self.stats, self.rule)
        ids = pa.concat_arrays(self.ids)
        place = np.empty(len(ids), np.int64)
        place[np.asarray(pa.compute.sort_indices(ids, null_placement="at_start"))] = np.arange(len(ids))
        top = self.rule.top
        for q, terms in enumerate(self.queries.terms):
            held = self.held[q]
            rows, score = shard.best(terms, held[-1][0] if len(held) == top else 0)
            if len(rows) > top:
                near = np.flatnonzero(score >= np.partition(score, -top)[-top])
                near = near[np.lexsort((place[rows[near]], -score[near]))[:top]]
                rows, score = rows[near], score[near]
            if len(rows):
                own = zip(score.tolist(), ids.take(pa.array(rows)).to_pylist(), strict=True)
                self.held[q] = sorted([*held, *own], key=lambda x: (-x[0], x[1] is not None, x[1]))[:top]
        self.clear()

    def rows_of(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        found = [(q, score, id_) for q, held in enumerate(self.held) for score, id_ in held]
        for at in range(0, len(found), 10_000):
            q, score, id_ = zip(*found[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(id_, kind), pa.array(score, pa.int64())], ["q", "id", "score"])


def _answers(source: DataFrame, queries: Queries, rule: Rule) -> DataFrame:
    """(q, id, score, rank): each task keeps its own best; one window a query ranks what the tasks found."""
    kind = source.schema["id"].dataType.simpleString()
    shipped = source.sparkSession.sparkContext.broadcast((queries.vocabulary, queries.terms, statistics(source, queries)))

    def run(batches):
        vocabulary, terms, stats = shipped.value
        tops, most, type_ = Tops(Queries(None, vocabulary, terms), stats, rule), rule.first, None
        for batch in batches:
            type_ = batch.schema.field("id").type
            for piece in pieces(batch):
                tops.add(piece.column("id"), Words(piece.column("text"), NON_WORD, lower=True))
                if tops.words >= most:
                    tops.search()
                    most = min(4 * most, rule.most)
        tops.search()
        if type_ is not None:
            yield from tops.rows_of(type_)

    found = source.mapInArrow(run, f"q int, id {kind}, score long")
    by = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= rule.top)


def search(docs: DataFrame, items: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item id, rank, doc id, score) of each item's ``top`` best documents with a score above 0, equal scores by ascending id.

    Two passes over the documents for each block of queries (``rule.block`` words of them; the vocabulary and weights of a block are
    what is shipped): one for the statistics, one for the search. Documents are not shuffled; a task goes through its own in
    shards that grow, and its best scores so far are the bounds in the next one.

    Null and empty texts have no terms: such documents are never found, such items have no rows. Items are distinct rows of (id, text);
    items of one id with different texts are ranked apart. Repeated documents are found each. Null ids stand first among
    ties. Empty tables give an empty result; other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = items.schema[item_col].dataType
    schema = f"q int, item {id_type.simpleString()}"
    parts = []
    for queries in query_terms(items, item_col, item_text, rule):
        names = docs.sparkSession.createDataFrame(pa.table([pa.array(range(len(queries.ids)), pa.int32()), queries.ids], ["q", "item"]), schema)
        parts.append(_answers(source, queries, rule).join(F.broadcast(names), "q"))
    if not parts:
        return source.where("false").select(F.lit(None).cast(id_type).alias(item_col), F.lit(None).cast("int").alias("rank"), F.col("id").alias(id_col), F.lit(None).cast("long").alias("score"))
    return reduce(DataFrame.unionByName, parts).select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
