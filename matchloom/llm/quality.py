"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import carried, restored, stage, unstage
from .textbuf import _BYTES_LOWER, _P, _PI, U64, _powers, mix, pieces
from .toxicity import labelled_sample

#: Kinds of bytes: 0 between tokens, 1 of words, 2 of marks, 3 of line ends.
KIND = np.full(256, 2, np.uint8)
KIND[[*range(0x21), 0x7F]] = 0
KIND[0x30:0x3A] = KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:] = 1
KIND[0x0A] = 3
_UPPER, _DIGIT = np.zeros(256, np.int32), np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_STEP = U64(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Fit:
    """rows: labelled rows that are learned from, at most (the first by hash of the id; their whole texts); bits: of a bucket's
    number; words, shapes: longest runs of words and of word shapes; folds: shards of the sample, each learned from in order by one
    task; rounds: passes over the sample, after each of which the shards' steps are merged; alpha, beta: of the per-bucket
    learning rate; l1, l2: of the regulariser."""

    rows: int = 4_000
    bits: int = 18
    words: int = 2
    shapes: int = 3
    folds: int = 16
    rounds: int = 8
    alpha: float = 2.0
    beta: float = 0.1
    l1: float = 0.001
    l2: float = 0.001


class Tokens:
    """Words (A-Z lower-cased), runs of marks and line ends of a text column in order: ``doc``, name ``h``, and name ``shape``: the
    case, digits and rough length of a word, the name of any other token."""

    def __init__(self, col: pa.Array):
        col = pa.compute.fill_null(col, "").cast(pa.large_string())
        col = pa.concat_arrays([col]) if col.offset else col
        offsets = np.frombuffer(col.buffers()[1], np.int64)[: len(col) + 1]
        raw = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and offsets[-1] else np.empty(0, np.uint8)
        raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
        n = len(raw)
        kind = KIND[raw]
        change = np.ones(n + 1, bool)
        change[1:n] = kind[1:] != kind[:-1] if n else change[1:n]
        change[offsets] = True
        at = np.flatnonzero(change)
        start, end = at[:-1], at[1:]
        keep = kind[start] > 0 if n else np.empty(0, bool)
        start, end = start[keep], end[keep]
        self.doc = np.searchsorted(offsets, start, "right") - 1
        total = np.zeros(n + 1, U64)
        np.cumsum(_BYTES_LOWER[raw] * _powers(_P, n)[:n], out=total[1:])
        size = (end - start).astype(U64)
        self.h = mix((total[end] - total[start]) * _powers(_PI, n + 1)[start] + size * U64(0xA0761D6478BD642F))

        def among(table):
            count = np.concatenate([[0], np.cumsum(table[raw])])
            return count[end] - count[start]

        upper, digits = among(_UPPER), among(_DIGIT)
        first = _UPPER[raw[start]] if n else np.empty(0, np.int32)
        case = np.where(upper == 0, 0, np.where((upper == 1) & (first == 1), 1, np.where(2 * upper > end - start, 2, 3)))
        code = case * 16 + np.where(digits == 0, 0, np.where(digits == end - start, 1, 2)) * 4 + np.minimum(3, (end - start) // 4)
        self.shape = np.where(kind[start] == 1, mix(code.astype(U64) + U64(1)), self.h) if n else self.h

    def runs(self, names: np.ndarray, k: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, name) of every run of k tokens within one row."""
        n = len(names) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, U64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        x = np.full(len(at), salt * 0x9E3779B97F4A7C15 % (1 << 64), U64)
        for j in range(k):
            x = x * _STEP + names[at + j]
        return self.doc[at], mix(x)


def vectors(col: pa.Array, rule: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value), by row and bucket: how often a text's n-grams fall in a bucket, scaled to a vector of length 1."""
    t = Tokens(col)
    keys = [np.empty(0, np.int64)]
    for family, (names, longest) in enumerate(((t.h, rule.words), (t.shape, rule.shapes))):
        for k in range(1, longest + 1):
            row, name = t.runs(names, k, 10 * family + k)
            keys.append((row << rule.bits) | (name >> U64(64 - rule.bits)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row, bucket = key >> rule.bits, key & ((1 << rule.bits) - 1)
    norm = np.sqrt(np.bincount(row, count.astype(np.float64) ** 2, minlength=len(col)))
    return row, bucket, count / norm[row]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def weights(z: np.ndarray, n: np.ndarray, rule: Fit) -> np.ndarray:
    """What the state stands for: the minimiser of the linearised losses with both regularisers."""
    pull = np.sign(z) * np.maximum(np.abs(z) - rule.l1, 0)
    return -pull / ((rule.beta + np.sqrt(n)) / rule.alpha + rule.l2)


def examples(sample: DataFrame, rule: Fit) -> DataFrame:
    """One row a shard, staged: labels, ends and vectors of its labelled texts, in an order by their digests. ``rule.rows`` and
    ``rule.bits`` bound a row; no round needs a shuffle of it."""

    def run(table):
        text = table["text"].combine_chunks()
        y = np.asarray(table["y"])
        order = np.argsort([hashlib.blake2b((x.as_py() or "").encode(), digest_size=16).digest() for x in text], kind="stable")
        y, text = y[order], text.take(pa.array(order))
        lengths, buckets, values = [], [], []
        for piece in pieces(pa.RecordBatch.from_arrays([text], ["text"])):
            row, bucket, value = vectors(piece.column("text"), rule)
            lengths.append(np.bincount(row, minlength=len(piece)))
            buckets.append(bucket.astype(np.int32))
            values.append(value.astype(np.float32))
        cells = [y.astype(np.int32), np.cumsum(np.concatenate(lengths)).astype(np.int32), np.concatenate(buckets), np.concatenate(values)]
        return pa.table([pa.array([c], pa.list_(t)) for c, t in zip(cells, (pa.int32(), pa.int32(), pa.int32(), pa.float32()), strict=True)], ["y", "ends", "bucket", "value"])

    return stage(sample.groupBy("fold").applyInArrow(run, "y array<int>, ends array<int>, bucket array<int>, value array<float>"), "quality-examples")


#: Steps are summed as integers of so many parts of 1, so that their order does not matter.
PARTS = float(1 << 32)


def learn(shards: DataFrame, rule: Fit) -> tuple[np.ndarray, np.ndarray]:
    """The state (z, n) of all buckets, the last of which is the constant.

    In each round every task starts from the shared state and follows its shards example by example; a bucket's steps are averaged
    over the shards that moved it. The driver holds two numbers a bucket, whatever the sample.
    """
    size = (1 << rule.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    context = shards.sparkSession.sparkContext
    for _ in range(rule.rounds):
        shipped = context.broadcast((z, n))

        def run(batches):
            for batch in batches:
                for r in range(len(batch)):
                    y, ends, bucket, value = (np.asarray(c[r].values) for c in batch.columns)
                    z, n = (x.copy() for x in shipped.value)
                    begin = 0
                    for label, end in zip(y, ends, strict=True):
                        b, x = np.append(bucket[begin:end], size - 1), np.append(value[begin:end].astype(np.float64), 1.0)
                        begin = end
                        w = weights(z[b], n[b], rule)
                        g = (_sigmoid(w @ x) - label) * x
                        more = n[b] + g * g
                        z[b] += g - (np.sqrt(more) - np.sqrt(n[b])) / rule.alpha * w
                        n[b] = more
                    dz, dn = z - shipped.value[0], n - shipped.value[1]
                    moved = np.flatnonzero(dn)
                    columns = [moved.astype(np.int32), np.rint(dz[moved] * PARTS).astype(np.int64), np.rint(dn[moved] * PARTS).astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "dz", "dn"])

        steps = shards.mapInArrow(run, "bucket int, dz long, dn long").groupBy("bucket").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn"), F.count(F.lit(1)).alias("k")).toArrow()
        at, k = np.asarray(steps["bucket"]), np.asarray(steps["k"], np.float64)
        z, n = z.copy(), n.copy()
        z[at] += np.asarray(steps["dz"]) / PARTS / k
        n[at] += np.asarray(steps["dn"]) / PARTS / k
        shipped.unpersist()
    return z, n


def train(docs: DataFrame, labels: DataFrame, rule: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights of all buckets and the constant, fit on a bounded sample of labelled rows."""
    sample = labelled_sample(docs, labels, rule, id_col, text_col, label_col)
    shards = examples(sample, rule)
    state = learn(shards, rule)
    unstage(sample, shards)
    return weights(*state, rule)


def scores(col: pa.Array, w: np.ndarray, rule: Fit) -> np.ndarray:
    """Probability of label 1 of each text: a sparse dot product."""
    row, bucket, value = vectors(col, rule)
    return _sigmoid(w[-1] + np.bincount(row, value * w[bucket], minlength=len(col)))


def score_quality(docs: DataFrame, labels: DataFrame, rule: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: list[str] = ()) -> DataFrame:
    """(id, score) of every document: the probability of label 1. Learned from ``labels`` (id, label) that join ``docs``; scored on
    whole texts alone, in one pass without a shuffle; the weights that are shipped have a fixed size.

    Null and empty texts have the constant alone. Without labels the score is 0.5 for all. An id with several labels has the
    highest; labels other than 0 and 1 and those of null ids are not read. Repeated rows score alike; other columns are not read but
    for those to ``carry``, which follow the result.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rule, id_col, text_col, label_col))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                own = [piece.column("id"), pa.array(scores(piece.column("text"), shipped.value, rule))]
                yield pa.RecordBatch.from_arrays(own + [piece.column(c) for c in names], ["id", "score", *names])

    source, names, schema = carried(docs, id_col, text_col, list(carry))
    out = source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, score double{schema}")
    return restored(out, id_col, text_col, list(carry), ["score"])
