"""Substring deduplication: long word sequences that an earlier document holds are removed, found by recompression."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .base import BROADCAST_ROWS, stage, unstage
from .recompress import anchors
from .textbuf import U64, Words, mix, pieces, signed

#: Anchors gathered in a task before hot ones are looked for, documents that make one hot, and shares a hot one is dealt to.
FLUSH, HOT, SHARES = 300_000, 2, 997
_SALT = 1
_LAST = (1 << 63) - 1


def sequence_key(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two names of each row's whole word sequence."""
    place = np.arange(len(w)) - w.first[w.doc]
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85):
        c = np.concatenate([np.zeros(1, U64), np.cumsum(mix(w.h + place.astype(U64) * U64(salt)))])
        out.append(mix(c[w.first + w.count] - c[w.first] + U64(salt)))
    return out[0], out[1]


def hot_first(anchor: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, share, key) rows without repeats. An anchor that HOT or more documents here hold is known to be shared: its
    rows are dealt to many shares, and one of them stays in share 0 as a witness for rows of other tasks. So one task
    adds one row of an anchor to share 0, however common it is."""
    order = np.lexsort((key, anchor))
    anchor, key = anchor[order], key[order]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    anchor, key = anchor[new], key[new]
    at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.empty(0, np.int64)
    n = np.diff(np.append(at, len(anchor)))
    hot = np.repeat(n >= HOT, n)
    share = np.where(hot, 1 + (key.view(np.uint64) % U64(SHARES)).astype(np.int64), 0)
    ends = at[n >= HOT]
    return np.concatenate([anchor, anchor[ends]]), np.concatenate([share, np.zeros(len(ends), np.int64)]), np.concatenate([key, key[ends]])


def shared_anchors(docs: DataFrame, width: int) -> DataFrame:
    """(key, anchors): the anchors of each document (key, text) that another one has too."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            anchor, share, key = hot_first(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            return pa.RecordBatch.from_arrays([signed(anchor), pa.array(share.astype(np.int32)), pa.array(key)], ["anchor", "share", "key"])

        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"))
                at, a = anchors(w, width, w.grams(width))
                if not len(at):
                    continue
                row = w.doc[at]
                new = np.ones(len(at), bool)
                new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
                keys = np.asarray(piece.column("key"), np.int64)
                held.append((a[new], keys[row[new]]))
                size += int(new.sum())
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select("key", "text").mapInArrow(run, "anchor long, share int, key long")
    by = W.partitionBy("anchor", "share")
    shared = rows.select("anchor", "share", "key", F.min("key").over(by).alias("lo"), F.max("key").over(by).alias("hi")).where("lo <> hi OR share > 0")
    return shared.groupBy("key").agg(F.collect_set("anchor").alias("anchors"))


def near_windows(docs: DataFrame, shared: DataFrame, width: int) -> DataFrame:
    """(w1, w2, ord, key, at): windows whose anchor is shared, by two independent names."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"))
                names = w.grams(width)
                at, a = anchors(w, width, names)
                _, check = w.grams(width, _SALT)
                col = piece.column("anchors")
                flat = np.asarray(col.flatten(), np.int64).view(U64)
                # (row, anchor) pairs as one name each
                rows = np.repeat(np.arange(len(col)), np.asarray(col.value_lengths()))
                wanted = np.unique(mix(flat + mix(rows.astype(U64))))
                mine = mix(a + mix(w.doc[at].astype(U64)))
                spot = np.minimum(np.searchsorted(wanted, mine), max(0, len(wanted) - 1))
                use = np.flatnonzero(wanted[spot] == mine) if len(wanted) and len(mine) else np.empty(0, np.int64)
                row = w.doc[at[use]]
                keys, ords = np.asarray(piece.column("key"), np.int64), np.asarray(piece.column("ord"), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [signed(names[1][use]), signed(check[use]), pa.array(ords[row]), pa.array(keys[row]), pa.array((at[use] - w.first[row]).astype(np.int32))], ["w1", "w2", "ord", "key", "at"]
                )

    joined = docs.select("key", "ord", "text").join(shared, "key").select("key", "ord", "text", "anchors")
    return joined.mapInArrow(run, "w1 long, w2 long, ord long, key long, at int")


def split_by_key(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key is in keys, the others); up to BROADCAST_ROWS keys neither side is shuffled. Beyond that, all rows and
    None: one outer join then serves both."""
    keys = stage(keys.select("key").distinct(), "keys")
    if keys.count() <= BROADCAST_ROWS:
        return docs.join(F.broadcast(keys), "key", "left_semi"), docs.join(F.broadcast(keys), "key", "left_anti")
    return docs, None


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): each text without the words that any window of ``width`` words covers whose word
    sequence also starts in a document with a smaller id. Kept words are joined by one space.

    Words are runs of non-whitespace (ASCII whitespace). Windows are judged on the input. Null and empty texts have no
    words; ids are integers or cast to long; rows with a null id come after all others and, like rows with the same id, remove nothing from each other;
    repeated rows give repeated results; other columns are not read.

    Recompression rounds name runs and pairs of symbols by hashes, so equal substrings get the same interior symbols in
    every task. Each window has one of the symbols inside it as its anchor. One shuffle of anchors, about one for
    four words, finds those in two documents or more; only windows with such an anchor are named exactly (128 bits) and
    grouped. Whole copies are settled by the name of their word sequence first.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("ord"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    def summary(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"))
                a, b = sequence_key(w)
                yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("ord"), pa.array(w.count), signed(a), signed(b)], ["key", "ord", "n", "s1", "s2"])

    rows = stage(source.select("key", "ord", "text").mapInArrow(summary, "key long, ord long, n long, s1 long, s2 long").where(F.col("n") >= width), "sub-rows")
    least = stage(rows.groupBy("s1", "s2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last"), "sub-least")
    copies = stage(rows.join(least, ["s1", "s2"]).where("ord > first").select("key").distinct(), "sub-copies")
    unstage(least, rows)
    if copies.count() <= BROADCAST_ROWS:
        once = source.join(F.broadcast(copies), "key", "left_anti")
    else:
        once = source.join(copies, "key", "left_anti")
    shared = stage(shared_anchors(once, width), "sub-shared")
    some, _ = split_by_key(source, shared)
    windows = stage(near_windows(some, shared, width), "sub-windows")
    firsts = stage(windows.groupBy("w1", "w2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last").select("w1", "w2", "first"), "sub-firsts")
    late = windows.join(firsts, ["w1", "w2"]).where("ord > first").select("key", "at").distinct()
    repeats = stage(late.groupBy("key").agg(F.collect_list("at").alias("at")).select("key", F.lit(False).alias("whole"), "at").union(copies.select("key", F.lit(True), F.array().cast("array<int>"))), "sub-repeats")
    unstage(shared, windows, firsts)

    id_type = source.schema["id"].dataType.simpleString()
    out_schema = f"id {id_type}, n_words long, n_removed long, kept string"

    def plain(batches):
        for batch in batches:
            words = [(t.as_py() or "").encode().split() for t in batch.column("text")]
            n = pa.array([len(x) for x in words], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, pa.array([0] * len(words), pa.int64()), pa.array([b" ".join(x).decode() for x in words], pa.string())], ["id", "n_words", "n_removed", "kept"])

    def cut(batches):
        for batch in batches:
            n, removed, kept = [], [], []
            for t, whole, at in zip(batch.column("text"), batch.column("whole"), batch.column("at"), strict=True):
                words = (t.as_py() or "").encode().split()
                left = np.ones(len(words) + 1, np.int64)
                if whole.as_py():
                    left[:] = 0
                elif at.is_valid:
                    start = np.asarray(at.values, np.int64)
                    d = np.zeros(len(words) + 1, np.int64)
                    np.add.at(d, start, 1)
                    np.add.at(d, start + width, -1)
                    left = np.cumsum(d) == 0
                left = left[: len(words)].astype(bool)
                n.append(len(words))
                removed.append(int(len(words) - left.sum()))
                kept.append(b" ".join(compress(words, left.tolist())).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    texts = source.select("id", "key", "text")
    touched, clean = split_by_key(texts, repeats)
    whole = touched.join(repeats, "key", "left").select("id", "text", "whole", "at").mapInArrow(cut, out_schema)
    if clean is not None:
        whole = whole.union(clean.select("id", "text").mapInArrow(plain, out_schema))
    return whole.withColumnRenamed("id", id_col)
