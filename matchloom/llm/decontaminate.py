"""Benchmark decontamination: a prefix-filtered join of documents with item-sized windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import carried, restored, stage, unstage
from .textbuf import NON_WORD, U64, Words, mix, pieces, signed

#: Benchmark words, counted exactly, up to which its index is shipped to the tasks (about 60 bytes each); the windows of larger
#: ones are joined by shuffles. Bits of the tables by which that join drops document words beforehand.
INDEX_WORDS, FILTER_BITS = 1_000_000, 27
#: Classes of words that the join's order of rarity tells apart.
BUCKETS = 1 << 16
_SALT = 1


@dataclass
class Index:
    """Distinct windows by their necessary token: the rarest word of a window, which any text that holds it must hold.

    token, offset, length, name, check: one entry for each distinct window, sorted by token; the items of entry i are
    item[first[i]:first[i + 1]].
    """

    token: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    name: np.ndarray
    check: np.ndarray
    first: np.ndarray
    item: np.ndarray


def item_windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, length, name, check) of each window: k consecutive words, or all of an item with fewer."""
    out = []
    for m in range(1, k + 1):
        at, name = w.grams(m)
        _, check = w.grams(m, _SALT)
        keep = np.ones(len(at), bool) if m == k else w.count[w.doc[at]] == m
        at = at[keep]
        out.append((w.doc[at], at, np.full(len(at), m), name[keep], check[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def keyed_windows(items: DataFrame, k: int, rarity) -> DataFrame:
    """(token, offset, length, name, check, item) of each item's windows, each under its rarest word: the least by ``rarity``
    (word names to counts), ties by the smaller name. Distinct, one row for each item."""
    item_type = items.schema["item"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                row, at, length, name, check = item_windows(w, k)
                count = rarity(w.h)
                offset = np.zeros(len(at), np.int64)
                least, best = w.h[at], count[at]
                for j in range(1, k):  # the rarest word so far of each window
                    use = np.flatnonzero(length > j)
                    n, h = count[at[use] + j], w.h[at[use] + j]
                    less = (n < best[use]) | ((n == best[use]) & (h < least[use]))
                    use = use[less]
                    offset[use], best[use], least[use] = j, n[less], h[less]
                yield pa.RecordBatch.from_arrays(
                    [signed(least), pa.array(offset.astype(np.int32)), pa.array(length.astype(np.int32)), signed(name), signed(check), piece.column("item").take(pa.array(row))],
                    ["token", "offset", "length", "name", "check", "item"],
                )

    return items.mapInArrow(run, f"token long, offset int, length int, name long, check long, item {item_type}").distinct()


def build_index(windows: pa.Table, ids: pa.Array) -> Index:
    """The index of all windows; items are places in ``ids``."""
    column = lambda c, t: np.asarray(windows[c].combine_chunks(), np.int64).view(t)
    token, name, check = (column(c, U64) for c in ("token", "name", "check"))
    offset, length = column("offset", np.int64), column("length", np.int64)
    item = np.asarray(pa.compute.index_in(windows["item"].combine_chunks(), ids), np.int64)
    order = np.lexsort((item, check, name, length, offset, token))
    token, offset, length, name, check, item = (x[order] for x in (token, offset, length, name, check, item))
    new = np.ones(len(token), bool)
    if len(token):
        new[1:] = np.any([x[1:] != x[:-1] for x in (token, offset, length, name, check)], axis=0)
    at = np.flatnonzero(new)
    return Index(token[at], offset[at], length[at], name[at], check[at], np.append(at, len(token)), item)


def found_items(index: Index, row: np.ndarray, entry: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets by row, places of items): the distinct items whose windows are found in each row."""
    pair = np.unique(np.column_stack([row, entry]), axis=0) if len(row) else np.empty((0, 2), np.int64)
    n = index.first[pair[:, 1] + 1] - index.first[pair[:, 1]]
    at = np.repeat(index.first[pair[:, 1]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pair = np.unique(np.column_stack([np.repeat(pair[:, 0], n), index.item[at]]), axis=0) if len(at) else np.empty((0, 2), np.int64)
    return np.append(0, np.cumsum(np.bincount(pair[:, 0], minlength=rows))), pair[:, 1]


def find_windows(w: Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(first word, entry) of every window that occurs in the texts: candidates by necessary token, cut by the bounds that
    its position sets (the window must lie within the text), then verified by two independent names."""
    if not len(index.token) or not len(w):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lo = np.searchsorted(index.token, w.h, "left")
    hit = np.flatnonzero(index.token[np.minimum(lo, len(index.token) - 1)] == w.h)
    lo = lo[hit]
    n = np.searchsorted(index.token, w.h[hit], "right") - lo
    place = np.repeat(hit, n)
    entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = place - index.offset[entry]
    row = w.doc[place]
    fits = (start >= w.first[row]) & (start + index.length[entry] <= w.first[row] + w.count[row])
    start, entry = start[fits], entry[fits]
    true = np.zeros(len(start), bool)
    length = index.length[entry]
    for m in np.unique(length):
        of = np.flatnonzero(length == m)
        first, name = w.grams(int(m))
        at = np.searchsorted(first, start[of])
        of, at = of[name[at] == index.name[entry[of]]], at[name[at] == index.name[entry[of]]]
        if len(of):
            _, check = w.grams(int(m), _SALT)
            true[of] = check[at] == index.check[entry[of]]
    return start[true], entry[true]


def covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of n words lie in any [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, start + length, -1)
    return np.cumsum(d[:-1]) > 0


def word_counts(docs: DataFrame, text_col: str, place, size: int) -> np.ndarray:
    """How often words stand in all documents, by the place in [0, size) that ``place`` gives a name (or size, for none);
    summed in the tasks, so at most ``size`` rows for a task are shuffled and reach the driver."""

    def run(batches):
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                total += np.bincount(place(Words(piece.column("text"), NON_WORD, lower=True).h), minlength=size + 1)
        some = np.flatnonzero(total[:size])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])

    out = np.zeros(size, np.int64)
    if size:
        counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        out[np.asarray(counted["place"])] = np.asarray(counted["n"])
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """(id, n_words, n_hit, items) of each document: words inside any occurrence of an item's window, and the items found.

    A window is k consecutive words of an item, or all words of a shorter one; texts are lower-cased (A-Z), words are runs
    of digits, letters and non-ASCII characters. Null and empty texts have no words; items without words have no window;
    repeated rows are judged alike; other columns are not read. ``items`` holds distinct ids in no fixed
    order. Columns to ``carry`` follow the result.

    Up to INDEX_WORDS benchmark words the windows are shipped to the tasks and no document is shuffled; beyond that the
    same filters run in the tasks over tables of bits, and what is left is joined (``contamination_by_join``).
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))

    def words(batches):
        for batch in batches:
            h = [Words(piece.column("text"), NON_WORD, lower=True).h for piece in pieces(batch)]
            yield pa.RecordBatch.from_arrays([signed(np.concatenate([*h, np.empty(0, U64)]))], ["word"])

    own = stage(items.mapInArrow(words, "word long").groupBy("word").agg(F.count(F.lit(1)).alias("n")), "bench-words")
    n = own.agg(F.sum("n")).first()[0] or 0
    if n > INDEX_WORDS:
        unstage(own)
        return contamination_by_join(docs, benchmark, k, id_col, text_col, item_col, item_text_col, carry)
    wanted = np.sort(np.asarray(own.select("word").toArrow()["word"], np.int64).view(U64))
    unstage(own)
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def place(h):
        if not len(known.value):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(known.value, h), len(known.value) - 1)
        return np.where(known.value[at] == h, at, len(known.value))

    counts = docs.sparkSession.sparkContext.broadcast(word_counts(docs, text_col, place, len(wanted)))
    windows = keyed_windows(items, k, lambda h: counts.value[place(h)]).toArrow()
    # of items with a window alone: INDEX_WORDS bounds them too
    ids = windows["item"].combine_chunks().unique()
    shipped = docs.sparkSession.sparkContext.broadcast((build_index(windows, ids).__dict__, ids))
    item_type = items.schema["item"].dataType.simpleString()

    def run(batches):
        fields, ids = shipped.value
        index = Index(**fields)
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                start, entry = find_windows(w, index)
                hit = covered(len(w), start, index.length[entry]) if len(start) else np.zeros(len(w), bool)
                ends, places = found_items(index, w.doc[start], entry, len(w.count))
                found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids.take(pa.array(places)))
                n_hit = np.bincount(w.doc[hit], minlength=len(w.count)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(w.count), pa.array(n_hit), found] + [piece.column(c) for c in names], ["id", "n_words", "n_hit", "items", *names])

    source, names, schema = carried(docs, id_col, text_col, list(carry))
    out = source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, n_words long, n_hit long, items array<{item_type}>{schema}")
    return restored(out, id_col, text_col, list(carry), ["n_words", "n_hit", "items"])


def bit_table(names: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A table of 2^bits bits with one set for each name; its size does not depend on their number. It comes together in the
    tasks, in blocks of 2^16 bits."""
    block, low = 1 << 16, (1 << bits) - 1

    def run(batches):
        for batch in batches:
            at = np.unique(mix(np.asarray(batch.column(0), np.int64).view(U64)) & U64(low)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // block), pa.array(at % block)], ["block", "bit"])

    def pack(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            b, i = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for x in np.unique(b):
                held.setdefault(int(x), np.zeros(block, bool))[i[b == x]] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())], ["block", "bits"])

    rows = names.mapInArrow(run, "block long, bit long").distinct().repartition("block").mapInArrow(pack, "block long, bits binary").toArrow()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, x in zip(rows["block"].to_pylist(), rows["bits"], strict=True):
        out[b * block // 8 : (b + 1) * block // 8] |= np.frombuffer(x.as_buffer(), np.uint8)
    return out


def in_table(table: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = (mix(names) & U64(len(table) * 8 - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def contamination_by_join(docs: DataFrame, benchmark: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """The same for benchmarks too large to ship, with the same cases of nulls, empty texts and tables and repeated rows.

    Each window is under its rarest word, by corpus counts of BUCKETS classes of words (any order gives the same result). In a
    task a document word meets a table of bits of such tokens, the bounds that its position sets for each offset and length,
    and a table of bits of window names; what passes, about one row for each true occurrence, is joined by token, offset,
    length and both names. A row of ``docs`` is known by two names of its id and text.
    """
    bucket = lambda h: (h & U64(BUCKETS - 1)).astype(np.int64)
    counts = docs.sparkSession.sparkContext.broadcast(word_counts(docs, text_col, bucket, BUCKETS))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    item_type = items.schema["item"].dataType.simpleString()
    windows = stage(keyed_windows(items, k, lambda h: counts.value[bucket(h)]), "bench-windows")
    shapes = sorted((r["offset"], r["length"]) for r in windows.select("offset", "length").distinct().collect())
    shipped = docs.sparkSession.sparkContext.broadcast((bit_table(windows.select("token")), bit_table(windows.select("name"))))
    by = ["token", "offset", "length", "name", "check"]

    def occurrences(batches):
        tokens, names = shipped.value
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                place = np.flatnonzero(in_table(tokens, w.h))
                row = w.doc[place]
                keys = [np.asarray(piece.column(c), np.int64) for c in ("k1", "k2")]
                for m in sorted({length for _, length in shapes}):
                    first, name = w.grams(m)
                    _, check = w.grams(m, _SALT)
                    for offset in [o for o, length in shapes if length == m]:
                        start = place - offset
                        fits = (start >= w.first[row]) & (start + m <= w.first[row] + w.count[row])
                        at = np.searchsorted(first, start[fits])
                        token, known = w.h[place[fits]], in_table(names, name[at])
                        at, token = at[known], token[known]
                        doc = w.doc[first[at]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[0][doc]), pa.array(keys[1][doc]), pa.array((first[at] - w.first[doc]).astype(np.int32)), signed(token),
                             pa.array(np.full(len(at), offset, np.int32)), pa.array(np.full(len(at), m, np.int32)), signed(name[at]), signed(check[at])],
                            ["k1", "k2", "at", *by],
                        )

    key = [F.xxhash64(F.lit(i), F.col("id"), F.col("text")).alias(f"k{i}") for i in (1, 2)]
    source, names, schema = carried(docs, id_col, text_col, list(carry))
    keyed = source.select("*", *key) if "text" in source.columns else source
    met = keyed.select("k1", "k2", "text").mapInArrow(occurrences, "k1 long, k2 long, at int, token long, offset int, length int, name long, check long")
    distinct = stage(windows.select(*by).distinct(), "bench-distinct")
    found = stage(met.join(distinct, by).distinct(), "bench-found")
    # how far the windows of a row reach, one after the other
    step = lambda s, x: F.struct(
        (s["n"] + F.greatest(x["at"] + x["length"] - F.greatest(x["at"], s["end"]), F.lit(0))).alias("n"), F.greatest(s["end"], x["at"] + x["length"]).alias("end")
    )
    spans = F.array_sort(F.collect_list(F.struct("at", "length")))
    hit = found.groupBy("k1", "k2").agg(F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step)["n"].alias("n_hit"))
    which = found.join(windows, by).select("k1", "k2", "item").distinct().groupBy("k1", "k2").agg(F.transform(F.collect_list(F.struct("item")), lambda x: x["item"]).alias("items"))
    per = stage(hit.join(which, ["k1", "k2"]), "bench-hit")
    unstage(windows, distinct, found)

    def count(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), NON_WORD, lower=True)
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("k1"), piece.column("k2"), pa.array(w.count)] + [piece.column(c) for c in names], ["id", "k1", "k2", "n_words", *names])

    counts = keyed.mapInArrow(count, f"id {source.schema['id'].dataType.simpleString()}, k1 long, k2 long, n_words long{schema}")
    out = counts.join(per, ["k1", "k2"], "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"), "items": F.coalesce("items", F.array().cast(f"array<{item_type}>"))})
    return restored(out, id_col, text_col, list(carry), ["n_words", "n_hit", "items"])
