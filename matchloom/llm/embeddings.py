"""Embedding near-duplicates: an epsilon grid order join over blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import components, stage, unstage

#: Vectors whose directions fix the principal axes (a bounded sample; any axes give the same result), leading axes that
#: the grid order uses, axes that bound distances, and vectors in a block at most (8 MB of 128 doubles each).
SAMPLE, GRID, BOUND, BLOCK = 4096, 4, 12, 8192
#: Range partitions at most; each holds as many blocks as it needs.
PARTS = 20_000


def principal_axes(unit: DataFrame, dim: int, first: int) -> np.ndarray:
    """The ``first`` of the orthonormal axes, widest spread first, from SAMPLE vectors chosen by hash."""
    rows = unit.orderBy(F.xxhash64("v")).limit(SAMPLE).select("v").collect()
    x = np.frombuffer(b"".join(bytes(r["v"]) for r in rows), np.float64).reshape(-1, dim)
    _, axes = np.linalg.eigh(np.cov(x, rowvar=False) if len(x) > 1 else np.eye(dim))
    return np.ascontiguousarray(axes[:, ::-1][:, :first])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex it is connected to) of every vertex but the smallest ones: n - 1 edges at most, which
    connect what the given edges connect."""
    low = np.arange(n)
    while True:
        m = low.copy()
        np.minimum.at(m, a, low[b])
        np.minimum.at(m, b, low[a])
        m = m[m]
        if (m == low).all():
            break
        low = m
    v = np.flatnonzero(low != np.arange(n))
    return v, low[v]


def near_pairs(x: np.ndarray, y: np.ndarray, xp: np.ndarray, yp: np.ndarray, least: float, eps: float, leaf: int = 128):
    """(i, j) with x[i] . y[j] >= least, by recursive halves of both sequences; halves whose boxes on the leading axes lie
    farther apart than eps are skipped."""
    out_i, out_j = [], []
    boxes: dict = {}

    def box(side, p, a, b):
        if (side, a, b) not in boxes:
            boxes[side, a, b] = p[a:b].min(0), p[a:b].max(0)
        return boxes[side, a, b]

    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        (xl, xh), (yl, yh) = box(0, xp, a, b), box(1, yp, c, d)
        gap = np.maximum(0, np.maximum(xl - yh, yl - xh))
        if gap @ gap > eps * eps:
            continue
        if b - a <= leaf and d - c <= leaf:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= least)
            out_i.append(i + a)
            out_j.append(j + c)
            continue
        halves = [(a, b)] if b - a <= leaf else [(a, (a + b) // 2), ((a + b) // 2, b)]
        others = [(c, d)] if d - c <= leaf else [(c, (c + d) // 2), ((c + d) // 2, d)]
        todo += [(*h, *o) for h in halves for o in others]
    if not out_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component) of each row: other rows whose cosine (double precision) reaches ``least``, and the smallest
    id reachable by links, itself included.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths with each other. Equal vectors are joined once, weighted by their number, so a vector that a third
    of the rows hold costs as much as one; repeated rows (also of one id) link with each other; a null id keeps its own
    links and counts as no smallest id.

    Distinct unit vectors are sorted by grid cells of width eps on the leading principal axes and cut into blocks of BLOCK;
    pairs of blocks whose boxes on BOUND axes are within eps are joined, each pair once, in halves recursively. A task
    gives link counts and a spanning forest of its links, never all pairs of a group. How much is skipped depends on the
    vectors: on clustered ones or few dimensions most pairs are, on ones that spread evenly over many dimensions none
    (boxes there overlap on every axis; see the README's figures).
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    source = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("e"))

    fine = (F.size("e") > 0) & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def pack(batches):
        for batch in batches:
            v = batch.column("e")
            flat = np.asarray(v.flatten(), np.float64)
            n = v.value_lengths().to_numpy()
            ends = np.cumsum(n)
            rows = []
            for a, b in zip(ends - n, ends, strict=True):
                x = flat[a:b]
                top = np.abs(x).max()
                x = x / top
                rows.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], ["id", "v"])

    id_type = source.schema["id"].dataType.simpleString()
    good = source.where(F.coalesce(fine, F.lit(False)) & F.exists("e", lambda x: x != 0)).mapInArrow(pack, f"id {id_type}, v binary")
    good = stage(good.withColumn("dim", (F.length("v") / 8).cast("int")).withColumn("key", F.xxhash64("v")), "vec")
    distinct = stage(good.groupBy("key", "v", "dim").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")), "vec-distinct")
    counts = edges = None
    found = []
    for dim in sorted(r["dim"] for r in distinct.select("dim").distinct().collect()):
        found.append(join_blocks(distinct.where(F.col("dim") == dim), dim, least, eps))
        c, e = found[-1].where("to IS NULL").select("key", "n"), found[-1].where("to IS NOT NULL").select(F.col("key").alias("a"), F.col("to").alias("b"))
        counts, edges = (c, e) if counts is None else (counts.union(c), edges.union(e))
    all_rows = source.select("id")
    if counts is None:
        return all_rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    counts = stage(counts.groupBy("key").agg(F.sum("n").alias("n")), "vec-counts")
    labels = stage(components(edges), "vec-components")
    labelled = stage(distinct.select("key", "least_id", "copies").join(labels.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("component", "key")).drop("component"), "vec-labels")
    smallest = stage(labelled.groupBy("root").agg(F.min("least_id").alias("component")), "vec-roots")
    result = labelled.join(smallest, "root").join(counts, "key", "left").select("key", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    result = stage(result, "vec-result")
    unstage(distinct, counts, labels, labelled, smallest, *found)
    linked = good.select("id", "key").join(result, "key").select("id", "n_links", "component")
    rest = source.where(~(F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists("e", lambda x: x != 0), F.lit(False)))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(rest).select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def block_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """(a, b), a <= b, of the blocks whose boxes lie within eps of each other, each pair once.

    Boxes meet in cells of width 2 eps of the first two axes (one side widened by eps), where only the first cell that both
    reach counts; then the gap on all axes is measured. A cell that many boxes reach is a hot key of a join of plain scans,
    which adaptive execution splits.
    """
    cell = lambda c, i, d: F.floor((F.get(c, i) + d) / (2 * eps))

    def cells(c, d, names):
        lo, hi, out = f"{c}l", f"{c}h", f"{c}_"
        from_ = [F.coalesce(cell(lo, i, -d), F.lit(0)) for i in (0, 1)]
        to = [F.coalesce(cell(hi, i, d), F.lit(0)) for i in (0, 1)]
        every = F.flatten(F.transform(F.sequence(from_[0], to[0]), lambda i: F.transform(F.sequence(from_[1], to[1]), lambda j: F.struct(i.alias("i"), j.alias("j")))))
        df = boxes.select(F.col("block").alias(c), F.col("lo").alias(lo), F.col("hi").alias(hi))
        return df.select("*", from_[0].alias(f"{out}i"), from_[1].alias(f"{out}j"), F.explode(every).alias(names)).select("*", f"{names}.*").drop(names)

    gap = F.aggregate(
        F.zip_with(F.zip_with("al", "bh", lambda x, y: x - y), F.zip_with("bl", "ah", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))),
        F.lit(0.0), lambda s, x: s + x * x,
    )
    met = cells("a", eps, "cell_a").join(cells("b", 0.0, "cell_b"), ["i", "j"])
    first = (F.col("i") == F.greatest("a_i", "b_i")) & (F.col("j") == F.greatest("a_j", "b_j"))
    return met.where(first & (F.col("a") <= F.col("b")) & (gap <= eps * eps)).select("a", "b")


def join_blocks(distinct: DataFrame, dim: int, least: float, eps: float) -> DataFrame:
    """(key, n, to) among distinct unit vectors of one length: link counts (to null) and spanning edges (key, to)."""
    spark = distinct.sparkSession
    grid, bound = min(GRID, dim), min(BOUND, dim)
    shipped = spark.sparkContext.broadcast(principal_axes(distinct, dim, max(grid, bound)))

    def place(batches):
        axes = shipped.value[:, :grid]
        for batch in batches:
            x = np.frombuffer(b"".join(v.as_py() for v in batch.column("v")), np.float64).reshape(-1, dim) if len(batch) else np.empty((0, dim))
            cells = np.floor((x @ axes) / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("v"), batch.column("copies"), *(pa.array(cells[:, i]) for i in range(grid))], ["key", "v", "copies", *(f"g{i}" for i in range(grid))])

    schema = "key long, v binary, copies long, " + ", ".join(f"g{i} int" for i in range(grid))
    order = [f"g{i}" for i in range(grid)] + ["key"]
    parts = min(PARTS, max(1, -(-distinct.count() // BLOCK)))
    placed = distinct.select("key", "v", "copies").mapInArrow(place, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def block(batches):
        """Blocks of BLOCK vectors at most in grid order, each with its box on the leading axes."""
        from pyspark import TaskContext

        axes = shipped.value[:, :bound]
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        size = k = 0

        def full():
            t = pa.Table.from_batches(held)
            x = np.frombuffer(b"".join(v.as_py() for v in t["v"]), np.float64).reshape(-1, dim)
            p = x @ axes
            own = [np.asarray(t[c], np.int64).tobytes() for c in ("key", "copies")] + [x.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k], pa.int64()), *(pa.array([v], pa.binary()) for v in own), *(pa.array([v.tolist()], pa.list_(pa.float64())) for v in (p.min(0), p.max(0)))],
                ["block", "keys", "copies", "x", "lo", "hi"],
            )

        for batch in batches:
            while len(batch):
                take = min(len(batch), BLOCK - size)
                held.append(batch.slice(0, take))
                batch, size = batch.slice(take), size + take
                if size == BLOCK:
                    yield full()
                    held, size, k = [], 0, k + 1
        if size:
            yield full()

    schema = "block long, keys binary, copies binary, x binary, lo array<double>, hi array<double>"
    short = stage(placed.select("key", "v", "copies").mapInArrow(block, schema), "vec-parts")
    # partitions come out uneven: neighbouring short blocks become one, by the running size of the partitions (PARTS rows at most)
    sizes = sorted((r["part"], r["n"]) for r in short.groupBy(F.shiftright("block", 32).alias("part")).agg(F.sum(F.length("keys") / 8).cast("long").alias("n")).collect())
    before, running = [], 0
    for part, n in sizes:
        before.append((part, running))
        running += n
    starts = spark.createDataFrame(before, "part long, before long")
    whole = F.floor((F.col("before") + F.col("block").bitwiseAND((1 << 32) - 1) * BLOCK) / BLOCK)
    dealt = short.join(F.broadcast(starts), F.shiftright("block", 32) == F.col("part")).withColumn("whole", whole)

    def merge(batches):
        held: list[dict] = []

        def done():
            own = [b"".join(r[c] for r in held) for c in ("keys", "copies", "x")]
            box = [np.array([r["lo"] for r in held]).min(0).tolist(), np.array([r["hi"] for r in held]).max(0).tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0]["whole"]], pa.int64()), *(pa.array([v], pa.binary()) for v in own), *(pa.array([v], pa.list_(pa.float64())) for v in box)],
                ["block", "keys", "copies", "x", "lo", "hi"],
            )

        for batch in batches:
            for r in (x for i in range(len(batch)) for x in batch.slice(i, 1).to_pylist()):
                if held and held[0]["whole"] != r["whole"]:
                    yield done()
                    held = []
                held.append(r)
        if held:
            yield done()

    ordered = dealt.repartition("whole").sortWithinPartitions("whole", "block").select("whole", "keys", "copies", "x", "lo", "hi")
    blocks = stage(ordered.mapInArrow(merge, schema), "vec-blocks")
    pairs = stage(block_pairs(blocks.select("block", "lo", "hi"), eps), "vec-pairs")
    left = blocks.select(F.col("block").alias("a"), F.col("keys").alias("ak"), F.col("copies").alias("ac"), F.col("x").alias("ax"))
    right = blocks.select(F.col("block").alias("b"), F.col("keys").alias("bk"), F.col("copies").alias("bc"), F.col("x").alias("bx"))
    joined = pairs.join(left, "a").join(right, "b")

    def compare(batches):
        axes = shipped.value[:, :bound]
        for batch in batches:
            for r in range(len(batch)):
                get = lambda c, t: np.frombuffer(batch.column(c)[r].as_py(), t)  # noqa: B023, E731
                ak, ac, x = get("ak", np.int64), get("ac", np.int64), get("ax", np.float64).reshape(-1, dim)
                bk, bc, y = get("bk", np.int64), get("bc", np.int64), get("bx", np.float64).reshape(-1, dim)
                i, j = near_pairs(x, y, x @ axes, y @ axes, least, eps)
                same = batch.column("a")[r].as_py() == batch.column("b")[r].as_py()
                if same:
                    keep = i < j
                    i, j = i[keep], j[keep]
                if not len(i):
                    continue
                na, nb = np.bincount(i, bc[j], len(ak)), np.bincount(j, ac[i], len(bk))
                tree = forest(len(ak) + len(bk), i, j if same else j + len(ak))
                every = np.concatenate([ak, bk])
                ea, eb = every[tree[0]], every[tree[1]]
                ka, kb = np.flatnonzero(na), np.flatnonzero(nb)
                keys = np.concatenate([ak[ka], bk[kb], ea])
                count = np.concatenate([na[ka], nb[kb], np.zeros(len(ea))]).astype(np.int64)
                to = pa.array(np.concatenate([np.zeros(len(ka) + len(kb), np.int64), eb]), mask=np.arange(len(keys)) < len(ka) + len(kb))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(count), to], ["key", "n", "to"])

    found = stage(joined.mapInArrow(compare, "key long, n long, to long"), "vec-links")
    unstage(short, blocks, pairs)
    return found
