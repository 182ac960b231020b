"""Helpers shared by the training-data operators: stages on shared storage, bounded broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a one- or two-long-column table that may be broadcast (at most 16 MB); larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Rows of a two-long-column table that one task writes at least, where a bound on its rows is known.
TASK_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the session's ``spark.checkpoint.dir``; a temporary one only where it is unset
    and all runs in one process. On a cluster without the setting this raises, as files in local folders would be lost."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="matchloom-"))
        at = spark.sparkContext.getCheckpointDir()
    return at


def stage(df: DataFrame, tag: str = "stage", rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    This cuts the lineage, survives a lost executor, and gives later joins plain exchanges over a scan of known size,
    which adaptive execution can split when one key is hot and broadcast when the table is small. With a bound ``rows`` on
    the rows, a small table is written by few tasks, however many partitions it was computed in.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // TASK_ROWS)))
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/matchloom-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    for held in _SCOPES.get():
        held.append(out)
    return out


#: Open scopes of this thread; others have their own.
_SCOPES: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("scopes", default=())


@contextmanager
def scope():
    """A list that gathers the tables that this thread stages within; those still in it at the end are deleted. Remove what is to stay."""
    held: list[DataFrame] = []
    token = _SCOPES.set((*_SCOPES.get(), held))
    try:
        yield held
    finally:
        _SCOPES.reset(token)
        unstage(*held)


def staged_alone(make, tag: str) -> DataFrame:
    """The staged result of ``make()``; all that was staged on the way is deleted."""
    with scope() as held:
        out = stage(make(), tag)
        held[:] = [x for x in held if x is not out]
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let Spark drop the shuffle files behind them."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def carried(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> tuple[DataFrame, list[str], str]:
    """(id, text, _c0, _c1, ...) of a table, the names of the carried columns but the text, and their schema.

    A text that is carried travels once, as ``text``; names of other columns cannot clash with an operator's own.
    """
    others = [c for c in carry if c != text_col]
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(others)))
    names = [f"_c{i}" for i in range(len(others))] + (["text"] if text_col in carry else [])
    schema = "".join(f", {n} {source.schema[n].dataType.simpleString()}" for n in names)
    return source, names, schema


def restored(out: DataFrame, id_col: str, text_col: str, carry: list[str], own: list[str]) -> DataFrame:
    """The operator's own columns under their names, then the carried ones under theirs."""
    others = [c for c in carry if c != text_col]
    return out.select(
        F.col("id").alias(id_col), *own, *(F.col(f"_c{others.index(c)}" if c != text_col else "text").alias(c) for c in carry if c != id_col)
    )


def semi_join(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (staged): a broadcast up to BROADCAST_ROWS keys, a shuffle beyond."""
    ids = ids.select(*on).distinct()
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, on, "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long, undirected) as (id, component): the smallest id reachable.

    Alternating large-star and small-star rounds; every round is two aggregations and two joins, all distributed.
    A vertex without edges is not in the result. Self-loops and repeated edges change nothing. n edges have at most 2 n vertices, and
    a round makes no more edges of them, so its tables are written by as many tasks as those numbers need.
    """
    e = stage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "cc",
    )
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())
        state, n = now, now[0]
        both = e.union(e.select("v", "u"))
        m = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "cc", 2 * n)
        large = stage(both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc", n)
        m2 = stage(large.groupBy("u").agg(F.min("v").alias("m")), "cc", n)
        small = stage(
            large.join(m2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m2.select("u", "m")).distinct(), "cc", 2 * n
        )
        unstage(e, m, large, m2)
        e = small
