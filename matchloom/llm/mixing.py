"""Mixing sources to target weights by entropy balancing, built-in functions only."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import stage, unstage

#: No document is taken more often than this, nor a source beyond this multiple of its size.
MOST = 3
#: Newton steps at most, and the relative gap to a target at which they end.
STEPS, GAP = 40, 1e-9
#: Digits of a dual solution.
DIGITS = 9
#: Rounds in which one row of each source takes up what rounding has left over.
FIXES = 4
#: Sources whose tables of a row each may be broadcast or pass through the driver; more are staged and joined.
FEW = 10_000


def words(text):
    """The ``[^\\x20\\x09-\\x0D]+`` of a text."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    # one literal space is split without a regular expression
    return F.array_remove(F.split(text, " ", -1), "")


def n_words(text):
    """Their number; null: 0."""
    return F.coalesce(F.size(words(text)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target): weights by code point order of the sources (null last), repeating; targets share the
    sum of all sizes, none above MOST times its source's size, the excess reshared by weight.

    That is a water level: target = min(cap, weight * level). Sources that reach their cap come first in order of
    cap / weight, so one running sum finds the level. The windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    capped = per.withColumn("weight", pick).withColumn("cap", F.col("source_size") * float(MOST))
    every = W.partitionBy(F.lit(0))
    by_ratio = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    level = (F.sum("source_size").over(every) - (F.sum("cap").over(by_ratio) - F.col("cap"))) / F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    levels = capped.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    found = levels.withColumn("level", F.max("level").over(every))
    return found.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"))


def held(df: DataFrame, few: bool) -> DataFrame:
    """A table of a row or a few for each source, cut from its lineage: up to FEW sources by way of the driver, as a literal of
    the next plan (a local collection would start Python on the executors); beyond that staged."""
    if not few:
        return stage(df, "mix")
    rows = json.dumps([r.asDict() for r in df.collect()])
    return df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(rows), T.ArrayType(df.schema))))


def tilts(hist: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """(source, mean, lam): the dual solution. A document's rate is least(MOST, exp(lam * size / mean)), which minimises
    the relative entropy to rate 1 under sum(rate * size) = target for each source and rate <= MOST.

    ``hist`` is (source, size, docs). Each Newton step is one aggregation of it by source (summed in the tasks first, so
    a hot source is no hot task); a bracket around the root safeguards the steps.
    """
    mean = hist.groupBy("source").agg((F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"))
    goal = targets.select(F.col("source").alias("s"), "target", "source_size")
    # a tilt of 50 mean sizes puts any document that matters at its bound
    state = held(
        mean.join(goal, F.col("source").eqNullSafe(F.col("s"))).select("source", "mean", "target", "source_size",
            F.lit(0.0).alias("lam"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"),
            ((F.col("source_size") <= 0) | (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12))).alias("done")),
        few,
    )
    for _ in range(STEPS):
        open_ = state.where("NOT done").withColumnRenamed("source", "s")
        x = F.try_divide(F.col("size"), F.col("mean"))
        rate = F.least(F.lit(float(MOST)), F.exp(F.least(F.col("lam") * x, F.lit(50.0))))
        moved = hist.join(F.broadcast(open_) if few else open_, F.col("source").eqNullSafe(F.col("s")))
        sums = moved.groupBy("s").agg(
            F.sum(rate * F.col("size") * F.col("docs")).alias("f"),
            F.sum(F.when(rate < MOST, rate * x * F.col("size") * F.col("docs")).otherwise(0.0)).alias("d"),
        )
        at = state.join(sums.withColumnRenamed("s", "t"), F.col("source").eqNullSafe(F.col("t")), "left")
        lo = F.when(F.col("f") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("f") >= F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") + F.try_divide(F.col("target") - F.col("f"), F.col("d"))
        middle = F.when(F.col("hi0") >= 1e6, F.greatest(F.col("lo0") * 2, F.lit(1.0))).when(F.col("lo0") <= -1e6, F.least(F.col("hi0") * 2, F.lit(-1.0))).otherwise((F.col("lo0") + F.col("hi0")) / 2)
        new = at.withColumns({"lo0": lo, "hi0": hi, "step": step}).select(
            "source", "mean", "target", "source_size",
            F.when(F.col("done"), F.col("lam")).when((F.col("d") > 0) & (F.col("step") > F.col("lo0")) & (F.col("step") < F.col("hi0")) & (F.abs(F.col("step") - F.col("lam")) <= 4.0), F.col("step")).otherwise(middle).alias("lam"),
            F.col("lo0").alias("lo"), F.col("hi0").alias("hi"),
            (F.col("done") | (F.abs(F.col("f") - F.col("target")) <= GAP * F.greatest(F.col("target"), F.lit(1.0)))).alias("done"),
            F.col("lam").alias("was"),
        )
        new = new.withColumn("lam", F.when(F.col("done"), F.col("was")).otherwise(F.col("lam"))).drop("was")
        state = held(new, few)
        if not state.where("NOT done").limit(1).count():
            break
    # the last digits depend on the order in which tasks were summed
    lam = F.when(F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12), F.lit(1e9)).otherwise(F.round("lam", DIGITS))
    return state.select("source", "mean", lam.alias("lam"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] = ()) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies, taken) of each row, then the columns to ``carry``.

    ``rate`` is the tilted rate; ``copies`` rounds it up or down by a draw that depends on the row's id, text and source alone,
    so reruns agree; ``taken`` is size * copies, but in a few rows of each source (FIXES at most) whose last copy is cut or
    extended, within 0 and MOST times their size, by what the rounding left over. A null or empty text has size 0 and takes nothing; a null
    source is a source of its own; equal rows get equal draws.
    """
    carry = [c for c in carry if c not in (id_col, source_col)]
    measured = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit("mix"), F.col(id_col), F.col(source_col), F.col(text_col)).alias("key"),
        *(F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)),
    )
    rows = stage(measured.select("id", "source", "size", "key"), "mix-rows")
    hist = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-hist")
    few = hist.select("source").distinct().count() <= FEW
    targets = held(source_targets(hist.select("source", (F.col("size") * F.col("docs")).alias("size")), weights), few)
    duals = tilts(hist, targets, few)
    plan = targets.select(F.col("source").alias("s"), "source_size", "target").join(
        duals.select(F.col("source").alias("s2"), "mean", "lam"), F.col("s").eqNullSafe(F.col("s2"))
    ).drop("s2")
    plan = held(plan, few)
    unstage(hist)
    bound = F.broadcast(plan) if few else plan
    exponent = F.least(F.try_divide(F.col("lam") * F.col("size"), F.col("mean")), F.lit(50.0))
    draw = F.pmod(F.col("key"), F.lit(1 << 40)) / float(1 << 40)

    def rate(of):
        out = of.join(bound, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(float(MOST)), F.exp(exponent))))
        return out.withColumn("copies", F.least(F.floor(F.col("rate") + draw), F.lit(MOST)).cast("long")).drop("s", "mean", "lam")

    rated = rate(rows)
    whole = F.col("size") * F.col("copies")
    taken = whole + F.coalesce("by", F.lit(0))
    at_fix = F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("fixed"))
    adjusted = None
    for _ in range(FIXES):
        now = rated.withColumn("by", F.lit(0)) if adjusted is None else rated.join(F.broadcast(adjusted) if few else adjusted, at_fix, "left").drop("s", "fixed")
        left = now.groupBy("source").agg(
            (F.round(F.max("target")) - F.sum(taken)).cast("long").alias("left"),
            F.max(F.struct(taken.alias("most"), F.col("key"))).alias("cut"),
            F.max(F.struct((F.col("size") * MOST - taken).alias("most"), F.col("key"))).alias("add"),
        )
        fix = held(
            left.where("left <> 0").select(
                F.col("source").alias("s"),
                F.when(F.col("left") < 0, F.greatest(F.col("left"), -F.col("cut.most"))).otherwise(F.least(F.col("left"), F.col("add.most"))).alias("by"),
                F.when(F.col("left") < 0, F.col("cut.key")).otherwise(F.col("add.key")).alias("fixed"),
            ),
            few,
        )
        # repeated rows share what one row would take
        same = rated.join(F.broadcast(fix) if few else fix, at_fix).groupBy("s", "fixed").agg(F.count(F.lit(1)).alias("same"))
        same = same.withColumnsRenamed({"s": "t", "fixed": "f"})
        shared = fix.join(same, F.col("s").eqNullSafe(F.col("t")) & (F.col("fixed") == F.col("f"))).select("s", "fixed", (F.col("by") / F.col("same")).cast("long").alias("by"))
        shared = shared.where("by <> 0")
        if adjusted is not None:
            shared = shared.union(adjusted.select("s", "fixed", "by")).groupBy("s", "fixed").agg(F.sum("by").alias("by"))
        adjusted = held(shared, few)
        if not fix.where("by <> 0").limit(1).count():
            break
    if carry:
        unstage(rows)
    out = (rate(measured) if carry else rated).join(F.broadcast(adjusted) if few else adjusted, at_fix, "left")
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", "copies",
        taken.cast("long").alias("taken"), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)),
    )
