"""Spans in texts: their Arrow type, their digest columns, and a mapper from texts to spans."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SPANS_DDL = "array<struct<kind:string,start:int,end:int>>"


class Intervals:
    """Half-open intervals, merged, to be asked in logarithmic time."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.start: list[int] = []
        self.end: list[int] = []
        for s, e in sorted(spans):
            if self.end and s <= self.end[-1]:
                self.end[-1] = max(self.end[-1], e)
            else:
                self.start.append(s)
                self.end.append(e)

    def within(self, start: int, end: int) -> list[tuple[int, int]]:
        """Those that share a place with [start, end), in order."""
        lo, hi = bisect_right(self.end, start), bisect_left(self.start, end)
        return list(zip(self.start[lo:hi], self.end[lo:hi], strict=True))

    def touch(self, start: int, end: int) -> bool:
        return bisect_right(self.end, start) < bisect_left(self.start, end)


def map_spans(docs: DataFrame, find: Callable[[str], Iterable[tuple[str, int, int]]], id_col: str, text_col: str) -> DataFrame:
    """(id, spans): the spans that ``find`` gives for each whole text, in code points, end exclusive; a null text is empty."""

    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(SPAN))], ["id", "spans"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, spans {SPANS_DDL}").withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def digest(df: DataFrame, id_col: str, base: list[str]) -> DataFrame:
    """id, n_<kind> of each base kind, base_sha256 and spans as the contracts of the span queries have them."""
    return df.select(
        id_col,
        *(F.size(of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(joined(of_kinds(F.col("spans"), base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
