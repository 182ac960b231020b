"""S1 records that arrive as a stream, matched against a fixed index: stateless, so no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import MatchConfig
from ..operators.blocking import Blocker
from ..operators.features import pair_features
from ..operators.records import normalize_records
from ..operators.scoring import assemble, score_pairs


def match_arrivals(arrivals: DataFrame, blocker: Blocker, out: str, checkpoint: str, threshold: float | None = None, model=None, config: MatchConfig = MatchConfig()) -> StreamingQuery:
    """Match each micro-batch of raw S1 records (streaming, with ordinal) and append the result rows as Parquet.

    Files are written by batch number, so a batch that runs again replaces its own rows. The blocker's index is built with
    the first batch and held; release it when the query has ended.
    """
    blocker.keep()
    cut = config.fallback_threshold if threshold is None else threshold

    def match(batch: DataFrame, number: int) -> None:
        scored = score_pairs(pair_features(blocker.candidates(normalize_records(batch)), config), model)
        assemble(batch, scored, cut).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrivals.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
