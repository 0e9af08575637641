"""Incremental mode: a stream of identifier rows upserted into a table, already known keys skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from folioforge.operators import relational as rel
from folioforge.plans import stages


def process_new(batch: DataFrame, known: DataFrame, key: str = "slug") -> DataFrame:
    """The first row of each key of a batch that the known table lacks."""
    return rel.delete_keys(rel.keep_first(stages.normalize(batch), [key]), known, [key])


def run(stream: DataFrame, load: Callable[[], DataFrame], append: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is normalised, reduced to new keys and handed to append with its number, which makes a repeat harmless."""
    return stream.writeStream.foreachBatch(lambda batch, n: append(process_new(batch, load()), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
