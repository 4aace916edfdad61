"""Deduplication of a stream of paragraphs, an extension beyond the batch operators.

The first to arrive survives, so this can't follow source priorities; with an event-time column and a
delay the state is bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.text import clean_chunk
from kaghamar.operators.corpus import MIN_CHARS


def first_arrivals(stream: DataFrame, text: str = "text", event_time: str | None = None, delay: str = "1 day", keep: str | None = None) -> DataFrame:
    """Cleaned paragraphs that are long enough and new."""
    rows = stream.withColumn("clean", clean_chunk(F.col(text), keep) if keep else clean_chunk(F.col(text)))
    rows = rows.filter(F.length("clean") >= MIN_CHARS).withColumn("digest", F.md5("clean"))
    if event_time is None:
        return rows.dropDuplicates(["digest"])
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["digest"])
