"""SQL text over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def over(text: str, **frames: DataFrame) -> DataFrame:
    """The query, with each ``{name}`` standing for the frame of that name."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)
