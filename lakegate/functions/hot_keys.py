"""Finding the first row of a key when one key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lanes the rows of one key are spread over.
LANES = 16384


def with_first_of_key(
    frame: DataFrame, key: str, order: list[str], name: str, lanes: int = LANES
) -> DataFrame:
    """Add the smallest ``struct(order)`` among all rows with the same ``key``.

    The rows of a key never meet in one group. They are spread over lanes by a
    hash of ``order``; an aggregate that combines before its shuffle finds the
    first of every lane, the lanes of a key (at most ``lanes`` rows) are compared
    with each other, and the answer goes back by key *and* lane.
    """
    spread = frame.withColumn("_lane", F.pmod(F.xxhash64(*order), F.lit(lanes)))
    lane_firsts = spread.groupBy(key, "_lane").agg(F.min(F.struct(*order)).alias("_lane_first"))
    firsts = lane_firsts.select(
        key, "_lane", F.min("_lane_first").over(Window.partitionBy(key)).alias(name)
    )
    return spread.join(firsts, [key, "_lane"], "left").drop("_lane")
