"""The shard that owns a video."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_of(video_id: Column) -> Column:
    """``md5(video_id) mod 10`` as INT.

    The digest has 32 hex digits, too many for BIGINT, so it is read as 15 + 15 + 2 digits.
    Every positive power of 16 ends in 6, hence the factor for the two leading pieces.
    """
    digest = F.md5(video_id)

    def piece(start: int, length: int) -> Column:
        return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")

    return ((((piece(1, 15) + piece(16, 15)) % 10) * 6 + piece(31, 2)) % 10).cast("int")
