"""Random-looking numbers that depend on the row, not on the partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = float(2**32)


def hash_uniform(key: Column | str, seed: int | str) -> Column:
    """A DOUBLE in [0, 1) from a row key and a seed; the same on every run and any partitioning."""
    text = F.concat_ws("|", F.col(key) if isinstance(key, str) else key, F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10)
    return head.cast("double") / F.lit(HASH_RANGE)


def row_key(*columns: str) -> Column:
    """One text key from identity columns; timestamps by microsecond."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns])
