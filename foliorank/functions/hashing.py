"""Repeatable draws: every random choice is a hash of a seed and the row's keys.

A task that runs again after an executor is lost draws the same rows, so train
and test sets, samples and negatives never disagree between stages.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Draws are the first 32 bits of the digest.
DRAW_RANGE = 1 << 32


def draw_key(seed: int | str, *columns: str) -> Column:
    """Hex digest of the seed and the columns; its order is a random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def draw_int(key: Column) -> Column:
    """The digest's first 32 bits as a number; grows with the digest."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
