"""Inner joins in which one key may hold a large share of one side's rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import write_once

# Rows of one key that one task is asked to join.
HEAVY_ROWS = 1_000_000


def heavy_keys(rows: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame | None:
    """(key, _salts) of the keys with more than ``heavy_rows`` rows, or None.

    Counts are pre-aggregated, and there are at most rows / heavy_rows such keys, so the
    table may be broadcast. A table of no more than ``heavy_rows`` rows is not counted by key.
    """
    if rows.count() <= heavy_rows:
        return None
    counted = rows.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > heavy_rows)
    found = write_once(counted.select(key, F.ceil(F.col("_rows") / heavy_rows).cast("int").alias("_salts")), "heavy-keys")
    return None if found.isEmpty() else found


def join_heavy(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame | None) -> DataFrame:
    """``left`` inner join ``right`` on ``key``; rows of ``heavy`` keys are split over salts.

    The split follows a hash of the left row, so a task that runs again deals alike; the right
    side is repeated for the heavy keys only. Null keys match nothing.
    """
    if heavy is None:
        return left.join(right, key)
    salts = F.coalesce("_salts", F.lit(1))
    dealt = left.join(F.broadcast(heavy), key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int")
    )
    repeated = right.join(F.broadcast(heavy), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"]).drop("_salt")
