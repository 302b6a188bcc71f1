"""Sinks for vectors, recommendations and metrics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Columnar sink (vectors, splits, recommendations)."""
    df.write.mode(mode).parquet(path)


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text part files, one JSON object per row; null fields are kept."""
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    df.select(line.alias("value")).write.mode(mode).text(path)
