"""Small expressions and helpers that several operators share."""

import gc
import time
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliorank.storage import new_table_path

# A word is a run of characters other than these six.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lower_ascii(text: str | Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's content: rows that repeat share it, and share results."""
    return F.xxhash64(*[F.struct(F.col(c), F.col(c).isNull()) for c in columns])


class Scratch:
    """Intermediate tables of one operator in the shared folder, dropped as soon as they are used up.

    A dropped step's shuffle files go as well: Spark's cleaner deletes them once the
    driver has collected the plans that made them, which ``drop`` asks it to do. So the
    disk holds one step at a time and not the sum of all.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, new_table_path(spark, name), {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, clean: bool = True) -> None:
        """Delete steps; without ``clean`` their shuffle files wait for a later call."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            for path in self.paths.pop(name, []):
                found = jvm.org.apache.hadoop.fs.Path(path)
                found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
        if not clean:
            return
        # The first round lets go of Python's handles, the second of what they held.
        for _ in range(2):
            gc.collect()
            jvm.System.gc()
            time.sleep(0.2)


def text_slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text; a longer text stands alone."""
    offsets = text_offsets(texts)
    start, rows = 0, len(texts)
    while start < rows:
        stop = int(offsets.searchsorted(offsets[start] + max_bytes, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def text_offsets(texts: pa.Array):
    """Byte offsets of the rows of a string array inside its data buffer."""
    import numpy as np

    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    buffer = texts.buffers()[1]
    if buffer is None or buffer.size == 0:
        return np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buffer, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array):
    """All bytes of a string array and each row's offsets in them; null rows are empty."""
    import numpy as np

    offsets = text_offsets(texts)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def components(links: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links: one row (node, component) per linked node.

    ``component`` is the smallest node reachable. Each round gives every node the
    smallest label among its neighbours and then the label of that label, so
    long chains shrink quickly. Labels are written once a round, which cuts the
    lineage; groupings are pre-aggregated, and a hot node costs one row per task.
    No links give no rows.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = scratch.write(
        links.select(F.col(left).alias("node"), F.col(right).alias("other"))
        .where("node <> other")
        .distinct(),
        "edges",
    )
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    labels = scratch.write(
        both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels"
    )
    if labels.isEmpty():
        return labels
    for _ in range(max_rounds):
        near = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        own = labels.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("near")
        )
        jumped = labels.select(F.col("node").alias("near"), F.col("component").alias("further"))
        found = scratch.write(
            own.join(jumped, "near", "left").select(
                "node",
                F.least("near", F.coalesce("further", "near")).alias("component"),
                (F.least("near", F.coalesce("further", "near")) != F.col("component")).alias("moved"),
            ),
            "labels",
        )
        labels = found.drop("moved")
        if found.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def in_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, so that extra ones cannot clash with working names."""
    return df.select(*[df[n] for n in names])
