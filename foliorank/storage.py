"""Intermediate tables in the shared folder of the cluster.

A plan that is read more than once (token lists, term counts, a train/test
split) is written once and read back. That cuts the lineage, survives the loss
of executors, and gives the planner the real size of the table, so that it
broadcasts a side only when the measured size allows it.
"""

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_written: list[str] = []
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one on local masters."""
    global _local_folder
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="foliorank-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_table_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/foliorank/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def new_byte_folder(spark: SparkSession, name: str) -> str | None:
    """An empty folder beside the tables whose files tasks open by ``pyarrow.fs``; None where that cannot reach it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new_table_path(spark, name))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = system.makeQualified(path).toUri().toString()
    try:
        opened, place = fs.FileSystem.from_uri(folder)
        opened.create_dir(place)
        found = opened.get_file_info(place).type == fs.FileType.Directory and system.exists(path)
    except (pa.ArrowException, OSError):
        return None
    return folder if found else None


def drop_written_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process, once their results are saved."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = hadoop.Path(_written.pop())
        path.getFileSystem(configuration).delete(path, True)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Run the plan of ``df`` once, keep its rows as a table, return that table."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores; a large scan stays as it is.

    Text work is CPU-bound, so a single small file would keep one core busy.
    The shuffle happens only when the whole input has fewer file splits than the
    cluster has cores, so its size is bounded by cores x split size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
