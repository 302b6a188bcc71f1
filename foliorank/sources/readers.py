"""Readers of the input files and of saved tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAPER_SEPARATOR, PAPERS_SCHEMA, USER_SEPARATOR

# A stop list travels inside the plan as literals, so its length is checked.
MAX_STOPWORDS = 50_000


def scan_papers(spark: SparkSession, path: str, multi_line: bool = False, **options) -> DataFrame:
    """Headerless papers CSV with the fixed 15-column schema.

    Quoting is that of Spark's CSV reader: text in ``"``, a quote inside as ``\\"``. For files
    that double a quote instead, pass ``escape='"'``; other ``options`` are also
    the reader's. With ``multi_line`` quoted text may hold line breaks; a file is then
    read by one task, so cut large inputs into several files.
    """
    return _papers(spark, path, PAPERS_SCHEMA, multi_line, options)


def scan_papers_features(spark: SparkSession, path: str, multi_line: bool = False, **options) -> DataFrame:
    """The same file for classification: pages and year as floating-point numbers."""
    numbers = {"pages": T.FloatType(), "year": T.FloatType()}
    fields = [T.StructField(f.name, numbers.get(f.name, f.dataType)) for f in PAPERS_SCHEMA]
    return _papers(spark, path, T.StructType(fields), multi_line, options)


def _papers(spark, path, schema, multi_line, options) -> DataFrame:
    settings = {"header": False, "multiLine": multi_line, **options}
    return spark.read.schema(schema).options(**settings).csv(path)


def scan_libraries(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``user;paper,paper,...`` as (user_id, paper_ids).

    A line without the separator, or with nothing behind it, is a user with an empty list.
    """
    fields = F.split("value", USER_SEPARATOR)
    papers = F.coalesce(F.get(fields, 1), F.lit(""))
    return spark.read.text(path).select(
        F.get(fields, 0).alias("user_id"),
        F.filter(F.split(papers, PAPER_SEPARATOR), lambda p: p != "").alias("paper_ids"),
    )


def scan_stopwords(spark: SparkSession, path: str, max_words: int = MAX_STOPWORDS) -> list[str]:
    """One word per line, as a list; refuses a file of more than ``max_words`` lines."""
    rows = spark.read.text(path).limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"{path} has more than {max_words} lines; raise max_words to read it")
    return [row.value for row in rows]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table saved by ``write_table``."""
    return spark.read.parquet(path)
