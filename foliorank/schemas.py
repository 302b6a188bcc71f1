"""File schemas and the column names used across the package."""

from pyspark.sql import types as T

# The column order and types of the headerless papers CSV.
PAPERS_SCHEMA = T.StructType(
    [
        T.StructField("paper_id", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("journal", T.StringType()),
        T.StructField("book_title", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("publisher", T.StringType()),
        T.StructField("pages", T.IntegerType()),
        T.StructField("volume", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("postedat", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
    ]
)

# Separators of a library line, "user;paper,paper,...".
USER_SEPARATOR = ";"
PAPER_SEPARATOR = ","

USER = "user_id"
PAPER = "paper_id"
