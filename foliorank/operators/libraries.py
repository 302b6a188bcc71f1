"""User libraries: explode, count, sample, split, number and exclude."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw_key
from .grouping import CELL_ROWS, dense_index, hash_cell, position_in_group

TEST_SHARE = 0.2


def explode_library(libraries: DataFrame) -> DataFrame:
    """(user_id, paper_ids) as one row per user and paper."""
    return libraries.select("user_id", F.explode("paper_ids").alias("paper_id"))


def nested_library_size(libraries: DataFrame) -> DataFrame:
    """(user_id, paper_ids) with the length of the list."""
    return libraries.withColumn("library_size", F.size("paper_ids").cast("bigint"))


def library_size(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("library_size"))


def filter_user(pairs: DataFrame, user_id) -> DataFrame:
    return pairs.filter(F.col("user_id") == F.lit(user_id))


def users_above(pairs: DataFrame, size: int = 20) -> DataFrame:
    """Users with more than ``size`` papers, strictly."""
    return library_size(pairs).filter(F.col("library_size") > size)


def restrict_to_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    return rows.join(users.select("user_id"), "user_id", "left_semi")


def sample_users(pairs: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` users in the order of their draws; a top-n, not a global sort."""
    drawn = pairs.select("user_id").distinct().withColumn("_draw", draw_key(seed, "user_id"))
    return drawn.orderBy("_draw", "user_id").limit(n).drop("_draw")


def _test_rows(size: Column) -> Column:
    # The test part is rounded up: ceil(size / 5) in whole numbers.
    parts = round(1 / TEST_SHARE)
    return F.floor((size + (parts - 1)) / parts)


def split_train_test(pairs: DataFrame, seed: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``is_test``: per user the first fifth (rounded up) in draw order.

    A user whose library outgrows one cell is cut into ranges of the draw, so no
    task sorts more than about ``cell_rows`` rows of one user. There are at most
    rows / cell_rows such users.
    """
    large = (
        library_size(pairs)
        .filter(F.col("library_size") > cell_rows)
        .select("user_id", F.ceil(F.col("library_size") / cell_rows).alias("_cells"))
    )
    drawn = pairs.withColumn("_draw", draw_key(seed, "user_id", "paper_id")).join(
        large, "user_id", "left"
    )
    cell = hash_cell(F.col("_draw"), F.coalesce("_cells", F.lit(1)))
    placed = position_in_group(drawn, ["user_id"], cell, ["_draw", "paper_id"])
    is_test = F.col("position") <= _test_rows(F.col("group_size"))
    return placed.select("user_id", "paper_id", is_test.alias("is_test"))


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(~F.col("is_test")).drop("is_test")


def held_out_part(split: DataFrame) -> DataFrame:
    return split.filter("is_test").drop("is_test")


def split_rows(
    df: DataFrame, keys: list[str], seed: int, train_share: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Row split by the draw of the row's keys: the same rows on every run."""
    first_bits = F.conv(F.substring(draw_key(seed, *keys), 1, 8), 16, 10).cast("double")
    in_train = first_bits < F.lit(train_share * (1 << 32))
    return df.filter(in_train), df.filter(~in_train)


def exclude_seen(rows: DataFrame, train: DataFrame) -> DataFrame:
    """Drop (user, paper) pairs of the train part; test papers stay."""
    return rows.join(train.select("user_id", "paper_id"), ["user_id", "paper_id"], "left_anti")


def assign_user_ids(pairs: DataFrame) -> DataFrame:
    """One whole number from 0 per distinct user, without gaps."""
    return dense_index(pairs, "user_id", "user_idx")
