"""Rated and unrated (user, paper) pairs for classification."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw_int, draw_key
from ..storage import write_once
from .grouping import CELL_ROWS, dense_index, position_in_group
from .libraries import exclude_seen, library_size

# Steps one row may expand to; a large library starts from several rows.
STEPS_PER_ROW = 10_000
# From this size on, places need more than 64 bits on the way.
LARGE_CATALOGUE = 3_000_000_000

# Strides of the walks through the catalogue, two Mersenne primes
# and two primes next to powers of two. A prime larger than the catalogue meets
# every place once.
STRIDES = (2147483647, 2305843009213693951, 4294967311, 1099511627791)


def positives(pairs: DataFrame) -> DataFrame:
    """(user_id, paper_id, label 1)."""
    return pairs.select("user_id", "paper_id", F.lit(1).alias("label"))


def cast_paper_id(pairs: DataFrame) -> DataFrame:
    """Paper ids as whole numbers; what is no number becomes null."""
    return pairs.withColumn("paper_id", F.col("paper_id").try_cast("int"))


def _walks(sizes: DataFrame, n_papers: int, seed: int) -> DataFrame:
    """(user_id, library_size, step, paper_idx): two steps per paper of the library.

    A walk starts at a drawn place and goes on by a drawn stride. Catalogue places
    are in hash order, strides are prime to the catalogue, so the walk is a random
    order of the catalogue without repeats. Of its first 2m places at most m are in
    the library, so m unrated ones are always among them; a walk that is as long as
    the catalogue has seen all of it.
    """
    key = draw_key(seed, "user_id")
    usable = [p for p in STRIDES if p > n_papers] or [1]
    stride = F.element_at(
        F.array(*[F.lit(p % n_papers or 1) for p in usable]),
        (F.conv(F.substring(key, 9, 8), 16, 10).cast("bigint") % len(usable) + 1).cast("int"),
    )
    steps = F.least(F.col("library_size") * 2, F.lit(n_papers).cast("bigint"))
    starts = sizes.select(
        "user_id",
        "library_size",
        steps.alias("_steps"),
        (draw_int(key) % n_papers).alias("_start"),
        stride.alias("_stride"),
    )
    rows = starts.withColumn(
        "_row", F.explode(F.sequence(F.lit(0), F.floor((F.col("_steps") - 1) / STEPS_PER_ROW)))
    )
    first = F.col("_row") * STEPS_PER_ROW
    last = F.least(first + STEPS_PER_ROW, F.col("_steps")) - 1
    walked = rows.repartition("user_id", "_row").withColumn("step", F.explode(F.sequence(first, last)))
    # step x stride stays below the square of the catalogue.
    wide = "bigint" if n_papers < LARGE_CATALOGUE else "decimal(38,0)"
    place = (F.col("_start") + F.col("step").cast(wide) * F.col("_stride").cast(wide)) % n_papers
    return walked.select(
        "user_id", "library_size", "step", place.cast("bigint").alias("paper_idx")
    )


def sample_negatives(
    pairs: DataFrame, papers: DataFrame, seed: int, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """(user_id, paper_id, label 0): as many unrated papers as the user has rated.

    No pair of a library comes up and none comes up twice. A user whose library
    leaves fewer unrated papers than it has gets all of them.
    """
    catalogue = write_once(dense_index(papers, "paper_id", "paper_idx"), "catalogue")
    n_papers = catalogue.count()
    if n_papers == 0:
        return positives(pairs).limit(0)
    walks = _walks(library_size(pairs), n_papers, seed)
    unrated = write_once(exclude_seen(walks.join(catalogue, "paper_idx"), pairs), "unrated")
    cell = F.floor(F.col("step") / cell_rows)
    placed = position_in_group(unrated, ["user_id"], cell, ["step"])
    drawn = placed.filter(F.col("position") <= F.col("library_size"))
    return drawn.select("user_id", "paper_id", F.lit(0).alias("label"))


def union_interactions(rated: DataFrame, unrated: DataFrame) -> DataFrame:
    return rated.unionByName(unrated)
