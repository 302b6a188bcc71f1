"""Top-k lists per user."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import write_once
from .grouping import position_in_group
from .terms import PAPER_CELLS, paper_cells

# Papers in one row of a collected list.
LIST_PART = 1000
# Tasks that share the first cut of one user's candidates.
CUT_SALTS = 64


def top_k_rows(scored: DataFrame, k: int) -> DataFrame:
    """Exactly the ``k`` best papers per user; equal scores go by paper_id.

    Spark keeps at most ``k`` rows per user and task before the shuffle.
    """
    best_first = Window.partitionBy("user_id").orderBy(F.desc("similarity"), "paper_id")
    ranked = scored.withColumn("rank", F.row_number().over(best_first).cast("bigint"))
    return ranked.filter(F.col("rank") <= k)


def top_k_levels(scored: DataFrame, k: int) -> DataFrame:
    """All papers whose score is among a user's ``k`` best distinct scores.

    Ranks are dense: equal scores share one, and all of them stay, even when
    copies of one paper fill a third of the catalogue. So no task may take all
    rows of a user or of a score. The candidates are cut inside salted parts of a user and
    written; the distinct scores of what is left (at most k per part) make one sorted
    list of k levels per user, and a row's rank is the place of its score in that list.
    Levels that turn out small at runtime are broadcast; if not, the join is by user, and
    Spark can split a user's rows in it.
    """
    salted = scored.withColumn(
        "_salt", F.pmod(F.xxhash64("paper_id"), F.lit(CUT_SALTS)).cast("int")
    )
    in_part = Window.partitionBy("user_id", "_salt").orderBy(F.desc("similarity"))
    cut = salted.withColumn("_rank", F.dense_rank().over(in_part)).filter(F.col("_rank") <= k)
    left = write_once(cut.drop("_salt", "_rank"), "candidates")
    best = F.slice(F.sort_array(F.collect_set("similarity"), asc=False), 1, k)
    levels = left.groupBy("user_id").agg(best.alias("_levels"))
    ranked = left.join(levels, "user_id").withColumn("rank", F.array_position("_levels", F.col("similarity")))
    return ranked.filter(F.col("rank") > 0).drop("_levels")


# The two ways to cut a list, by name.
METHODS = {"dense_rank": top_k_levels, "row_number": top_k_rows}


def top_k(scored: DataFrame, k: int, method: str = "dense_rank") -> DataFrame:
    """(user_id, rank, paper_id, similarity) by dense rank or exactly k rows."""
    ranked = METHODS[method](scored, k)
    return ranked.select("user_id", "rank", "paper_id", "similarity")


def first_positions(recommendations: DataFrame, k: int) -> DataFrame:
    """Add ``position``: the place in the list, ties by paper_id, up to ``k``."""
    in_list = Window.partitionBy("user_id").orderBy("rank", "paper_id")
    placed = recommendations.withColumn("position", F.row_number().over(in_list).cast("bigint"))
    return placed.filter(F.col("position") <= k)


def collect_recommendations(recommendations: DataFrame, k: int) -> DataFrame:
    """(user_id, recommendations): the first ``k`` papers as one list, in order.

    A list has a fixed length; all tied papers of a dense rank are in the rows.
    """
    placed = first_positions(recommendations, k)
    in_order = F.array_sort(F.collect_list(F.struct("position", "paper_id")))
    return placed.groupBy("user_id").agg(
        F.transform(in_order, lambda p: p["paper_id"]).alias("recommendations")
    )


def collect_ranked(
    recommendations: DataFrame, part_papers: int = LIST_PART, cells: int = PAPER_CELLS
) -> DataFrame:
    """(user_id, part, recommendations): all papers of the lists in order, ties by paper_id.

    With dense ranks a list has no fixed length: copies of one paper may tie for a third of
    the catalogue. It comes in parts of ``part_papers`` papers, numbered from 0, and
    places are counted in cells of a rank and a range of ids, so no task orders a
    whole list.
    """
    ranges = paper_cells(recommendations.select("paper_id").distinct(), cells)
    listed = recommendations.select("user_id", "rank", "paper_id").join(
        ranges.withColumnRenamed("_cell", "_range"), "paper_id"
    )
    cell = F.struct("rank", "_range")
    placed = position_in_group(listed, ["user_id"], cell, ["rank", "paper_id"])
    part = F.floor((F.col("position") - 1) / part_papers).alias("part")
    in_order = F.array_sort(F.collect_list(F.struct("position", "paper_id")))
    parts = placed.groupBy("user_id", part).agg(in_order.alias("_placed"))
    return parts.select("user_id", "part", F.transform("_placed", lambda p: p["paper_id"]).alias("recommendations"))
