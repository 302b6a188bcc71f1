"""Similarity of sampled users with every unseen paper.

Scores are rounded, so that ranks do not depend on the order in which partial
sums meet, also when a task runs again.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..storage import write_once
from .grouping import dense_index
from .libraries import exclude_seen

SCORE_DIGITS = 6

# Users whose weights travel with each term row; more are joined by term.
PIVOT_USERS = 64
# User x term weights that may be broadcast.
BROADCAST_WEIGHTS = 4_000_000
# Users in one dense block, and papers in one block when users need several.
BLOCK_USERS = 1024
BLOCK_PAPERS = 16_384
# Papers whose lists of users who have them may be broadcast.
BROADCAST_SEEN = 200_000
# Rows of one term are spread over this many tasks in the shuffled term join.
TERM_SALTS = 512


# ---------------------------------------------------------------- sparse --


def score_sparse(
    profiles: DataFrame,
    weights: DataFrame,
    train: DataFrame,
    digits: int = SCORE_DIGITS,
    include_zero: bool = False,
) -> DataFrame:
    """(user_id, paper_id, similarity) of unseen papers that share a term.

    ``profiles`` (user_id, term_id, weight) should be a written table: its users and
    terms are counted first, so the size of a broadcast is known before the plan
    runs, and every user has a place; beyond it, the term join is shuffled with salted
    terms. ``include_zero`` also returns the papers that share no term, with score 0.
    """
    n_users, n_terms = profiles.agg(F.countDistinct("user_id"), F.countDistinct("term_id")).first()
    n_users, n_terms = max(n_users, 1), max(n_terms, 1)
    if n_users <= PIVOT_USERS and n_users * n_terms <= BROADCAST_WEIGHTS:
        dots = _dots_by_pivot(profiles, weights, n_users, include_zero)
    else:
        dots = _dots_by_term(profiles, weights, n_users, n_terms, include_zero)
    score = F.try_divide(F.col("dot"), F.col("user_norm") * F.col("paper_norm"))
    scored = dots.select("user_id", "paper_id", F.round(score, digits).alias("similarity"))
    return exclude_seen(scored.filter("similarity IS NOT NULL"), train)


def _norm(weight: str) -> Column:
    return F.sqrt(F.sum(F.col(weight) * F.col(weight)))


def _dots_by_pivot(
    profiles: DataFrame, weights: DataFrame, n_users: int, include_zero: bool
) -> DataFrame:
    """One pass: all users' products and the paper's norm in one aggregation.

    Each term row carries the weights of all users as an array, so the join does
    not multiply rows, and the papers are shuffled once, by paper. A paper has no
    more rows than the vocabulary has terms.
    """
    in_order = Window.orderBy("user_id")
    users = (
        profiles.groupBy("user_id")
        .agg(_norm("weight").alias("user_norm"))
        .withColumn("slot", F.row_number().over(in_order) - 1)
    )
    by_slot = F.map_from_entries(F.collect_list(F.struct("slot", "weight")))
    user_weights = F.transform(
        F.sequence(F.lit(0), F.lit(n_users - 1)),
        lambda slot: F.coalesce(F.try_element_at(F.col("_by_slot"), slot), F.lit(0.0)),
    )
    by_term = (
        profiles.join(F.broadcast(users.select("user_id", "slot")), "user_id")
        .groupBy("term_id")
        .agg(by_slot.alias("_by_slot"))
        .select("term_id", user_weights.alias("user_weights"))
    )
    by_paper = weights.repartition("paper_id").join(F.broadcast(by_term), "term_id", "left")
    products = [
        F.sum(F.col("weight") * F.col("user_weights")[slot]).alias(f"_dot{slot}")
        for slot in range(n_users)
    ]
    summed = by_paper.groupBy("paper_id").agg(_norm("weight").alias("paper_norm"), *products)
    slots = F.array(*[F.col(f"_dot{slot}") for slot in range(n_users)])
    dots = summed.select("paper_id", "paper_norm", F.posexplode(slots).alias("slot", "dot"))
    dots = dots.fillna(0.0, ["dot"]) if include_zero else dots.filter("dot > 0")
    return dots.join(F.broadcast(users), "slot")


def _dots_by_term(
    profiles: DataFrame, weights: DataFrame, n_users: int, n_terms: int, include_zero: bool
) -> DataFrame:
    """Join on terms and sum the products per user and paper.

    A frequent term has rows from up to a tenth of all papers: they are spread
    over salts, and the users' weights are repeated once per salt.
    """
    user_norms = profiles.groupBy("user_id").agg(_norm("weight").alias("user_norm"))
    paper_norms = weights.groupBy("paper_id").agg(_norm("weight").alias("paper_norm"))
    users = profiles.withColumnRenamed("weight", "user_weight")
    if n_users * n_terms <= BROADCAST_WEIGHTS:
        joined = weights.join(F.broadcast(users), "term_id")
    else:
        salts = F.sequence(F.lit(0), F.lit(TERM_SALTS - 1))
        salted = weights.withColumn(
            "_salt", F.pmod(F.xxhash64("paper_id"), F.lit(TERM_SALTS)).cast("int")
        )
        repeated = users.withColumn("_salt", F.explode(salts))
        joined = salted.join(repeated, ["term_id", "_salt"])
    dots = joined.groupBy("user_id", "paper_id").agg(
        F.sum(F.col("weight") * F.col("user_weight")).alias("dot")
    )
    if not include_zero:
        positive = dots.filter("dot > 0")
        return positive.join(user_norms, "user_id").join(paper_norms, "paper_id")
    slots = user_norms.join(dense_index(profiles, "user_id", "slot"), "user_id")
    first, last = F.lit(0).cast("bigint"), F.lit(n_users - 1).cast("bigint")
    every = F.explode(F.sequence(first, last))
    papers = paper_norms.select("paper_id", "paper_norm", every.alias("slot")).join(slots, "slot")
    return papers.join(dots, ["user_id", "paper_id"], "left").fillna(0.0, ["dot"])


# ----------------------------------------------------------------- dense --


def score_dense(
    profiles: DataFrame,
    vectors: DataFrame,
    train: DataFrame,
    k: int | None = None,
    digits: int = SCORE_DIGITS,
    block_users: int = BLOCK_USERS,
    block_papers: int = BLOCK_PAPERS,
) -> DataFrame:
    """(user_id, paper_id, similarity) of unseen papers; zero vectors get no score.

    Every task multiplies its Arrow batches with a block of users. With ``k`` it
    keeps only rows that can still be among a user's ``k`` best distinct scores, so
    the pairs never leave the task; without ``k`` all pairs are returned.

    Up to ``block_users`` profiles ship with the task; the papers stay in place as
    long as the counted table of papers that these users have can be broadcast. More profiles are cut into blocks that meet blocks of papers.
    """
    first = profiles.limit(block_users + 1).collect()
    if len(first) <= block_users:
        return _score_shipped(first, profiles, vectors, train, k, digits)
    return _score_blocks(profiles, vectors, train, k, digits, block_users, block_papers)


def _score_shipped(rows, profiles, vectors, train, k, digits) -> DataFrame:
    spark = vectors.sparkSession
    user_type = profiles.schema["user_id"].dataType
    schema = _scored_schema(profiles, vectors)
    slots = [(row.user_id, slot) for slot, row in enumerate(rows)]
    if not slots:
        return spark.createDataFrame([], schema)
    users = spark.createDataFrame(slots, f"user_id {user_type.simpleString()}, slot int")
    # A paper's list of users who have it is no longer than the block of users.
    seen = (
        train.join(F.broadcast(users), "user_id")
        .groupBy("paper_id")
        .agg(F.collect_list("slot").alias("seen"))
    )
    seen = write_once(seen, "seen")
    if seen.count() <= BROADCAST_SEEN:
        seen = F.broadcast(seen)
    papers = vectors.select("paper_id", "vector").join(seen, "paper_id", "left")
    matrix = np.array([row.vector for row in rows], dtype="float64")
    user_ids = pa.array([row.user_id for row in rows], to_arrow_type(user_type))

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _score_batch(user_ids, matrix, batch, k, digits)

    scored = papers.mapInArrow(score_batches, schema)
    return scored.withColumn("similarity", F.round("similarity", digits))


def _score_blocks(profiles, vectors, train, k, digits, block_users, block_papers) -> DataFrame:
    schema = _scored_schema(profiles, vectors)
    user_blocks = -(-profiles.count() // block_users)
    paper_blocks = -(-vectors.count() // block_papers)

    def block(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    users = profiles.select(
        "user_id", "vector", block("user_id", user_blocks).alias("_ub")
    ).withColumn("_pb", every(paper_blocks))
    # Users who have the paper, per block of users: the list fits one block.
    seen = (
        train.withColumn("_ub", block("user_id", user_blocks))
        .groupBy("paper_id", "_ub")
        .agg(F.collect_list("user_id").alias("seen"))
    )
    papers = (
        vectors.select("paper_id", "vector", block("paper_id", paper_blocks).alias("_pb"))
        .withColumn("_ub", every(user_blocks))
        .join(seen, ["paper_id", "_ub"], "left")
    )

    def score_block(paper_table: pa.Table, user_table: pa.Table) -> pa.Table:
        ids = user_table.column("user_id").combine_chunks()
        parts = []
        if len(ids) and len(paper_table):
            matrix = np.array(user_table.column("vector").to_pylist(), dtype="float64")
            slot_of = {user: slot for slot, user in enumerate(ids.to_pylist())}
            names = ["paper_id", "vector", "seen"]
            for batch in paper_table.select(names).to_batches():
                seen_users = batch.column("seen").to_pylist()
                seen_slots = pa.array(
                    [[slot_of[u] for u in users if u in slot_of] if users else [] for users in seen_users],
                    pa.list_(pa.int32()),
                )
                mapped = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), seen_slots], names)
                parts.extend(_score_batch(ids, matrix, mapped, k, digits))
        if parts:
            return pa.Table.from_batches(parts)
        empty = [ids.slice(0, 0), paper_table.column("paper_id").slice(0, 0), pa.array([], pa.float64())]
        return pa.table(empty, names=["user_id", "paper_id", "similarity"])

    keys = ["_pb", "_ub"]
    scored = papers.groupBy(*keys).cogroup(users.groupBy(*keys)).applyInArrow(score_block, schema)
    return scored.withColumn("similarity", F.round("similarity", digits))


def _scored_schema(profiles: DataFrame, vectors: DataFrame) -> str:
    user_type = profiles.schema["user_id"].dataType.simpleString()
    paper_type = vectors.schema["paper_id"].dataType.simpleString()
    return f"user_id {user_type}, paper_id {paper_type}, similarity double"


def _score_batch(user_ids, matrix, batch, k, digits) -> Iterator[pa.RecordBatch]:
    """Cosines of one batch of papers with all users of the block."""
    column = batch.column("vector")
    usable = np.flatnonzero(~np.asarray(column.is_null()))
    if not len(usable):
        return
    batch = batch.take(pa.array(usable))
    column = batch.column("vector")
    papers = column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    lengths = np.linalg.norm(papers, axis=1)[:, None] * np.linalg.norm(matrix, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = np.where(lengths > 0, (papers @ matrix.T) / lengths, np.nan)
    seen = batch.column("seen")
    counts = seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    scores[np.repeat(np.arange(len(batch)), counts), seen.flatten().to_numpy(zero_copy_only=False)] = np.nan
    keep = ~np.isnan(scores)
    if k is not None:
        margin = 10.0**-digits
        for slot in range(len(user_ids)):
            levels = np.unique(np.round(scores[keep[:, slot], slot], digits))
            if len(levels) > k:
                # One rounding step of slack keeps every row that may tie with the k-th.
                keep[:, slot] &= scores[:, slot] >= levels[-k] - margin
    paper, user = np.nonzero(keep)
    yield pa.RecordBatch.from_arrays(
        [user_ids.take(pa.array(user)), batch.column("paper_id").take(pa.array(paper)), pa.array(scores[paper, user])],
        ["user_id", "paper_id", "similarity"],
    )
