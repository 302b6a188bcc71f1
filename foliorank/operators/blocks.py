"""Exact top-k lists without scoring every paper, by bounds on blocks of papers.

Two indexes of the catalogue, each a table with a row per block:

* ``build_blocks`` for term weights: papers ordered by their strongest term and its impact
  (weight over the paper's length), with the largest impact of every term of the block
  beside the postings. A user's weights against these maxima bound every score of the block.
* ``build_balls`` for vectors: the papers of a task's rows around a centre, with the largest
  angle to it. By the triangle inequality no paper is nearer to a user than the
  angle between user and centre less the radius. Vectors stay in their partitions.

A search

1. bounds all blocks for all users, reading the maxima (or centres) only,
2. scores each user's few best blocks, whose k-th best unseen score is a floor,
3. scores, for each user, the blocks whose bound reaches the floor.

A paper in any other block cannot enter the list, so the lists equal those of scoring all
papers. Rows are blocks x users and the papers that reach a floor, never users x papers.
How many blocks are skipped depends on the papers: those that share topics have tight
bounds; among unrelated ones the third step scores nearly all blocks.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from ..storage import write_once
from .libraries import exclude_seen
from .ranking import top_k
from .scoring import BLOCK_USERS, BROADCAST_WEIGHTS, SCORE_DIGITS, score_dense, score_sparse

BLOCK_PAPERS = 1024
SEED_BLOCKS = 4
# Vectors that one task holds while it forms balls, and papers to a ball, on average.
CHUNK_VECTORS = 16_384
BALL_PAPERS = 256
_USERS_AT_ONCE = 64


def build_blocks(weights: DataFrame, block_papers: int = BLOCK_PAPERS) -> DataFrame:
    """(paper_id, term_id, weight) packed into blocks, as a written table.

    A block is one row: papers, the number of terms of each, terms and impacts in order,
    and the block's terms with their largest impacts. Papers without weight are left out.
    A frequent strongest term is cut into ranges of impact, so it fills no task alone.
    """
    paper, term = (weights.schema[c].dataType.simpleString() for c in ("paper_id", "term_id"))
    entries = F.collect_list(F.struct(F.col("weight").cast("double").alias("weight"), "term_id"))
    listed = weights.where("weight <> 0").groupBy("paper_id").agg(entries.alias("entries"))
    norm = F.sqrt(F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["weight"] * e["weight"]))
    measured = listed.withColumn("norm", norm).withColumn("first", F.array_max("entries"))
    order = ["lead", F.desc("strength"), "paper_id"]
    ordered = (
        measured.select(
            "paper_id",
            F.col("first.term_id").alias("lead"),
            (F.col("first.weight") / F.col("norm")).alias("strength"),
            F.col("entries.term_id").alias("terms"),
            F.transform("entries", lambda e: e["weight"] / F.col("norm")).alias("impacts"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    schema = (
        f"block bigint, papers array<{paper}>, sizes array<int>, terms array<{term}>, impacts array<double>, "
        f"top_terms array<{term}>, top_impacts array<double>"
    )
    target = to_arrow_schema(StructType.fromDDL(schema))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for batch in batches:
            leads = batch.column("lead")
            codes = leads.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1), len(batch)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                while start < stop:
                    room = block_papers - sum(len(h) for h in held)
                    take = min(room, stop - start)
                    held.append(batch.slice(start, take))
                    start += take
                    filled = sum(len(h) for h in held)
                    # A new strongest term opens a new block once this one is worth a row.
                    if filled >= block_papers or start == stop and filled >= block_papers // 4:
                        yield _packed(held, number, target)
                        held, number = [], number + 1
        if held:
            yield _packed(held, number, target)

    return write_once(ordered.mapInArrow(pack, schema), "blocks")


def _packed(held: list[pa.RecordBatch], number: int, target: pa.Schema) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    terms, impacts = (pc.list_flatten(rows[c]).combine_chunks() for c in ("terms", "impacts"))
    coded = terms.dictionary_encode()
    top = np.zeros(len(coded.dictionary))
    np.maximum.at(top, coded.indices.to_numpy(zero_copy_only=False), np.abs(impacts.to_numpy()))
    lists = [
        rows["paper_id"].combine_chunks(), pc.list_value_length(rows["terms"]).combine_chunks().cast(pa.int32()),
        terms, impacts, coded.dictionary, pa.array(top),
    ]
    columns = [pa.array([number], pa.int64())]
    for values, field in zip(lists, list(target)[1:]):
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(field.type))
    return pa.RecordBatch.from_arrays(columns, schema=target)


def build_balls(vectors: DataFrame, ball_papers: int = BALL_PAPERS, chunk: int = CHUNK_VECTORS) -> DataFrame:
    """(paper_id, vector) packed into balls inside their partitions, as a written table.

    Every ``chunk`` rows of a task form chunk / ball_papers balls by two rounds of spherical
    k-means. A ball is one row: papers, their unit vectors end to end, the centre and the
    angle to the farthest of them. Null and zero vectors are left out, as they have no score.
    """
    paper = vectors.schema["paper_id"].dataType.simpleString()
    schema = f"block bigint, papers array<{paper}>, vectors array<double>, centre array<double>, radius double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def balls() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            lists = rows["vector"].combine_chunks()
            units = lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(lists), -1)
            lengths = np.sqrt((units * units).sum(axis=1))
            kept = np.flatnonzero(lengths > 0)
            units, ids = units[kept] / lengths[kept, None], rows["paper_id"].combine_chunks().take(pa.array(kept))
            for number_in_chunk, own in enumerate(_ball_members(units, ball_papers)):
                centre = units[own].mean(axis=0)
                size = np.sqrt((centre * centre).sum())
                centre = centre / size if size > 0 else units[own[0]]
                radius = float(np.arccos(np.clip(units[own] @ centre, -1, 1)).max())
                values = [number + number_in_chunk, ids.take(pa.array(own)).to_pylist(), units[own].ravel(), centre, radius]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, target)], schema=target)

        for batch in batches:
            held.append(batch.filter(batch.column("vector").is_valid()))
            if sum(len(h) for h in held) >= chunk:
                yield from balls()
                number, held = number + chunk, []
        if any(len(h) for h in held):
            yield from balls()

    return write_once(vectors.select("paper_id", "vector").mapInArrow(pack, schema), "balls")


def _ball_members(units: np.ndarray, ball_papers: int) -> list[np.ndarray]:
    """Places of the rows of each ball."""
    if not len(units):
        return []
    centres = units[:: max(1, ball_papers)][: max(1, len(units) // ball_papers)]
    for _ in range(3):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(sizes[:, None] > 0, sums / np.where(sizes > 0, sizes, 1)[:, None], centres)
    order = np.argsort(nearest, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1)


@dataclass(frozen=True)
class BlockSearch:
    """The lists, and what was looked at for them: (block, slot, bound) of all blocks, and the scored ones."""

    lists: DataFrame
    bounds: DataFrame
    scored: DataFrame


class _Postings:
    """Users' weights as unit rows over the terms of all profiles, against posting blocks."""

    bounding, scoring = ["top_terms", "top_impacts"], ["sizes", "terms", "impacts"]

    def __init__(self, profiles: DataFrame):
        rows = profiles.select("user_id", "term_id", F.col("weight").cast("double").alias("weight")).toArrow()
        users = rows["user_id"].combine_chunks().dictionary_encode()
        terms = rows["term_id"].combine_chunks().dictionary_encode()
        self.ids, self.terms = users.dictionary, terms.dictionary
        weights = np.zeros((len(self.ids), len(self.terms)))
        at = (users.indices.to_numpy(zero_copy_only=False), terms.indices.to_numpy(zero_copy_only=False))
        np.add.at(weights, at, rows["weight"].to_numpy())
        self.weights = _unit(weights)

    def _places(self, terms: pa.Array) -> np.ndarray:
        found = pc.index_in(terms, value_set=self.terms.cast(terms.type))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    def bounds(self, batch: pa.RecordBatch, row: int) -> np.ndarray:
        place = self._places(batch.column("top_terms")[row].values)
        known = place >= 0
        return np.abs(self.weights[:, place[known]]) @ batch.column("top_impacts")[row].values.to_numpy()[known]

    def scores(self, batch: pa.RecordBatch, row: int, slots: np.ndarray) -> np.ndarray:
        place = self._places(batch.column("terms")[row].values)
        impact = np.where(place >= 0, batch.column("impacts")[row].values.to_numpy(), 0.0)
        starts = np.concatenate([[0], np.cumsum(batch.column("sizes")[row].values.to_numpy())[:-1]])
        scores = np.add.reduceat(self.weights[slots][:, place] * impact, starts, axis=1)
        # Papers that share no term have no score.
        return np.where(scores > 0, scores, np.nan)


class _Angles:
    """Users' vectors as unit rows, against balls."""

    bounding, scoring = ["centre", "radius"], ["vectors"]

    def __init__(self, profiles: DataFrame):
        rows = profiles.select("user_id", "vector").where("vector IS NOT NULL").toArrow()
        vectors = rows["vector"].combine_chunks()
        found = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(vectors), -1)
        kept = np.flatnonzero((found * found).sum(axis=1) > 0) if len(vectors) else np.zeros(0, int)
        self.ids, self.vectors = rows["user_id"].combine_chunks().take(pa.array(kept)), _unit(found[kept])

    def bounds(self, batch: pa.RecordBatch, row: int) -> np.ndarray:
        cosine = np.clip(self.vectors @ batch.column("centre")[row].values.to_numpy(), -1, 1)
        return np.cos(np.maximum(np.arccos(cosine) - batch.column("radius")[row].as_py(), 0))

    def scores(self, batch: pa.RecordBatch, row: int, slots: np.ndarray) -> np.ndarray:
        length = self.vectors.shape[1]
        return self.vectors[slots] @ batch.column("vectors")[row].values.to_numpy().reshape(-1, length).T


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def _bounds(blocks: DataFrame, users) -> DataFrame:
    """(block, slot, bound): no score of the block is higher."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("block").to_numpy()
            for row, number in enumerate(numbers):
                bound = users.bounds(batch, row)
                slot = np.flatnonzero(bound != 0)
                columns = [pa.array(np.full(len(slot), number)), pa.array(slot, pa.int32()), pa.array(bound[slot])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "slot", "bound"])

    return blocks.select("block", *users.bounding).mapInArrow(run, "block bigint, slot int, bound double")


def _scores(blocks: DataFrame, users, wanted: DataFrame, schema: str, margin: float) -> DataFrame:
    """(user_id, paper_id, similarity) at the floor or more, from the wanted (block, slot, floor)."""
    asked = wanted.groupBy("block").agg(F.collect_list("slot").alias("slots"), F.collect_list("floor").alias("floors"))
    user_type = to_arrow_type(StructType.fromDDL(schema)["user_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                papers = batch.column("papers")[row].values
                slots = batch.column("slots")[row].values.to_numpy()
                floors = batch.column("floors")[row].values.to_numpy()
                for at in range(0, len(slots), _USERS_AT_ONCE):
                    own = slots[at : at + _USERS_AT_ONCE]
                    score = users.scores(batch, row, own)
                    user, paper = np.nonzero(score >= floors[at : at + _USERS_AT_ONCE, None] - margin)
                    columns = [users.ids.take(pa.array(own[user])).cast(user_type), papers.take(pa.array(paper))]
                    columns.append(pa.array(score[user, paper]))
                    yield pa.RecordBatch.from_arrays(columns, names=["user_id", "paper_id", "similarity"])

    needed = blocks.select("block", "papers", *users.scoring).join(asked, "block")
    return needed.mapInArrow(run, schema)


def _search(blocks, users, user_type: str, train, k, method, digits, seed_blocks) -> BlockSearch:
    paper = blocks.schema["papers"].dataType.elementType.simpleString()
    schema = f"user_id {user_type}, paper_id {paper}, similarity double"
    margin, least = 2 * 10.0**-digits, -2.0

    def scores(wanted: DataFrame) -> DataFrame:
        rows = _scores(blocks, users, wanted, schema, margin)
        return exclude_seen(rows.withColumn("similarity", F.round("similarity", digits)), train)

    bounds = write_once(_bounds(blocks, users), "bounds")
    best_first = Window.partitionBy("slot").orderBy(F.desc("bound"), "block")
    seeds = bounds.withColumn("_place", F.row_number().over(best_first)).where(F.col("_place") <= seed_blocks)
    first = scores(seeds.select("block", "slot", F.lit(least).alias("floor")))
    slots = bounds.sparkSession.createDataFrame(list(enumerate(users.ids.to_pylist())), f"slot int, user_id {user_type}")
    # The k-th best score of a user's seeds, a list of at most seed_blocks blocks of papers; only a
    # list that is full already keeps papers out.
    gathered = F.collect_set("similarity") if method == "dense_rank" else F.collect_list("similarity")
    floors = (
        first.groupBy("user_id")
        .agg(F.get(F.sort_array(gathered, asc=False), F.lit(k - 1)).alias("floor"))
        .join(F.broadcast(slots), "user_id")
        .select("slot", "floor")
    )
    floors = write_once(floors, "floors")
    scored = (
        bounds.join(F.broadcast(floors), "slot", "left")
        .withColumn("floor", F.coalesce("floor", F.lit(least)))
        .where(F.col("bound") >= F.col("floor") - F.lit(margin))
        .select("block", "slot", "floor")
    )
    return BlockSearch(top_k(scores(scored), k, method), bounds, scored)


def search_blocks(
    blocks: DataFrame,
    profiles: DataFrame,
    train: DataFrame,
    k: int,
    method: str = "dense_rank",
    digits: int = SCORE_DIGITS,
    seed_blocks: int = SEED_BLOCKS,
) -> BlockSearch:
    """Lists of the users in ``profiles`` (user_id, term_id, weight): at most BROADCAST_WEIGHTS user x term weights."""
    user_type = profiles.schema["user_id"].dataType.simpleString()
    return _search(blocks, _Postings(profiles), user_type, train, k, method, digits, seed_blocks)


def search_balls(
    balls: DataFrame,
    profiles: DataFrame,
    train: DataFrame,
    k: int,
    method: str = "dense_rank",
    digits: int = SCORE_DIGITS,
    seed_blocks: int = SEED_BLOCKS,
) -> BlockSearch:
    """Lists of the users in ``profiles`` (user_id, vector): at most BROADCAST_WEIGHTS numbers in all."""
    user_type = profiles.schema["user_id"].dataType.simpleString()
    return _search(balls, _Angles(profiles), user_type, train, k, method, digits, seed_blocks)


def top_k_sparse(
    profiles: DataFrame, weights: DataFrame, train: DataFrame, k: int, method: str = "dense_rank"
) -> DataFrame:
    """(user_id, rank, paper_id, similarity): the lists of ``profiles`` (a written table) from term weights.

    Profiles of more than BROADCAST_WEIGHTS user x term weights are scored by the shuffled term join.
    """
    n_users, n_terms = profiles.agg(F.countDistinct("user_id"), F.countDistinct("term_id")).first()
    if n_users * n_terms > BROADCAST_WEIGHTS:
        return top_k(score_sparse(profiles, weights, train), k, method)
    return search_blocks(build_blocks(weights), profiles, train, k, method).lists


def top_k_dense(
    profiles: DataFrame, vectors: DataFrame, train: DataFrame, k: int, method: str = "dense_rank"
) -> DataFrame:
    """(user_id, rank, paper_id, similarity): the lists of ``profiles`` (a written table) from paper vectors.

    A block of users is scored in one scan of the papers, which costs less than an index of
    them. More users share the balls of one index; beyond BROADCAST_WEIGHTS numbers blocks of
    users meet blocks of papers.
    """
    n_users, numbers = profiles.agg(F.count("*"), F.sum(F.size("vector"))).first()
    if BLOCK_USERS < n_users and (numbers or 0) <= BROADCAST_WEIGHTS:
        return search_balls(build_balls(vectors), profiles, train, k, method).lists
    return top_k(score_dense(profiles, vectors, train, k), k, method)
