"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors again and again at the median projection on a random
direction; vectors near a median go to both sides (spill), so a close pair is rarely cut.
Vectors that share a leaf are compared by exact cosine, pairs at ``min_cosine`` or more
are links, and links of all trees unite to components. A pair counts in the first leaf
that its vectors share (in the order of trees and of leaf ids), which each of them can tell
from its own list of leaves: so links are counted without listing pairs, and a leaf
emits one row per linked vector.

Splits are fitted on about ``SAMPLE`` hashed rows of a cell (fewer rows: all of them); every row
is moved by them. Cells above ``leaf`` rows are split on, some levels a round, until none is
left or no direction divides it; a larger leaf is compared in blocks of ``BLOCK`` rows.

Groups of copies may hold a large share of all rows, so the forest sees them as one point:

* equal vectors are collapsed first, with their number as weight;
* near copies: before the forest, a tree without spill looks for balls of half the angle
  inside cells. All members of such a ball are linked with each other by the triangle
  inequality, without a comparison. The ball goes through the forest as its centre and radius;
  against another point it is linked whole, apart, or (only then) compared member by member, in blocks.

A link between a vector and a member of a ball may be missed like any other; recall against
brute force is measured in the tests. Vectors that are null, empty, zero or hold null or
non-finite components link with nothing; vectors of different lengths never link. A null
vec_id takes part; a component without any id has component_id null. Rows that repeat are
linked rows. An empty table gives no rows, extra columns are ignored.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

LEAF, BLOCK, SAMPLE, LEVELS = 1024, 2048, 2048, 5
BALL_SHARE = 1 / 16  # of a cell's sample, for a ball to be taken out
NARROW_CELLS = 512  # fits of so many cells (under 1 KB each, and a centre) are broadcast
_DIRECTIONS = 3
_CROWDED = 0.5  # of a cell's rows near its median: no direction divides it


def unit_rows(vectors) -> np.ndarray:
    """(rows x length) doubles of length one."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _direction(cell: int, node: int, choice: int, length: int) -> np.ndarray:
    drawn = np.random.default_rng([cell & (1 << 63) - 1, cell < 0, node, choice]).standard_normal(length)
    return drawn / np.sqrt((drawn * drawn).sum())


def _child(cells: np.ndarray, path: np.ndarray) -> np.ndarray:
    x = cells.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + path.astype(np.uint64) + np.uint64(1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


class _Splits:
    """How a cell of ``length`` components is cut; ``spill`` is 0 for the tree that looks for balls."""

    def __init__(self, min_cosine: float, leaf: int, spill: bool, balls: bool):
        self.leaf, self.spill, self.balls = leaf, spill, balls
        self.chord = math.sqrt(max(0.0, 2 - 2 * min_cosine))
        self.half = math.cos(math.acos(min_cosine) / 2) + 1e-9

    def margin(self, length: int, radius: np.ndarray) -> np.ndarray:
        if not self.spill:
            return np.full(len(radius), -1.0)
        return (0.5 * self.chord + 2 * np.sin(radius / 2)) / math.sqrt(length)

    def ball(self, rows: np.ndarray) -> np.ndarray | None:
        """The centre of the densest ball of half the angle, if it holds enough of the sample."""
        near = rows @ rows.T >= self.half
        members = near[near.sum(axis=1).argmax()]
        for _ in range(2):
            centre = rows[members].mean(axis=0)
            centre /= np.sqrt((centre * centre).sum())
            members = rows @ centre >= self.half
            if members.sum() < max(2, BALL_SHARE * len(rows)):
                return None
        return centre

    def fit(self, cell: int, count: int, rows: np.ndarray, radius: np.ndarray):
        """Medians and choices of direction of the nodes, NaN where a node is not cut; and a ball's centre."""
        centre = self.ball(rows) if self.balls else None
        if centre is not None:
            rest = rows @ centre < self.half
            count, rows, radius = int(count * rest.mean()), rows[rest], radius[rest]
        scale = count / max(1, len(rows))
        cuts = np.full(2**LEVELS, np.nan)
        choices = np.zeros(2**LEVELS, np.int32)
        at = {1: np.arange(len(rows))}
        for node in range(1, 2**LEVELS):
            own = at.get(node)
            if own is None or len(own) < 2 or len(own) * scale <= self.leaf:
                continue
            margin = self.margin(rows.shape[1], radius[own])
            best = (2.0, 0, 0.0, None)
            for choice in range(_DIRECTIONS):
                placed = rows[own] @ _direction(cell, node, choice, rows.shape[1])
                median = float(np.median(placed))
                crowd = float((np.abs(placed - median) <= margin).mean())
                if self.spill and crowd < best[0] or not self.spill and -placed.std() < best[0]:
                    best = (crowd if self.spill else -placed.std(), choice, median, placed)
            if self.spill and best[0] > _CROWDED or best[3] is None or best[3].min() == best[3].max():
                choices[node] = -1
                continue
            cuts[node], choices[node] = best[2], best[1]
            at[2 * node] = own[best[3] <= best[2] + margin]
            at[2 * node + 1] = own[best[3] > best[2] - margin]
        return cuts, choices, centre

    def move(self, cell: int, rows: np.ndarray, radius: np.ndarray, cuts, choices):
        """(row, path, final): the nodes at which rows come to rest; a row near a median has several."""
        margin = self.margin(rows.shape[1], radius)
        at, rest = {1: np.arange(len(rows))}, []
        for node in range(1, 2 ** (LEVELS + 1)):
            own = at.pop(node, None)
            if own is None or not len(own):
                continue
            if node >= 2**LEVELS or np.isnan(cuts[node]):
                final = node < 2**LEVELS and choices[node] < 0
                rest.append((own, np.full(len(own), node), np.full(len(own), final)))
                continue
            placed = rows[own] @ _direction(cell, node, int(choices[node]), rows.shape[1])
            at[2 * node] = own[placed <= cuts[node] + np.maximum(margin[own], 0)]
            at[2 * node + 1] = own[placed > cuts[node] - np.maximum(margin[own], 0)]
        return [np.concatenate(x) for x in zip(*rest)]


def _grow(scratch: Scratch, points: DataFrame, tree: int, splits: _Splits) -> tuple[DataFrame, list[DataFrame], bool]:
    """(key, cell, off) of every point, in one row per leaf, the fits with a ball, and whether no cell was cut.

    ``off`` is the angle to the centre for rows in a ball, whose cell names the ball.
    """
    kind = points.schema["vector"].dataType.simpleString()
    schema = f"key string, vector {kind}, radius double, cell bigint, final boolean, off double"
    rows = points.select(
        "key", "vector", "radius", F.xxhash64(F.lit(tree), F.size("vector")).alias("cell"),
        F.lit(False).alias("final"), F.lit(None).cast("double").alias("off"),
    )
    balls = []

    def fit(table: pa.Table) -> pa.Table:
        cell, count = table["cell"][0].as_py(), table["count"][0].as_py()
        cuts, choices, centre = splits.fit(cell, count, unit_rows(table["vector"]), table["radius"].to_numpy())
        packed = np.concatenate([cuts, choices, [] if centre is None else centre]).tobytes()
        values = {"fitted": [cell], "fit": [packed], "centre": [None if centre is None else centre.tolist()]}
        types = {"fitted": pa.int64(), "fit": pa.binary(), "centre": table.schema.field("vector").type}
        return pa.table({n: pa.array(v, types[n]) for n, v in values.items()})

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted = batch.column("fitted").is_valid().to_numpy(zero_copy_only=False)
            cells = batch.column("cell").to_numpy()
            radius = batch.column("radius").to_numpy()
            keep = ["key", "vector", "radius"]
            stay = np.flatnonzero(~fitted)
            if len(stay):
                names = [*keep, "cell", "final", "off"]
                yield pa.RecordBatch.from_arrays(batch.take(pa.array(stay)).select(names).columns, names=names)
            at = np.flatnonzero(fitted)
            order = at[np.argsort(cells[at], kind="stable")]
            for own in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1) if len(order) else []:
                first, cell = int(own[0]), int(cells[own[0]])
                rows = unit_rows(batch.column("vector").take(pa.array(own)))
                fit = np.frombuffer(batch.column("fit")[first].as_py(), np.float64)
                cuts, choices, centre = np.split(fit, [2**LEVELS, 2 ** (LEVELS + 1)])
                off = np.full(len(own), np.nan)
                if len(centre):
                    # The centre as it is stored with the ball, so that angles are to that one.
                    centre = unit_rows(pa.array([centre.tolist()], batch.schema.field("vector").type))[0]
                    near = rows @ centre
                    off = np.where(near >= splits.half, np.arccos(np.minimum(near, 1)), np.nan)
                free = np.flatnonzero(np.isnan(off))
                held = np.flatnonzero(~np.isnan(off))
                parts = [(held, np.full(len(held), cell), np.ones(len(held), bool), off[held])]
                if len(free):
                    row, path, final = splits.move(cell, rows[free], radius[own[free]], cuts, choices)
                    named = _child(np.full(len(row), cell), path)
                    parts.append((free[row], named, final, np.full(len(row), np.nan)))
                row, named, final, off = (np.concatenate(x) for x in zip(*parts))
                moved = batch.take(pa.array(own[row])).select(keep)
                yield pa.RecordBatch.from_arrays(
                    [*moved.columns, pa.array(named, pa.int64()), pa.array(final), pa.array(off, from_pandas=True)],
                    names=[*keep, "cell", "final", "off"],
                )

    for number in range(64):
        open_rows = rows.where(~F.col("final"))
        over = scratch.write(open_rows.groupBy("cell").count().where(F.col("count") > splits.leaf), "over")
        cells = over.count()
        if not cells:
            break
        hint = F.broadcast if cells <= NARROW_CELLS else (lambda df: df)
        drawn = F.shiftrightunsigned(F.xxhash64(F.lit(number), "cell", "key"), 11) / float(1 << 53)
        sample = open_rows.join(hint(over), "cell").where(drawn < SAMPLE / F.col("count"))
        fits = scratch.write(
            sample.groupBy("cell").applyInArrow(
                fit, f"fitted bigint, fit binary, centre {kind}"
            ),
            "fits",
        )
        if splits.balls:
            balls.append(fits.where("centre IS NOT NULL").select(F.col("fitted").alias("cell"), "centre"))
        # A cell without a fit (no row drawn) waits for the next round's draw.
        joined = rows.join(hint(fits.drop("centre")), (F.col("cell") == F.col("fitted")) & ~F.col("final"), "left")
        before = scratch.paths.pop("cells", [])
        moved = scratch.write(joined.mapInArrow(move, schema), "cells")
        scratch.paths["old"] = before
        scratch.drop("old", "over", clean=False)
        rows = moved
    return rows.select("key", "cell", "off"), balls, number == 0


def _leaf_links(min_cosine: float):
    """Links of one leaf (or of two of its blocks) that no earlier leaf has counted."""
    angle = math.acos(min_cosine)

    def run(table: pa.Table) -> pa.Table:
        names = table["key"].combine_chunks()
        rows, weight, radius = unit_rows(table["vector"]), table["weight"].to_numpy(), table["radius"].to_numpy()
        block, first, second = table["block"].to_numpy(), table["first"][0].as_py(), table["second"][0].as_py()
        seen = table["seen"].combine_chunks()
        owner = np.repeat(np.arange(len(rows)), np.diff(seen.offsets.to_numpy()))
        leaves, place = np.unique(np.asarray(seen.flatten(), np.int64), return_inverse=True)
        held = np.zeros((len(rows), max(1, len(leaves))), np.float32)
        held[owner, place] = 1
        left = np.flatnonzero(block == first)
        right = np.flatnonzero(block == second)
        n = np.zeros(len(rows), np.int64)
        label = np.arange(len(rows))
        ball = radius > 0
        edges, wide = [], []
        for at in range(0, len(left), 256):
            own = left[at : at + 256]
            cosine = rows[own] @ rows[right].T
            bound = min_cosine
            if ball.any():
                bound = np.where(
                    ball[own][:, None] | ball[right][None, :],
                    np.cos(np.minimum(angle + radius[own][:, None] + radius[right][None, :] + 1e-9, math.pi)),
                    min_cosine,
                )
            fresh = (cosine >= bound) & (held[own] @ held[right].T == 0)
            if first == second:
                fresh &= own[:, None] < right[None, :]
            a, b = np.nonzero(fresh)
            if not len(a):
                continue
            single = ~(ball[own[a]] | ball[right[b]])
            wide += [(own[x], right[y], cosine[x, y]) for x, y in zip(a[~single], b[~single])]
            a, b = own[a[single]], right[b[single]]
            np.add.at(n, a, weight[b])
            np.add.at(n, b, weight[a])
            edges.append((a, b))
        if edges:
            a, b = (np.concatenate(x) for x in zip(*edges))
            while True:
                low = np.minimum(label[a], label[b])
                before = label.copy()
                np.minimum.at(label, a, low)
                np.minimum.at(label, b, low)
                label = label[label]
                if (label == before).all():
                    break
        linked = np.flatnonzero(n)
        x = np.array([w[0] for w in wide], np.int64)
        y = np.array([w[1] for w in wide], np.int64)
        none = pa.nulls(len(linked), pa.float64())
        return pa.table(
            {
                "key": pa.concat_arrays([names.take(pa.array(linked)), names.take(pa.array(x))]),
                "n": pa.concat_arrays([pa.array(n[linked], pa.int64()), pa.nulls(len(x), pa.int64())]),
                "other": pa.concat_arrays([names.take(pa.array(label[linked])), names.take(pa.array(y))]),
                "cosine": pa.concat_arrays([none, pa.array([w[2] for w in wide], pa.float64())]),
                "radius": pa.array(np.concatenate([np.zeros(len(linked)), radius[x]]), pa.float64()),
                "weight": pa.array(np.concatenate([np.zeros(len(linked), np.int64), weight[x]]), pa.int64()),
                "other_radius": pa.array(np.concatenate([np.zeros(len(linked)), radius[y]]), pa.float64()),
                "other_weight": pa.array(np.concatenate([np.zeros(len(linked), np.int64), weight[y]]), pa.int64()),
            }
        )

    return run


_LINKS = (
    "key string, n bigint, other string, cosine double, radius double, weight bigint, "
    "other_radius double, other_weight bigint"
)


def _blocks(size: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(BLOCK))).cast("int")


def _compare(scratch: Scratch, points: DataFrame, min_cosine: float) -> DataFrame:
    """Links inside the leaves of ``own`` that none of ``seen`` has."""
    placed = points.select(
        "key", "vector", "weight", "radius", F.explode("own").alias("leaf"),
        F.col("seen").alias("before"), "own",
    )
    sizes = scratch.write(points.select(F.explode("own").alias("leaf")).groupBy("leaf").count().where(F.col("count") > BLOCK), "sizes")
    placed = placed.withColumn("seen", F.concat("before", F.filter("own", lambda x: x < F.col("leaf")))).drop("before", "own")
    if sizes.isEmpty():
        placed = placed.withColumns({c: F.lit(0) for c in ("block", "first", "second")})
    else:
        placed = (
            placed.join(sizes, "leaf", "left")
            .withColumn("blocks", _blocks(F.coalesce("count", F.lit(1))))
            .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("first", F.least("block", "with"))
            .withColumn("second", F.greatest("block", "with"))
            .drop("count", "blocks", "with")
        )
    return placed.groupBy("leaf", "first", "second").applyInArrow(_leaf_links(min_cosine), _LINKS)


def _cross(min_cosine: float):
    """Links between some members of a ball and some visitors of it."""

    def run(table: pa.Table) -> pa.Table:
        names = table["key"].combine_chunks()
        rows, weight = unit_rows(table["vector"]), table["weight"].to_numpy()
        visits = table["visits"].to_numpy(zero_copy_only=False).astype(bool)
        home, guest = np.flatnonzero(~visits), np.flatnonzero(visits)
        n = np.zeros(len(rows), np.int64)
        for at in range(0, len(home), 256):
            own = home[at : at + 256]
            linked = (rows[own] @ rows[guest].T >= min_cosine).astype(np.int64)
            n[own] += linked @ weight[guest]
            n[guest] += linked.T @ weight[own]
        found = np.flatnonzero(n)
        at = pa.array(found)
        return pa.table({"key": names.take(at), "point": table["point"].combine_chunks().take(at),
                         "home": table["home"].combine_chunks().take(at), "n": pa.array(n[found], pa.int64())})

    return run


def near_vectors(
    vectors: DataFrame, min_cosine: float = 0.95, trees: int = 6, leaf: int = LEAF
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding)."""
    scratch = Scratch(vectors.sparkSession, "forest")
    value = F.col("embedding")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    valid = value.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(value, lambda x: x != 0)
    key = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), value)), 16, "0") for i in (1, 2)])
    rows = scratch.write(vectors.select("vec_id", "embedding", F.when(valid, key).alias("key")), "rows")
    reps = scratch.write(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.first("embedding").alias("vector"), F.count("*").alias("weight"), F.min("vec_id").alias("least")),
        "reps",
    )
    bare = reps.select("key", "vector", F.lit(0.0).alias("radius"))
    cells, balls, _ = _grow(scratch, bare, 0, _Splits(min_cosine, 4 * leaf, spill=False, balls=True))
    members = scratch.write(
        cells.where("off IS NOT NULL")
        .select("key", F.concat(F.lit("ball"), F.hex("cell")).alias("ball"), "cell", "off")
        .join(reps, "key"),
        "members",
    )
    single = reps.select("key", "vector", F.lit(0.0).alias("radius"), "weight", "least")
    points = single
    if balls and not members.isEmpty():
        centres = balls[0]
        for more in balls[1:]:
            centres = centres.unionByName(more)
        held = members.groupBy("cell", "ball").agg(
            F.max("off").alias("radius"), F.sum("weight").alias("weight"), F.min("least").alias("least"), F.count("*").alias("size")
        )
        # A ball of equal directions has no width; its margin keeps it apart from single vectors.
        whole = scratch.write(
            held.join(centres, "cell").select(
                F.col("ball").alias("key"), F.col("centre").alias("vector"),
                (F.col("radius") + 1e-9).alias("radius"), "weight", "least", "size",
            ),
            "balls",
        )
        points = single.join(members.select("key"), "key", "left_anti").unionByName(whole.drop("size"))
    points = scratch.write(points.withColumn("seen", F.array().cast("array<bigint>")), "points0")
    found = []
    for tree in range(1, trees + 1):
        leaves, _, uncut = _grow(scratch, points, tree, _Splits(min_cosine, leaf, spill=True, balls=False))
        own = leaves.groupBy("key").agg(F.collect_set("cell").alias("own"))
        placed = scratch.write(points.join(own, "key"), f"placed{tree}")
        if tree > 1:
            scratch.drop("fits", clean=False)
        scratch.drop("cells", f"points{tree - 1}")
        found.append(scratch.write(_compare(scratch, placed, min_cosine), "links"))
        points = placed.withColumn("seen", F.concat("seen", "own")).drop("own")
        # One leaf holds all vectors of a length: another tree would find nothing more.
        if uncut or tree == trees:
            break
        points = scratch.write(points, f"points{tree}")
        scratch.drop(f"placed{tree}", clean=False)
    links = vectors.sparkSession.read.schema(found[0].schema).parquet(*scratch.paths["links"])
    return _results(scratch, rows, reps, points, members, links, min_cosine)


def _results(scratch, rows, reps, points, members, links, min_cosine) -> DataFrame:
    angle = math.acos(min_cosine)
    plain = links.where("cosine IS NULL")
    counts = plain.select("key", "n")
    edges = plain.select("key", "other")
    by_member = None
    wide = links.where("cosine IS NOT NULL")
    if not wide.isEmpty():
        apart = F.acos(F.least(F.col("cosine"), F.lit(1.0)))
        both = F.col("radius") + F.col("other_radius")
        wide = scratch.write(wide.withColumn("whole", apart + both <= angle - 1e-9), "wide")
        linked = wide.where("whole")
        counts = counts.unionByName(linked.select("key", F.col("other_weight").alias("n"))).unionByName(
            linked.select(F.col("other").alias("key"), F.col("weight").alias("n"))
        )
        edges = edges.unionByName(linked.select("key", "other"))
        part = wide.where("NOT whole")
        if not part.isEmpty():
            by_member = scratch.write(_part_links(scratch, part, points, members, min_cosine), "part")
            counts = counts.unionByName(by_member.where("point = key").select("key", "n"))
            edges = edges.unionByName(by_member.select(F.col("point").alias("key"), F.col("home").alias("other")).where("key <> other"))
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"))
    groups = components(edges, "key", "other")
    # What holds for a point: links with points, its component, the least id of the component.
    known = scratch.write(
        points.select("key", "weight", "least")
        .join(counts, "key", "left")
        .join(groups.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key")),
        "known",
    )
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("key", F.coalesce("n", F.lit(0)).alias("n"), "weight", "component_id")
    placed = members.select("key", F.col("weight").alias("own"), "ball")
    if by_member is not None:
        inside = by_member.where("point <> key").groupBy("key").agg(F.sum("n").alias("inside"))
        placed = placed.join(inside, "key", "left")
    else:
        placed = placed.withColumn("inside", F.lit(0).cast("bigint"))
    held = placed.join(known.withColumnRenamed("key", "ball"), "ball").select(
        "key",
        (F.col("n") + F.coalesce("inside", F.lit(0)) + F.col("weight") - F.col("own")).alias("n"),
        F.col("own").alias("weight"),
        "component_id",
    )
    every = known.where(~F.col("key").startswith("ball")).unionByName(held)
    joined = rows.select("vec_id", "key").join(every, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce(F.col("n") + F.col("weight") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _part_links(scratch, part, points, members, min_cosine) -> DataFrame:
    """Member by member: a ball (home) against the vectors (visitors) that only some of it may link with."""
    is_ball = F.col("radius") > 0
    other_ball = F.col("other_radius") > 0
    home_first = is_ball & (~other_ball | (F.col("key") < F.col("other")))
    pairs = part.select(
        F.when(home_first, F.col("key")).otherwise(F.col("other")).alias("home"),
        F.when(home_first, F.col("other")).otherwise(F.col("key")).alias("point"),
        F.when(home_first, other_ball).otherwise(is_ball).alias("many"),
    )
    alone = pairs.where("NOT many").join(
        points.select(F.col("key").alias("point"), "vector", "weight"), "point"
    ).select("home", "point", F.col("point").alias("key"), "vector", "weight")
    many = pairs.where("many").join(
        members.select(F.col("ball").alias("point"), "key", "vector", "weight"), "point"
    ).select("home", "point", "key", "vector", "weight")
    visitors = scratch.write(alone.unionByName(many), "visitors")
    sizes = (
        visitors.groupBy("home").agg(_blocks(F.count("*")).alias("guest_blocks"))
        .join(members.groupBy(F.col("ball").alias("home")).agg(_blocks(F.count("*")).alias("home_blocks")), "home")
    )
    hosts = members.select(F.col("ball").alias("home"), F.col("ball").alias("point"), "key", "vector", "weight")

    def dealt(df, own, other, visits):
        return (
            df.join(sizes, "home")
            .withColumn(own, F.pmod(F.xxhash64("key"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .withColumn("visits", F.lit(visits))
            .select("home", "point", "key", "vector", "weight", "visits", "home_block", "guest_block")
        )

    met = dealt(hosts, "home_block", "guest_block", False).unionByName(dealt(visitors, "guest_block", "home_block", True))
    return met.groupBy("home", "home_block", "guest_block").applyInArrow(
        _cross(min_cosine), "key string, point string, home string, n bigint"
    )


# Brute force; what the forest may miss is not in it.
FOREST_SQL = """
WITH RECURSIVE
rows AS (SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
valid AS (
  SELECT row, v FROM rows
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(v, v) > 0),
links AS (
  SELECT a.row AS a, b.row AS b FROM valid a JOIN valid b ON a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95),
reach AS (SELECT a AS origin, b AS row FROM links UNION SELECT reach.origin, links.b FROM reach JOIN links ON links.a = reach.row),
least AS (SELECT origin, min(vec_id) AS other FROM reach JOIN rows ON rows.row = reach.row GROUP BY origin),
found AS (
  SELECT rows.row, vec_id, (SELECT count(*) FROM links WHERE a = rows.row) AS n_links, least(vec_id, other) AS component_id
  FROM rows LEFT JOIN least ON origin = rows.row)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM found
"""
