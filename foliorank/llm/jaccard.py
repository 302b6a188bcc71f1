"""N-gram Jaccard join in the metric space of Jaccard distance.

Jaccard distance is a metric, so distances to pivots bound all others. But unrelated
documents all have distance 1, which tells a pivot nothing; pivots are therefore
placed where distances are informative, inside cells of documents that share
rare shingles:

1. Equal sets are one document. A set's prefix (its first shingles in one global
   order, frequent ones last) is longer than a join needs, so that two linked sets
   must share several prefix shingles. Sets that share too few leave at once, and
   each set drops its most frequent cells as far as that slack allows.
2. Each cell's smallest member is a pivot; a region is a pivot with all members of
   its cells. Exact distances to the pivot split the region: the ball (linked to the
   pivot, so its members need no further look at each other) and the outside.
   Triangle-inequality windows keep of the ball only the boundary that an outside
   member could reach.
3. What is left joins recursively: large regions are cut by new pivots into Voronoi
   regions with boundary windows of twice the threshold, as Spark joins. Small ones
   go to one task from the start and are divided by the same recursion there. Regions that pivots cannot cut
   (all distances alike) are compared in pairs of blocks. No case is dropped.

Links between sets that other links already connect are not listed; components are
exact. Regions whose sets are connected need no further look.
"""

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, row_key
from .keysets import build_filter, lists, long_column, map_slices, may_hold, shared_keys
from .text_arrays import U, distinct_per_text, mix, split_words, sums_per_text, word_grams

FREQUENT_SHINGLES = 100_000  # at most so many are put last in the order; a hint, not a filter
REGION_ROWS = 512  # a region of up to so many sets is finished by one task
LEAF = 24
SLACK = 1e-9


def needed_overlap(n, numerator: int, denominator: int):
    """Least number of common shingles of a set of n with any set it is linked to."""
    return (numerator * n + denominator - 1) // denominator


def shared_in_prefix(n):
    """How many prefix shingles two linked sets share at least, the smaller having n."""
    return 1 + n // 10


class Sets:
    """Distinct shingle sets of a chunk of texts."""

    def __init__(self, data, offsets, k, frequent=None):
        values, owner = distinct_per_text(*word_grams(split_words(data, offsets), k))
        self.sizes = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
        self.values, self.owner = values, owner
        digest = mix(sums_per_text(mix(values ^ U(0x5851F42D4C957F2D)), self.sizes) ^ self.sizes.astype(np.uint64))
        self.digest = np.where(self.sizes > 0, digest, U(0)).view(np.int64)
        # The first text of each set in this chunk stands for it.
        self.leads = np.zeros(len(self.sizes), bool)
        self.leads[np.unique(self.digest, return_index=True)[1]] = True
        self.leads &= self.sizes > 0
        self.frequent = frequent

    def prefix(self, numerator, denominator):
        """Prefix shingles of every leading text and the text of each."""
        late = np.zeros(len(self.values), bool)
        if self.frequent is not None and len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, self.values), len(self.frequent) - 1)
            late = self.frequent[at] == self.values
        order = np.argsort(self.owner * 2 + late, kind="stable")
        n = self.sizes
        length = n - needed_overlap(n, numerator, denominator) + shared_in_prefix(n)
        length = np.where(self.leads, np.minimum(length, n), 0)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
        keep = rank < np.repeat(length, n)
        return self.values[order][keep], self.owner[order][keep]


def frequent_shingles(texts: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of frequent shingles, at most ``FREQUENT_SHINGLES``.

    Each task counts whole chunks and reports what it saw three times or more.
    Any list gives the same links; a good one keeps cells small.
    """

    def count(part, data, offsets):
        found = Sets(data, offsets, k)
        values = found.values[found.leads[found.owner]]
        shingles, counts = np.unique(values, return_counts=True)
        often = counts >= 3
        yield pa.RecordBatch.from_arrays(
            [long_column(shingles[often]), pa.array(counts[often], pa.int64())], ["key", "n"]
        )

    counted = map_slices(texts, "key long, n long", count, 2 << 20).groupBy("key").agg(F.sum("n").alias("n"))
    top = counted.where("n >= 20").orderBy(F.desc("n"), "key").limit(FREQUENT_SHINGLES).select("key").toArrow()
    return np.sort(top["key"].to_numpy().view(np.uint64))


def shingle_sets(
    texts: DataFrame, k: int, numerator: int, denominator: int, scratch: Scratch
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Per document (doc_id, row, g, n, keys), and a function that gives chosen sets whole.

    ``keys`` are filled only for sets that share enough prefix shingles with others to be
    linked, once per chunk and set.
    """
    context = texts.sparkSession.sparkContext
    frequent = context.broadcast(frequent_shingles(texts, k))

    def prefixes(part, data, offsets):
        found = Sets(data, offsets, k, frequent.value)
        keys, owner = found.prefix(numerator, denominator)
        yield pa.RecordBatch.from_arrays(
            [long_column(keys), long_column(found.digest[owner])], ["key", "owner"]
        )

    shared = scratch.write(shared_keys(map_slices(texts, "key long, owner long", prefixes)), "keys")
    passing = build_filter(shared)
    scratch.drop("keys")

    def rows(part, data, offsets):
        found = Sets(data, offsets, k, frequent.value)
        keys, owner = found.prefix(numerator, denominator)
        held = may_hold(passing.value, keys)
        keys, owner = keys[held], owner[held]
        counts = np.bincount(owner, minlength=len(found.sizes))
        need = shared_in_prefix(needed_overlap(found.sizes, numerator, denominator))
        chosen = found.leads & (counts >= need)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(part.schema.get_field_index("doc_id")),
                part.column(part.schema.get_field_index("row")),
                long_column(found.digest),
                pa.array(found.sizes, pa.int64()),
                lists(keys[chosen[owner]], np.where(chosen, counts, 0), ~chosen),
            ],
            ["doc_id", "row", "g", "n", "keys"],
        )

    schema = "doc_id long, row long, g long, n long, keys array<long>"
    sets = scratch.write(map_slices(texts, schema, rows), "sets")

    def whole(members: DataFrame) -> DataFrame:
        """(g, n, shingles) once for each set in ``members`` (g), and for few others."""
        wanted = build_filter(members.select(F.col("g").alias("key")))

        def pick(part, data, offsets):
            found = Sets(data, offsets, k)
            chosen = found.leads & may_hold(wanted.value, found.digest.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    long_column(found.digest[chosen]),
                    pa.array(found.sizes[chosen], pa.int64()),
                    lists(found.values[chosen[found.owner]], found.sizes[chosen]),
                ],
                ["g", "n", "shingles"],
            )

        picked = map_slices(texts, "g long, n long, shingles array<long>", pick)
        return picked.dropDuplicates(["g"])

    return sets, whole


def _need_column(numerator: int, denominator: int):
    overlap = F.floor((numerator * F.col("n") + denominator - 1) / denominator)
    return 1 + F.floor(overlap / 10)


def regions(sets: DataFrame, numerator: int, denominator: int, scratch: Scratch) -> DataFrame:
    """Members (region, g): a region is named by its pivot, the smallest set of a cell."""
    need = _need_column(numerator, denominator)
    keyed = sets.where("keys IS NOT NULL").select("g", "n", "keys").dropDuplicates(["g"])
    cells = scratch.write(keyed, "keyed").select("g", "n", F.explode("keys").alias("key"))
    sizes = cells.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # Both windows are over one set's prefix, bounded by the length of its text.
    by_set = Window.partitionBy("g")
    ranked = (
        cells.join(sizes, "key")
        .withColumn("_cells", F.count("*").over(by_set))
        .withColumn("_rank", F.row_number().over(by_set.orderBy(F.desc("members"), "key")))
    )
    kept = ranked.where((F.col("_cells") >= need) & (F.col("_rank") > F.floor((need - 1) / 2))).select("key", "g")
    kept = scratch.write(kept, "kept_cells")
    scratch.drop("keyed")
    pivots = kept.groupBy("key").agg(F.min("g").alias("region"), F.max("g").alias("last")).where("region < last")
    members = scratch.write(kept.join(pivots, "key").select("region", "g").distinct(), "regions")
    scratch.drop("kept_cells")
    return members


def _distances(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Adds inter and d for pairs (.., pivot, g) from the sets of both sides."""
    one = reps.select("g", F.col("n").alias("_n"), F.col("shingles").alias("_s"))
    two = reps.select(F.col("g").alias("pivot"), F.col("n").alias("_pn"), F.col("shingles").alias("_ps"))
    joined = pairs.join(one, "g").join(two, "pivot")
    inter = F.size(F.array_intersect("_s", "_ps")).cast("bigint")
    both = F.col("_n") + F.col("_pn") - F.col("inter")
    return (
        joined.withColumn("inter", inter)
        .withColumn("union", both)
        .withColumn("d", 1 - F.col("inter") / F.col("union"))
        .drop("_n", "_s", "_pn", "_ps")
    )


def _left_over(members: DataFrame, eps: float) -> DataFrame:
    """What pivots leave undecided of (region, g, d): the outside and the ball's boundary."""
    outside = F.col("d") > eps
    borders = members.groupBy("region").agg(
        F.min(F.when(outside, F.col("d"))).alias("_nearest"), F.count("*").alias("_all")
    )
    kept = (
        members.join(borders.where("_nearest IS NOT NULL"), "region")
        .where(outside | (F.col("d") >= F.col("_nearest") - eps - SLACK))
        .drop("_nearest", "_all")
    )
    sizes = kept.groupBy("region").count().where("count > 1").withColumnRenamed("count", "members")
    return kept.join(sizes, "region")


class Forest:
    """Groups of rows that links already connect; keeps the links that join two groups."""

    def __init__(self, labels: np.ndarray):
        self.label = np.unique(labels, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        """Link ``row`` to ``others``, one link for each group that is not its own."""
        groups, first = np.unique(self.label[others], return_index=True)
        fresh = groups != self.label[row]
        if fresh.any():
            self.links.extend((row, int(r)) for r in others[first[fresh]])
            self.label[np.isin(self.label, groups[fresh])] = self.label[row]


def _packed(tokens, starts, sizes, rows):
    """Tokens of some rows one after another, and where each row begins."""
    counts = sizes[rows]
    total = np.cumsum(counts)
    return tokens[np.arange(total[-1]) - np.repeat(total - counts - starts[rows], counts)], total - counts


def region_links(tokens, starts, sizes, labels, numerator, denominator):
    """Links between rows of one region, by recursive Voronoi regions.

    ``tokens`` are all sets one after another; rows with equal ``labels`` are connected
    already. Links that connect nothing new are left out.
    """
    eps = 1 - numerator / denominator
    _, tokens = np.unique(tokens, return_inverse=True)
    mark = np.zeros(len(tokens) + 1, bool)
    forest = Forest(labels)

    def against(pivot, rows, packed):
        own = tokens[starts[pivot] : starts[pivot] + sizes[pivot]]
        mark[own] = True
        inter = np.add.reduceat(mark[packed[0]].astype(np.int64), packed[1])
        mark[own] = False
        union = sizes[pivot] + sizes[rows] - inter
        forest.join(pivot, rows[denominator * inter >= numerator * union])
        return 1 - inter / union

    def scan(rows, d):
        order = np.argsort(d, kind="stable")
        rows, d = rows[order], d[order]
        for i in range(len(rows) - 1):
            stop = int(np.searchsorted(d, d[i] + eps + SLACK, "right"))
            apart = rows[i + 1 : stop]
            apart = apart[forest.label[apart] != forest.label[rows[i]]]
            if len(apart):
                against(int(rows[i]), apart, _packed(tokens, starts, sizes, apart))

    def resolve(rows):
        if len(rows) < 2 or (forest.label[rows] == forest.label[rows[0]]).all():
            return
        if len(rows) <= LEAF:
            scan(rows, np.zeros(len(rows)))
            return
        packed = _packed(tokens, starts, sizes, rows)
        pivots = rows[np.linspace(0, len(rows) - 1, min(8, math.isqrt(len(rows)))).astype(int)]
        d = np.stack([against(int(p), rows, packed) for p in pivots])
        nearest = d.min(0)
        rest = ~np.isin(rows, pivots)
        parts = []
        for i in range(len(pivots)):
            inside = rest & (d[i] <= nearest + 2 * eps + SLACK)
            own, at = rows[inside], d[i][inside]
            outside = at > eps
            if outside.any():
                keep = outside | (at >= at[outside].min() - eps - SLACK)
                parts.append(own[keep])
        if sum(map(len, parts)) > 1.5 * len(rows):
            scan(rows[rest], d[0][rest])
        else:
            for part in parts:
                resolve(part)

    resolve(np.arange(len(sizes)))
    return forest.links


def block_links(tokens, starts, sizes, labels, in_first, numerator, denominator):
    """Links between the rows of two blocks of a region."""
    _, tokens = np.unique(tokens, return_inverse=True)
    mark = np.zeros(len(tokens) + 1, bool)
    forest = Forest(labels)
    second = np.flatnonzero(~in_first)
    for i in np.flatnonzero(in_first):
        rows = second[forest.label[second] != forest.label[i]]
        if not len(rows):
            continue
        packed = _packed(tokens, starts, sizes, rows)
        own = tokens[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        inter = np.add.reduceat(mark[packed[0]].astype(np.int64), packed[1])
        mark[own] = False
        forest.join(i, rows[denominator * inter >= numerator * (sizes[i] + sizes[rows] - inter)])
    return [(int(a), b) for a, b in forest.links]


def _finish(members: DataFrame, reps: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links (a, b) inside regions: one task a region, or a pair of blocks of a large one."""
    blocks = F.ceil(F.col("members") / REGION_ROWS).cast("int")
    cut = members.select(
        "region", "g", "label", blocks.alias("blocks"), F.pmod(F.hash("g", F.lit("block")), blocks).alias("block")
    )
    # A member meets every block of its own region: its block is first in some pairs, second in others.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = cut.select("region", "g", "label", "block", "blocks", other).select(
        "region",
        "g",
        "label",
        "block",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
    )
    rows = dealt.join(reps, "g")

    def local(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["n"].to_numpy()
        tokens = np.concatenate(frame["shingles"].to_list())
        starts = np.cumsum(sizes) - sizes
        ids, block, labels = frame["g"].to_numpy(), frame["block"].to_numpy(), frame["label"].to_numpy()
        if frame["first"].iloc[0] == frame["second"].iloc[0]:
            found = region_links(tokens, starts, sizes, labels, numerator, denominator)
        else:
            in_first = block == frame["first"].iloc[0]
            found = block_links(tokens, starts, sizes, labels, in_first, numerator, denominator)
        return pd.DataFrame(
            {"a": ids[[i for i, _ in found]], "b": ids[[j for _, j in found]]}, dtype="int64"
        )

    return rows.groupBy("region", "first", "second").applyInPandas(local, "a long, b long")


def _still_apart(rest: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Regions of (region, g, d, members) whose sets the links do not connect yet; adds ``label``."""
    groups = components(links, "a", "b")
    labelled = rest.join(groups, F.col("g") == F.col("node"), "left").select(
        "region", "g", "d", "members", F.coalesce("component", "g").alias("label")
    )
    labelled = scratch.write(labelled, "labelled")
    apart = labelled.groupBy("region").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b")
    left = scratch.write(labelled.join(apart.select("region"), "region"), "left_over")
    scratch.drop("labelled")
    return left


def set_links(
    sets: DataFrame, whole: Callable[[DataFrame], DataFrame], numerator: int, denominator: int, scratch: Scratch
) -> DataFrame:
    """Links (a, b) between different sets, enough of them for exact components.

    A region of up to ``REGION_ROWS`` sets goes to one task as it is, so its sets are
    moved there once; larger ones are first cut by pivots as Spark joins.
    """
    members = regions(sets, numerator, denominator, scratch)
    counts = members.groupBy("region").agg(F.count("*").alias("members"))
    sized = scratch.write(members.join(counts, "region"), "sized")
    scratch.drop("regions")
    small = sized.where(F.col("members") <= REGION_ROWS).withColumn("label", F.col("g"))
    links = scratch.write(_finish(small, whole(small), numerator, denominator), "links")
    large = sized.where(F.col("members") > REGION_ROWS)
    if not large.isEmpty():
        links = links.unionByName(_large_links(large, whole, numerator, denominator, scratch))
    found = scratch.write(links, "all_links")
    scratch.drop("links", "distances", "left_over", "set_reps", "sized")
    return found


def _large_links(
    members: DataFrame, whole: Callable[[DataFrame], DataFrame], numerator: int, denominator: int, scratch: Scratch
) -> DataFrame:
    """Links inside regions (region, g) of more than ``REGION_ROWS`` sets."""
    eps = 1 - numerator / denominator
    reps = scratch.write(whole(members), "set_reps")
    linked = F.col("inter") * denominator >= F.col("union") * numerator
    pairs = members.where("region <> g").select("region", "g", F.col("region").alias("pivot"))
    measured = scratch.write(_distances(pairs, reps), "distances")
    links = measured.where(linked).select(F.col("pivot").alias("a"), F.col("g").alias("b"))
    links = scratch.write(links, "links")
    rest = _still_apart(_left_over(measured.select("region", "g", "d"), eps), links, scratch)
    scratch.drop("distances")
    for turn in range(4):
        large = rest.where(F.col("members") > REGION_ROWS)
        if large.isEmpty():
            break
        # Eight new pivots a region, by pre-aggregated minima over hash classes.
        pivots = large.groupBy("region", F.pmod(F.xxhash64("g", F.lit(turn)), F.lit(8)).alias("_c")).agg(
            F.min("g").alias("pivot")
        )
        pairs = large.select("region", "g").join(pivots.select("region", "pivot"), "region")
        measured = scratch.write(_distances(pairs, reps), "distances")
        links = links.unionByName(
            measured.where(linked & (F.col("g") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("g").alias("b"))
        )
        nearest = measured.groupBy("region", "g").agg(F.min("d").alias("_nearest"))
        windows = (
            measured.join(nearest, ["region", "g"])
            .where((F.col("d") <= F.col("_nearest") + 2 * eps + SLACK) & (F.col("_nearest") > 0))
            .select(F.xxhash64("region", "pivot").alias("region"), "g", "d")
        )
        cut = _still_apart(_left_over(windows, eps), links, scratch)
        before, after = large.count(), cut.count()
        if after > 2 * before:
            break
        rest = scratch.write(rest.where(F.col("members") <= REGION_ROWS).unionByName(cut), "left_over")
    finished = _finish(rest.select("region", "g", "label", "members"), reps, numerator, denominator)
    return links.unionByName(scratch.write(finished, "links"))


def jaccard_components(
    documents: DataFrame, k: int = 5, numerator: int = 80, denominator: int = 100
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and row, a key of the document row.

    Documents link when their sets of ``k``-word shingles (words by ASCII white space,
    A-Z lower-cased) have Jaccard similarity numerator / denominator or more. A text
    with fewer words is one shingle; null and empty texts have none, link with
    nothing and are their own component. ``component_id`` is the smallest doc_id
    reachable, null where no document reachable has an id; rows with equal ids stay rows
    of their own and link nothing by their id, and a null id takes part, as pivot or
    bridge too, without being anyone's component. An empty table gives no rows. Sets are
    compared by 64-bit hashes of their shingles. Texts of any length are hashed whole, a slice
    of about 1 MB at a time or one longer text, and other columns are not looked at.
    """
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"])
    texts = texts.withColumn("row", row_key("doc_id", "text"))
    scratch = Scratch(texts.sparkSession, "jaccard")
    sets, whole = shingle_sets(texts, k, numerator, denominator, scratch)
    found = set_links(sets, whole, numerator, denominator, scratch)
    narrow = sets.select("doc_id", "row", "g", "n")
    firsts = scratch.write(narrow.where("n > 0").groupBy("g").agg(F.min("doc_id").alias("rep")), "firsts")
    # Sets are the nodes, so a set that only rows without an id hold links others all the same.
    linked = firsts.join(components(found, "a", "b"), F.col("g") == F.col("node"), "left").select(
        "g", "rep", F.coalesce("component", "g").alias("component")
    )
    linked = scratch.write(linked, "linked")
    smallest = linked.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("_sets"))
    several = smallest.where("_sets > 1").select("component", "component_id")
    named = linked.join(several, "component", "left").select(
        "g", F.coalesce("component_id", "rep").alias("component_id")
    )
    return narrow.join(named.withColumnRenamed("g", "_g"), (F.col("g") == F.col("_g")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row"
    )


# Brute force over all pairs that share a shingle.
JACCARD_SQL = r"""
WITH RECURSIVE
words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT row, array_to_string(w[pos:pos + 3], ' ') AS gram
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS pos FROM words WHERE len(w) > 0)),
sizes AS (SELECT row, count(*) AS n FROM grams GROUP BY row),
met AS (
  SELECT a.row AS a, b.row AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.row < b.row GROUP BY a.row, b.row),
links AS (
  SELECT a, b FROM met JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS origin, b AS row FROM edges UNION SELECT origin, b FROM reach JOIN edges ON a = reach.row),
least AS (SELECT origin, min(doc_id) AS other FROM reach JOIN words USING (row) GROUP BY origin)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, other) AS component_id
FROM words LEFT JOIN sizes USING (row) LEFT JOIN least ON origin = row
"""
