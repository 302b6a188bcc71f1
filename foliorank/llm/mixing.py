"""Mixing sources to target weights, in DataFrame functions alone.

A source's target is its share of the budget by weight, but no more than
``max_epochs`` times its size; what a clamped source cannot take goes to the others
by weight, until no target is above its limit. Sorted by the weight-scaled limit,
that end state has a closed form: clamping happens to a prefix, and the level of
the rest follows from running sums. So one window over the table of sources
replaces the rounds.

Inside a source, documents stand in the order of a seeded digest. All are taken
floor(target / size) times; the rest of the target is taken once more from the
front of that order, and the document in which it ends gives its first words
only. A source's taken words therefore equal its target to within a word, and a
task that runs again takes the same words.

The order is cut into 4,096 cells by the digest: cell sums are pre-aggregated, and
rows are ordered inside their own cell only, so a source with a third of all rows
is spread over 4,096 keys.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliorank.operators.grouping import hash_cell
from foliorank.storage import write_once

from .common import word_count

CELLS = 4096


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float
) -> DataFrame:
    """Targets of sources (source, source_size): adds ``target``.

    Sources stand by code point, null last, and take the weights in turn. The two
    windows without a partition hold one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    limit = F.lit(float(max_epochs)) * F.col("source_size")
    ranked = sizes.withColumn("_weight", weight).withColumn("_limit", limit)
    by_level = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    levels = ranked.withColumn("_budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    levels = levels.withColumn(
        "_level",
        (F.col("_budget") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        / F.sum("_weight").over(onwards),
    )
    # Levels rise while sources are clamped and fall after, so the highest level at which a
    # source stays below its limit is that of the first such source.
    fits = F.col("_level") * F.col("_weight") < F.col("_limit")
    level = F.max(F.when(fits, F.col("_level"))).over(everything)
    target = F.least("_limit", F.coalesce(level * F.col("_weight"), F.col("_limit")))
    return levels.select("source", "source_size", target.alias("target"))


def _draw(documents: DataFrame, seed: int) -> Column:
    """A row's place in its source: a hash of its id, or of its text where it has none.

    Rows without an id would otherwise all stand at one place, in one task.
    """
    own = F.coalesce(documents["text"], F.lit("")) if "text" in documents.columns else F.lit("")
    unnamed = F.concat_ws("|", F.lit(str(seed)), F.lit("text"), F.md5(own))
    named = F.concat_ws("|", F.lit(str(seed)), documents["doc_id"].cast("string"))
    return F.md5(F.when(documents["doc_id"].isNull(), unnamed).otherwise(named))


def mix(
    documents: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 11,
    size: Column | None = None,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per document: ``keep``, size, source_size, target and taken.

    Needs ``doc_id`` and ``source``, and ``text`` unless ``size`` is given. Null and
    empty texts have size 0 and are taken 0 times; a null source is a source of its
    own; a row without a doc_id is drawn by its text; rows that repeat are rows of
    their own. An empty table gives no rows. Working columns begin with an
    underscore and cannot meet those of ``keep``.
    """
    sized = write_once(
        documents.select(
            F.struct(*[documents[c] for c in keep]).alias("_kept"),
            documents["source"].alias("source"),
            (word_count(documents["text"]) if size is None else size.cast("bigint")).alias("size"),
            _draw(documents, seed).alias("_draw"),
        ),
        "mix",
    ).withColumn("_cell", hash_cell(F.col("_draw"), CELLS))
    cells = write_once(
        sized.groupBy("source", "_cell").agg(F.sum("size").alias("_words")), "mix_cells"
    )
    totals = cells.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(totals, weights, share, max_epochs)
    earlier = (
        Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = cells.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    plan = placed.alias("p").join(
        targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))
    ).select(
        F.col("p.source").alias("_source"),
        F.col("p._cell").alias("_at"),
        "_before",
        "source_size",
        "target",
    )
    in_cell = (
        Window.partitionBy("source", "_cell")
        .orderBy("_draw", "_kept", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized.withColumn("_inside", F.coalesce(F.sum("size").over(in_cell), F.lit(0)))
    joined = rows.join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_at"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(0)
    extra = F.round(F.col("target")).cast("bigint") - whole * F.col("source_size")
    room = extra - (F.col("_before") + F.col("_inside"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), room))
    return joined.select(
        *[F.col(f"_kept.{c}").alias(c) for c in keep],
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + part).cast("bigint").alias("taken"),
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('11|' || doc_id) AS draw
  FROM documents
), s AS (
  SELECT source, sum(size) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    least(cap, coalesce((SELECT max(level) FROM l x WHERE x.level * x.weight < x.cap) * weight, cap)) AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken
FROM p
"""
