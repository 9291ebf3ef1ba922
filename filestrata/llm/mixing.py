"""Mixing sources to target weights by capped water-filling. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
# A source's documents are cut into so many slices of the seeded order, so that
# one source's running sum is made from slice sums instead of in one task.
SLICES = 1024

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``weight`` and ``target`` of each source.

    Sources by code point, null last, take the weights in turn and share the
    total size. A target stops at ``max_epochs`` times its source's size; the
    excess goes to the others by weight until none is above. In the order of
    (cap / weight) the sources fill up one after the other, so the first source
    whose cap the water does not reach gives the level of all that follow.

    One row per source: the windows here run over that summary, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", (F.col("source_size") * max_epochs).alias("cap"),
        F.element_at(F.array(*map(F.lit, weights)),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
        .cast("bigint").alias("weight"))
    everything = Window.partitionBy(F.lit(1))
    filling = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    )
    feasible = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    return (
        sources.withColumn("level", level)
        .withColumn("water", F.max(feasible).over(everything))
        .select("source", "source_size", "weight",
                F.when(F.col("cap") / F.col("weight") < F.col("water"),
                       F.col("cap").cast("double"))
                .otherwise(F.col("weight") * F.col("water")).alias("target"))
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, row: str | None = None) -> DataFrame:
    """How often the mix takes each document.

    Returns per row of ``docs``: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target`` (its source's), ``repeats`` and ``taken``
    (repeats times size). Every document is repeated the whole number of times
    that target / source_size holds; for the fraction left, documents in the
    order of a seeded digest are taken once more until the source's sum is
    within half a document of its target. Nothing depends on how rows are
    partitioned, so reruns agree.

    Null texts and sources of size 0 have target 0 unless other documents fill
    the source; a null source is a source; an empty table gives no rows;
    repeated rows are mixed each for itself; other columns are ignored. ``row``
    names a column that tells rows apart and is returned as well; rows of one id
    and size are then in the order of their text's digest.
    """
    own = [F.col(row), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("tie")] if row else []
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = materialize(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("turn"),
                    *own),
        "mix-sizes",
    ).withColumn("slice", F.floor(F.conv(F.substring("turn", 1, 3), 16, 10).cast("int")
                                  * SLICES / 4096).cast("int"))
    targets = source_targets(sizes, weights, max_epochs).select(
        F.col("source").alias("t_source"), "source_size", "target")
    slices = sizes.groupBy(F.col("source").alias("s_source"), F.col("slice").alias("s_slice")).agg(
        F.sum("size").alias("slice_size"))
    in_order = Window.partitionBy("s_source").orderBy("s_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    slices = slices.withColumn("slices_before",
                               F.coalesce(F.sum("slice_size").over(in_order), F.lit(0)))
    slices = slices.join(targets, F.col("s_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    within = Window.partitionBy("source", "slice").orderBy("turn", "doc_id", "size", *["tie"] * bool(row)).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = sizes.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        slices, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                   ).otherwise(0)
    left = F.col("target") - F.col("whole") * F.col("source_size")
    more = (F.col("slices_before") + F.col("before") + F.col("size") / 2 < left).cast("bigint")
    return (
        placed.withColumn("whole", whole.cast("bigint")).withColumn("repeats", F.col("whole") + more)
        .select("doc_id", "source", "size", "source_size", "target", "repeats",
                (F.col("repeats") * F.col("size")).alias("taken"), *[row] * bool(row))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: each row as often as ``mix`` decided for
    that row. Rows are numbered and written first, so that both reads agree."""
    rows = materialize(docs.withColumn("m_row", F.monotonically_increasing_id()), "mix-rows")
    counts = mix(rows, row="m_row", **options).where("repeats > 0").select(
        "m_row", F.col("repeats").alias("m_repeats"))
    return (rows.join(counts, "m_row")
            .withColumn("m_copy", F.explode(F.sequence(F.lit(1), F.col("m_repeats").cast("int"))))
            .select(*docs.columns))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: weights 1, 2, 3 in turn, at most three epochs."""
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
with sizes as (
    select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), '')) as turn,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents),
named as (
    select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
           ((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::bigint as weight
    from sizes group by source),
levels as (
    select *, (sum(source_size) over ()
               - coalesce(sum(cap) over (filling rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(weight) over ()
               - coalesce(sum(weight) over (filling rows between unbounded preceding and 1 preceding), 0))::double as level
    from named window filling as (order by cap::double / weight, encode(source) nulls last)),
water as (
    select max(level) as water from levels where cap::double / weight >= level),
targets as (
    select source, source_size,
           case when cap::double / weight < water then cap::double else weight * water end as target
    from levels, water),
placed as (
    select s.doc_id, s.size, t.source_size, t.target,
           case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as whole,
           coalesce(sum(s.size) over (partition by s.source order by s.turn, s.doc_id, s.size
                                      rows between unbounded preceding and 1 preceding), 0) as before
    from sizes s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (whole * size + case when before + size / 2.0 < target - whole * source_size
                            then size else 0 end)::bigint as taken
from placed
"""
