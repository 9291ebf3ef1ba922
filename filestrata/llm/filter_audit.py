"""How filters of documents interact, for every order they could be applied in.

Every document gets a mask: one bit for each filter that it fails. Documents are
counted by part and mask, which leaves at most 32 cells a part. A walk through
all sets of active filters in Gray-code order toggles one filter at a time: each
cell counts how many active filters it fails, and leaves or joins the survivors
as that counter leaves or reaches zero. The 32 states the walk stores answer every
order: a step removes the difference of two of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

SPACE = r"[\x20\x09-\x0D]+"
# A: shorter than this. B: fewer than this share of distinct words, in percent.
# C: more than this share of capitals, in percent. D: holds one of these.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, "[#$%&*|]"
# The name of the filter that looks for earlier copies.
COPIES = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides, by name of the filter."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def failing_masks(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part`` and ``mask`` of every document; bit 0 is the first filter.

    Texts are read once. What finds copies moves digests, not texts; only texts
    that occur with several ids are joined back, from a written table, so that
    a text that a third of all rows share can be split.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_filters(text).values())]
    rows = materialize(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).cast("int").alias("own"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "filter-rows")
    first = materialize(
        rows.groupBy(F.col("digest").alias("c_digest")).agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("last > first").select("c_digest", "first"), "filter-copies")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(first, rows["digest"] == first["c_digest"], "left").select(
        "doc_id", "part", (F.col("own") + F.when(later, 1 << len(bits)).otherwise(0)).alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask``, ``n``, ``good`` and ``toxic``: documents of each cell, and
    how many of them a label calls good or toxic."""
    said = labels.select(
        F.col("doc_id").cast("bigint").alias("l_doc"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"))
    # Written, so that an id that many rows share can be split.
    said = materialize(
        said.where("l_doc is not null and good + toxic > 0").groupBy("l_doc").agg(
            F.max("good").alias("good"), F.max("toxic").alias("toxic")), "filter-labels")
    return masks.join(said, masks["doc_id"] == said["l_doc"], "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("good", "toxic")])


def gray_walk(cells: Sequence[tuple], filters: int) -> list[list[int]]:
    """Survivors of every set of active filters, by the set as a number.

    ``cells`` are ``(mask, amount, ...)``; a state is the list of what is left of
    each amount.
    """
    failed = [0] * len(cells)
    left = [sum(c[i] for c in cells) for i in range(1, len(cells[0]))]
    states = {0: list(left)}
    active = 0
    for turn in range(1, 1 << filters):
        bit = turn & -turn
        active ^= bit
        change, edge = (1, 1) if active & bit else (-1, 0)
        for i, (mask, *amounts) in enumerate(cells):
            if mask & bit:
                failed[i] += change
                if failed[i] == edge:
                    left = [a - change * b for a, b in zip(left, amounts)]
        states[active] = left
    return [states[s] for s in range(1 << filters)]


def filter_states(cells: DataFrame, filters: int) -> DataFrame:
    """``part`` with the survivors of each set of filters: arrays ``kept``, ``good``
    and ``toxic``, at the place that the set has as a number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = [gray_walk([tuple(c.values()) for c in own], filters)
                      for own in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([[s[i] for s in own] for own in states],
                                             pa.list_(pa.int64())) for i in range(3)]],
                names=["part", "kept", "good", "toxic"])

    # At most one cell for each set of filters: a bounded list.
    own = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    arrays = ", ".join(f"{c} array<bigint>" for c in ("kept", "good", "toxic"))
    return own.mapInArrow(run, f"part string, {arrays}")


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every order of the filters, for each part of the documents.

    Returns per ``part`` (language; null counts as ""), ``filter_order`` and ``step``
    the documents ``kept`` after the step, ``removed`` by it, ``redundant`` (they fail
    its filter, but are gone), ``unique_fails`` (they fail no other filter),
    ``good_lost`` and ``toxic_lost`` (removed ones with such a label), and
    ``shapley``: what its filter removes, summed over all orders.

    A null text is empty: it fails A alone, and E if an earlier document is empty
    too. A document without an id has no earlier copy and no label; rows that
    share an id are not each other's copies, but count and have labels one by one. Of
    several labels of an id each counts that says yes. An empty table has no
    parts, so no rows. Other columns are ignored.
    """
    names = [*text_filters(F.lit("")), COPIES]
    orders = []
    for order in permutations(range(len(names))):
        gone = 0
        for step, i in enumerate(order, 1):
            orders.append({"filter_order": "".join(names[j] for j in order), "step": step,
                           "bit": 1 << i, "before": gone, "after": gone | 1 << i})
            gone |= 1 << i
    # As many rows as there are steps, whatever the data: a constant.
    steps = F.from_json(F.lit(json.dumps(orders)),
                        "array<struct<filter_order:string,step:int,bit:int,before:int,after:int>>")
    states = filter_states(mask_cells(failing_masks(docs), labels), len(names))
    every = (1 << len(names)) - 1

    def at(array: str, place: Column) -> Column:
        return F.get(array, place)

    def lost(array: str) -> Column:
        return at(array, F.col("before")) - at(array, F.col("after"))

    failing = at("kept", F.lit(0)) - at("kept", F.col("bit"))
    only = at("kept", F.lit(every) - F.col("bit")) - at("kept", F.lit(every))
    # A set without the filter stands before it in so many orders.
    orders_before = F.expr(
        f"aggregate(sequence(0, {every}), 0L, (total, s) -> total + if((s & bit) = 0, "
        f"(kept[s] - kept[s | bit]) * factorial(bit_count(s)) * factorial({len(names) - 1} - bit_count(s)), 0L))")
    return (
        states.select("part", "kept", "good", "toxic", F.inline(steps))
        .select("part", "filter_order", "step", at("kept", F.col("after")).alias("kept"),
                lost("kept").alias("removed"), (failing - lost("kept")).alias("redundant"),
                only.alias("unique_fails"), lost("good").alias("good_lost"),
                lost("toxic").alias("toxic_lost"), orders_before.alias("shapley"))
    )


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All 120 orders of the five filters, over all documents."""
    return filter_interactions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP13_SQL = r"""
with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents),
firsts as (select body, min(doc_id) as first_id from texts group by body),
marks as (
    select doc_id, part, len(words) < 100 as a,
           100 * len(list_distinct(words)) < 80 * len(words) as b,
           100 * length(regexp_replace(t.body, '[^A-Z]', '', 'g')) > 10 * length(t.body) as c,
           regexp_matches(t.body, '[#$%&*|]') as d, coalesce(doc_id > first_id, false) as e
    from texts t join firsts f on t.body = f.body),
said as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
           max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels group by doc_id),
fails as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} as failed
    from marks left join said using (doc_id)),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from letters a join letters b on b.x <> a.x join letters c on c.x not in (a.x, b.x)
    join letters d on d.x not in (a.x, b.x, c.x) join letters e on e.x not in (a.x, b.x, c.x, d.x)),
steps as (
    select filter_order, step::integer as step, filter_order[step] as own, filter_order[1:step - 1] as earlier
    from orders, range(1, 6) r(step)),
cells as (
    select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic
    from fails group by part, failed),
marked as (
    select part, filter_order, step, own, n, good, toxic, failed[own] as fails_own,
           len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: failed[x])) = 1 as alone,
           len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: failed[x] and contains(earlier, x))) > 0 as gone
    from cells, steps),
rows as (
    select part, filter_order, step, own,
           coalesce(sum(n) filter (not gone and not fails_own), 0)::bigint as kept,
           coalesce(sum(n) filter (not gone and fails_own), 0)::bigint as removed,
           coalesce(sum(n) filter (gone and fails_own), 0)::bigint as redundant,
           coalesce(sum(n) filter (fails_own and alone), 0)::bigint as unique_fails,
           coalesce(sum(good) filter (not gone and fails_own), 0)::bigint as good_lost,
           coalesce(sum(toxic) filter (not gone and fails_own), 0)::bigint as toxic_lost
    from marked group by part, filter_order, step, own)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from rows
"""
