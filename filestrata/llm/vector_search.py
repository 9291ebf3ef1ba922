"""Exact top-k inner products by a vector-approximation file.

Every component is quantised to one of a few cells between marks that hold for
the whole table; the cells are a file of their own. A query first scans the cells,
which bound its score with each vector from both sides, and keeps the vectors that
could be among its best. Exact vectors are then read by a join, for those vectors
only and from the largest upper bound down: first as many as are asked for, then
those whose bound reaches the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .common import partitions, read

TOP = 20
CELLS = 256
SCALE = 64
# Vectors of a block and queries of a block: they bound a task's memory.
BLOCK = 4096
# Vector blocks at most that one task scans for one block of queries.
GROUP = 16
# Queries whose bounds with a block are held at a time.
STEP = 256

_BLOCK_SCHEMA = ("block bigint, dim int, ids binary, rows binary, vectors binary, kind string, "
                 "low binary, high binary")


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of three types that holds them all."""
    most = np.abs(values).max(initial=0)
    return values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64)


def _blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Scaled integer vectors in blocks of one dimension, with their least and
    greatest components; vectors that may take no part are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, made, seen = TaskContext.get().partitionId(), {}, 0, 0

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, rows, values = zip(*held.pop(dim))
            values = np.array(values, np.float64).reshape(len(ids), dim)
            exact = _narrow(values)
            made += 1
            row = (part << 32 | made, dim, np.array(ids, np.int64).tobytes(),
                   np.array(rows, np.int64).tobytes(), exact.tobytes(), exact.dtype.name,
                   values.min(0).tobytes(), values.max(0).tobytes())
            return pa.RecordBatch.from_pydict({
                n: pa.array([v], t) for n, v, t in zip(
                    ("block", "dim", "ids", "rows", "vectors", "kind", "low", "high"), row,
                    (pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.string(), *[pa.binary()] * 2))})

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen += 1
                if vec_id is None or not vector.is_valid or vector.values.null_count:
                    continue
                exact = np.floor(vector.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if not np.isfinite(exact).all():
                    continue
                own = held.setdefault(len(exact), [])
                own.append((vec_id, part << 32 | seen, exact))
                if len(own) == BLOCK:
                    yield flush(len(exact))
        for dim in list(held):
            yield flush(dim)

    columns = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    return materialize(columns.mapInArrow(run, _BLOCK_SCHEMA), "vectors")


def _numbers(data: bytes, kind: str, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, dim)


def _steps(low: np.ndarray, high: np.ndarray, cells: int) -> np.ndarray:
    """Width of a component's cells, whole numbers."""
    return np.maximum(np.ceil((high / cells - low / cells) + 1 / cells), 1.0)


def _bounds(low: np.ndarray, step: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole numbers of the cells."""
    floor = low + cell * step
    ceil = floor + (step - 1)
    # Beyond exact whole numbers, cells reach a little further than their marks.
    slack = np.where(np.maximum(np.abs(low), np.abs(ceil).max(0, initial=0)) > 1 << 50,
                     np.abs(ceil) * 1e-12 + step, 0)
    return floor - slack, ceil + slack


def _ranges(blocks: DataFrame) -> DataFrame:
    """``dim``, ``m_low`` and ``m_high`` (arrays): the span of every component."""
    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = np.frombuffer(low), np.frombuffer(high)
                a, b = span.get(dim, (low, high))
                span[dim] = np.minimum(a, low), np.maximum(b, high)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(list(span), pa.int32()),
            "low": pa.array([a.tolist() for a, _ in span.values()], pa.list_(pa.float64())),
            "high": pa.array([b.tolist() for _, b in span.values()], pa.list_(pa.float64()))})

    # One value per dimension and component: its size is that of one vector. Vectors
    # without components have no marks, but they have a row.
    spans = blocks.select("dim", "low", "high").mapInArrow(
        marks, "dim int, low array<double>, high array<double>")
    found = F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "low", "high"))))
    return (spans.select("dim", F.posexplode_outer(F.arrays_zip("low", "high")).alias("at", "span"))
            .groupBy("dim", "at").agg(F.min("span.low").alias("low"), F.max("span.high").alias("high"))
            .groupBy("dim").agg(found.alias("m"))
            .select("dim", F.col("m.low").alias("m_low"), F.col("m.high").alias("m_high")))


def _exact_scores(wanted: DataFrame, blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """``row``, ``block``, ``place`` (as in ``wanted``) with ``query_id``, ``vec_id``,
    ``vec_row`` and the exact ``score``, read from the blocks of exact vectors."""
    asked = wanted.select("row", "block", "place").join(
        queries.select("row", "query_id", "query", F.col("kind").alias("q_kind")), "row")

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = {n: [] for n in ("vec_id", "vec_row", "score")}
        if len(asked):
            block = held.to_pylist()[0]
            ids, rows = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["rows"], np.int64)
            exact = _numbers(block["vectors"], block["kind"], block["dim"], len(ids))
            for place, query, kind in zip(asked["place"].to_pylist(), asked["query"].to_pylist(),
                                          asked["q_kind"].to_pylist()):
                found["vec_id"].append(ids[place])
                found["vec_row"].append(rows[place])
                found["score"].append(int(exact[place].astype(np.float64)
                                          @ np.frombuffer(query, kind).astype(np.float64)))
        return pa.table({**{n: asked[n] for n in ("query_id", "row", "block", "place")},
                         **{n: pa.array(v, pa.int64()) for n, v in found.items()}})

    return asked.groupBy("block").cogroup(
        blocks.select("block", "dim", "ids", "rows", "vectors", "kind").groupBy("block")).applyInArrow(
        score, "query_id bigint, row bigint, block bigint, place int, vec_id bigint, vec_row bigint, "
               "score bigint")


def _first(by: Column, *ties: str):
    return F.row_number().over(Window.partitionBy("row").orderBy(by.desc(), *ties))


def top_k(vectors: DataFrame, k: int = TOP, every: int = 20, scale: int = SCALE,
          cells: int = CELLS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's best.

    Components count as ``floor(scale * x)``. Queries are the rows whose
    ``vec_id`` is divisible by ``every``; their candidates are all other rows
    with as many components. Best is the largest inner product, then the
    smaller ``vec_id``; fewer candidates give fewer rows. Null vectors, null or
    non-finite components and null ids take no part; vectors without components
    score 0 with each other; repeated rows count each for itself (a copy of a
    query is a candidate, and a query of its own); an empty table gives no rows;
    other columns are ignored. ``cells`` is at most 256. Scores are exact while
    they are below 2**53.
    """
    blocks = _blocks(vectors, scale)

    def quantise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for dim, ids, data, kind, low, high in zip(*(batch.column(n).to_pylist() for n in (
                    "dim", "ids", "vectors", "kind", "m_low", "m_high"))):
                low, high = np.array(low, np.float64), np.array(high, np.float64)
                exact = _numbers(data, kind, dim, len(ids) // 8).astype(np.float64)
                cell = np.floor((exact - low) / _steps(low, high, cells))
                coded.append(np.clip(cell, 0, cells - 1).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("block", "dim", "rows", "m_low", "m_high")]
                + [pa.array(coded, pa.binary())],
                names=["block", "dim", "rows", "m_low", "m_high", "cells"])

    approximated = materialize(
        blocks.select("block", "dim", "ids", "rows", "vectors", "kind").join(_ranges(blocks), "dim").mapInArrow(
            quantise, "block bigint, dim int, rows binary, m_low array<double>, m_high array<double>, "
                      "cells binary"), "approximations")

    def queries_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, rows, data, kind in zip(*(c.to_pylist() for c in batch.columns)):
                ids, rows = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64)
                chosen = np.flatnonzero(ids % every == 0)
                values = _numbers(data, kind, dim, len(ids))[chosen]
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim] * len(chosen), pa.int32()),
                    "query_id": pa.array(ids[chosen]), "row": pa.array(rows[chosen]),
                    "query": pa.array([v.tobytes() for v in values], pa.binary()),
                    "kind": pa.array([kind] * len(chosen), pa.string())})

    queries = materialize(blocks.select("dim", "ids", "rows", "vectors", "kind").mapInArrow(
        queries_of, "dim int, query_id bigint, row bigint, query binary, kind string"), "queries")
    # Both sides are dealt to every (block of queries, group of vector blocks):
    # the query set is compared with all rows, block by block. Small tables are
    # dealt out to about as many tasks as there are blocks.
    sides = max(1, -(-queries.count() // BLOCK))
    n_blocks = approximated.count()
    groups = max(1, -(-n_blocks // GROUP), min(n_blocks, -(-partitions(vectors.sparkSession) // sides)))
    numbers = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    asked = queries.withColumn("side", F.pmod(F.xxhash64("row"), F.lit(sides)).cast("int")).select(
        "*", numbers(groups, "group"))
    scanned = approximated.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
                                      ).select("*", numbers(sides, "side"))

    def scan(asked: pa.Table, scanned: pa.Table) -> pa.Table:
        found = {n: [] for n in ("row", "block", "place", "lower", "upper")}
        for dim in set(asked["dim"].to_pylist()) & set(scanned["dim"].to_pylist()):
            wanted = asked.filter(pa.compute.equal(asked["dim"], dim))
            q = np.array([np.frombuffer(v, t).astype(np.float64) for v, t in zip(
                wanted["query"].to_pylist(), wanted["kind"].to_pylist())]).reshape(len(wanted), dim)
            own = wanted["row"].to_numpy()
            # A query's k best lower bounds so far; no vector below the last can be needed.
            least = np.full((len(q), k), -np.inf)
            for block in scanned.filter(pa.compute.equal(scanned["dim"], dim)).to_pylist():
                rows = np.frombuffer(block["rows"], np.int64)
                low, high = np.array(block["m_low"], np.float64), np.array(block["m_high"], np.float64)
                cell = _numbers(block["cells"], "uint8", dim, len(rows))
                floor, ceil = _bounds(low, _steps(low, high, cells), cell)
                middle, half = (ceil + floor) / 2, (ceil - floor) / 2
                for at in range(0, len(q), STEP):
                    part = q[at:at + STEP]
                    centre, reach = part @ middle.T, np.abs(part) @ half.T
                    # What rounding of large sums could hide.
                    reach += np.abs(centre) * 1e-12
                    lower, upper = centre - reach, centre + reach
                    mine = own[at:at + STEP, None] == rows[None, :]
                    lower[mine], upper[mine] = -np.inf, -np.inf
                    best = np.concatenate([least[at:at + STEP], lower], 1)
                    least[at:at + STEP] = -np.partition(-best, k - 1, 1)[:, :k]
                    certain = least[at:at + STEP].min(1)
                    who, place = np.nonzero((upper >= certain[:, None]) & ~mine)
                    found["row"].append(own[at + who])
                    found["block"].append(np.full(len(who), block["block"]))
                    found["place"].append(place)
                    found["lower"].append(lower[who, place])
                    found["upper"].append(upper[who, place])
        kinds = {"row": pa.int64(), "block": pa.int64(), "place": pa.int32(),
                 "lower": pa.float64(), "upper": pa.float64()}
        return pa.table({n: pa.array(np.concatenate(v) if v else [], kinds[n]) for n, v in found.items()})

    able = asked.groupBy("side", "group").cogroup(scanned.groupBy("side", "group")).applyInArrow(
        scan, "row bigint, block bigint, place int, lower double, upper double")
    # Over all groups: the k-th best lower bound of a query is certain.
    able = (able.withColumn("nth", _first(F.col("lower"), "block", "place"))
            .withColumn("certain", F.max(F.when(F.col("nth") == k, F.col("lower"))).over(
                Window.partitionBy("row")))
            .where(F.col("certain").isNull() | (F.col("upper") >= F.col("certain"))))
    able = materialize(able.withColumn("turn", _first(F.col("upper"), "block", "place"))
                       .select("row", "block", "place", "upper", "turn"), "candidates")
    # Exact vectors in the order of their bounds: the first k, then whatever still can
    # reach the k-th score (or tie with it).
    read_first = materialize(_exact_scores(able.where(F.col("turn") <= k), blocks, queries), "read")
    kth = read_first.groupBy("row").agg(F.min("score").alias("kth"))
    rest = able.where(F.col("turn") > k).join(kth, "row").where(F.col("upper") >= F.col("kth"))
    near = read_first.unionByName(_exact_scores(rest, blocks, queries))
    return near.withColumn("rank", _first(F.col("score"), "vec_id", "vec_row")).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_vector_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all embeddings for each query row."""
    return top_k(read(spark, sf_dir, "embeddings"))


OP8_SQL = """
with vectors as (
    select vec_id, [floor(64 * x::double) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (
    select q.vec_id as query_id, c.vec_id,
           list_inner_product(q.v, c.v)::bigint as score
    from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 20 = 0),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
    from scores)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
"""
