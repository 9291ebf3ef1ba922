"""Near duplicates by DartMinHash signatures and banded joins.

A text is the set of its five-word shingles. Darts are thrown at the elements of
the set: where a dart lands is a hash of the element, so equal elements of two
sets get the same darts, and a set of total weight W needs darts only up to a
rank of about k ln k / W. The dart of the lowest rank at each of k coordinates
is the signature; two sets agree at a coordinate with a probability equal to
their weighted Jaccard similarity. Sets that agree in all rows of a band become
candidates; every link is verified on the sets themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import materialize
from .common import read

SHINGLE = 5
SIMILARITY = 0.8
# 32 bands of 6: a pair at 0.8 misses all of them with a probability below 1e-4.
BANDS = 32
ROWS = 6
# How often each text is tried against the most central text of its buckets.
HUB_ROUNDS = 3
# Buckets of more texts than this that are still unlike are not compared pair by pair but
# by how their texts differ from a central one.
PAIRWISE = 8
# Excess of a text over a pivot (see ``_apart``), in units of what a link to the pivot allows:
# texts meet by classes of it that begin here. Narrow ones let fewer pairs through.
EXCESS = tuple(float(low) for part in (np.arange(-1, 2, 0.125), np.arange(2, 4, 0.25), np.arange(4, 8, 0.5),
                                       np.arange(8, 18, 2)) for low in part)
# Elements and darts handled at a time: bounds a task's memory.
AT_ONCE = 500_000

_WORD = re.compile(r"\w+")
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x + _ODD[0]
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, and where each text's
    begin (with the total at the end).

    Words are lower-case runs of word signs. A text of fewer words than a
    shingle has them all as its one shingle; one without words has none.
    """
    lists = [_WORD.findall(t.lower()) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    words = pa.array([w for ws in lists for w in ws], pa.large_string()).dictionary_encode()
    hashed = np.fromiter((int.from_bytes(md5(w.encode()).digest()[:8], "little")
                          for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    sequence = hashed[words.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    # A shingle starts at each word that has size - 1 more in its text, and at
    # the first word of a shorter text.
    left = np.repeat(ends, counts) - np.arange(len(sequence))
    first = np.arange(len(sequence)) == np.repeat(ends - counts, counts)
    starts = np.flatnonzero((left >= size) | first)
    value = np.zeros(len(starts), np.uint64)
    for step in range(size):
        there = left[starts] > step
        word = np.where(there, sequence[np.minimum(starts + step, len(sequence) - 1)], np.uint64(0))
        value = np.where(there, _mix(value ^ word), value)
    own = owner[starts]
    order = np.lexsort((value, own))
    own, value = own[order], value[order]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    own, value = own[fresh], value[fresh]
    return value, np.searchsorted(own, np.arange(len(texts) + 1))


def dart_signatures(elements: np.ndarray, begins: np.ndarray, k: int,
                    weights: np.ndarray | None = None) -> np.ndarray:
    """The signature of each set, k hashes a row; sets without weight have zeros.

    ``weights`` are those of the elements, 1 by default. An element of weight w
    covers the region [0, w) of its weight axis, cut into unit cells. The darts
    of a cell arrive along the rank axis at exponential gaps drawn from the hash
    of (element, cell, turn); one beyond the weight in the last cell misses.
    """
    sets = len(begins) - 1
    owner = np.repeat(np.arange(sets), np.diff(begins))
    if weights is None:
        weights = np.ones(len(elements))
    total = np.bincount(owner, weights, sets)
    cells = np.ceil(weights).astype(np.int64)
    number = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    owner = np.repeat(owner, cells)
    region = _mix(np.repeat(elements, cells) ^ _mix(number.astype(np.uint64)))
    room = np.minimum(np.repeat(weights, cells) - number, 1.0)
    out = np.zeros((sets, k), np.uint64)
    wanted = np.flatnonzero(total > 0)
    limit = np.zeros(sets)
    limit[wanted] = k * (np.log(k) + 3) / total[wanted]
    while len(wanted):
        active = np.isin(owner, wanted)
        best = np.full(sets * k, np.inf)
        spots, ranks, names = [], [], []
        own, seed, space = owner[active], region[active], room[active]
        rank, turn = np.zeros(len(own)), 0
        while len(own):
            dart = _mix(seed ^ _mix(np.full(1, turn, np.uint64)))
            rank = rank - np.log(_unit(dart))
            near = rank <= limit[own]
            own, seed, space, rank, dart = own[near], seed[near], space[near], rank[near], dart[near]
            place = _mix(dart)
            hits = _unit(_mix(place)) <= space
            spot = own[hits] * k + (place[hits] % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, spot, rank[hits])
            spots.append(spot)
            ranks.append(rank[hits])
            names.append(dart[hits])
            turn += 1
        spot, rank, name = map(np.concatenate, (spots, ranks, names))
        first = rank == best[spot]
        out.reshape(-1)[spot[first]] = name[first]
        # A coordinate no dart has hit: the same darts again, up to twice the rank.
        missed = np.isinf(best.reshape(sets, k)[wanted]).any(1)
        wanted = wanted[missed]
        limit[wanted] *= 2
    return out


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = _mix(np.arange(bands, dtype=np.uint64))[None, :].repeat(len(signatures), 0)
    for row in range(rows):
        keys = _mix(keys ^ signatures[:, row::rows][:, :bands])
    return keys.view(np.int64)


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for at, n in enumerate(lengths):
        held += n // 6 + BANDS * ROWS * 8
        if held > AT_ONCE:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def _keys(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The digest of each set."""
    return pa.array([md5(values[a:b].tobytes()).digest() for a, b in zip(begins[:-1], begins[1:])],
                    pa.binary())


def _profiles(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``set_key`` (digest of the shingle set), ``n`` and ``bands``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids, all_texts = (c.to_pylist() for c in batch.columns)
            for a, b in _chunks(list(map(len, all_texts))):
                values, begins = shingle_sets(all_texts[a:b])
                keys = _bands(dart_signatures(values, begins, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(all_ids[a:b], pa.int64()), _keys(values, begins),
                     pa.array(np.diff(begins)),
                     pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * bands, pa.int32()),
                                              pa.array(keys.reshape(-1)))],
                    names=["doc_id", "set_key", "n", "bands"])

    return materialize(texts.mapInArrow(
        run, "doc_id bigint, set_key binary, n bigint, bands array<bigint>"), "profiles")


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``shingles`` of the documents and sets in ``wanted``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, all_texts = (c.to_pylist() for c in batch.columns)
            for a, b in _chunks(list(map(len, all_texts))):
                values, begins = shingle_sets(all_texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), _keys(values, begins),
                     pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values.view(np.int64)))],
                    names=["doc_id", "set_key", "shingles"])

    chosen = texts.join(wanted.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    sets = chosen.mapInArrow(run, "doc_id bigint, set_key binary, shingles array<bigint>")
    return materialize(sets.join(wanted, ["doc_id", "set_key"], "left_semi")
                       .dropDuplicates(["doc_id"]).select("doc_id", "shingles"), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``) with their ``similarity``, if it is high enough."""
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("a_set")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("b_set")), "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    measured = both.select("a", "b", (common / (F.size("a_set") + F.size("b_set") - common))
                           .alias("similarity"))
    return materialize(measured.where(F.col("similarity") >= similarity), "links")


def _within(postings: DataFrame, similarity: float) -> DataFrame:
    """Pairs of one bucket and different components whose sizes allow a link."""
    other = postings.select("bucket", F.col("doc_id").alias("b"), F.col("n").alias("b_n"),
                            F.col("component").alias("b_c"))
    alike = F.least("n", "b_n") >= similarity * F.greatest("n", "b_n")
    return postings.join(other, "bucket").where(
        (F.col("doc_id") < F.col("b")) & (F.col("component") != F.col("b_c")) & alike
    ).select(F.col("doc_id").alias("a"), "b")


def _apart(rest: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """What the texts of a bucket have otherwise than a central text, the pivot, which is
    the most central one of its texts' buckets: ``pivot``, ``doc_id``, ``differs`` (the
    shingles that only one of the two has), ``total`` (the shingles of both), ``excess``
    and ``unit``.

    Sets x and y that differ from the pivot in d(x) and d(y) shingles differ from each other
    in d(x) + d(y) less twice what both differ in. A link allows a share t of n(x) + n(y).
    So it needs at least half of ``excess(x) + excess(y)`` shingles that both differ in,
    the excess being d - t * n.
    """
    share = (1 - similarity) / (1 + similarity)
    # Buckets that overlap take one pivot, so that a text is described a few times at most.
    hubs = materialize(rest.groupBy("bucket").agg(
        F.max(F.struct("central", (-F.col("doc_id")).alias("turned"))).alias("hub")), "hubs")
    known = materialize(rest.join(hubs, "bucket").groupBy("doc_id").agg(F.max("hub").alias("hub")), "known")
    pivots = materialize(rest.join(known, "doc_id").groupBy("bucket").agg(
        (-F.max("hub")["turned"]).alias("pivot")), "pivots")
    near = materialize(rest.join(pivots, "bucket").select("pivot", "doc_id").distinct(), "near")
    both = near.join(sets, "doc_id").join(
        sets.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("pivot_set")), "pivot")
    n, pivot_n = F.size("shingles"), F.size("pivot_set")
    differs = F.concat(F.array_except("shingles", "pivot_set"), F.array_except("pivot_set", "shingles"))
    return materialize(
        both.select("pivot", "doc_id", differs.alias("differs"), (n + pivot_n).alias("total"),
                    (share * n).alias("own"), F.greatest(share * pivot_n, F.lit(1.0)).alias("unit"))
        .select("pivot", "doc_id", "differs", "total", (F.size("differs") - F.col("own")).alias("excess"),
                "unit"), "apart")


def _to_pivots(apart: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Links between texts and their pivots that are in different components."""
    of = lambda side: labels.select(F.col("doc_id").alias(side), F.col("component").alias(f"{side}_c"))
    common = (F.col("total") - F.size("differs")) / 2
    close = apart.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"),
                         (common / (F.col("total") - common)).alias("similarity"))
    return materialize(close.where(F.col("similarity") >= similarity).join(of("a"), "a").join(of("b"), "b")
                       .where("a_c <> b_c").select("a", "b", "similarity"), "links")


def _by_differences(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of texts around one pivot and of different components: all that
    are links, and few others.

    Links to the pivot are made, so at most one of the two is that close to it, and both
    must share what they differ in. If that takes ``needed`` shingles, one of them is
    among all but the ``needed`` - 1 most frequent ones of either text. What is needed
    follows from both excesses: each shingle reaches up to a class of the other's. Classes
    meet first, then components, then texts, so that those of one component never do.
    """
    placed = apart.join(labels, "doc_id")
    mixed = materialize(placed.groupBy("pivot").agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high").select("pivot"), "mixed")
    around = materialize(placed.join(mixed, "pivot").select(
        "pivot", "doc_id", "component", "excess", "unit", "differs"), "around")
    each = around.withColumn("shingle", F.explode("differs")).drop("differs")
    # What only texts of one component differ in is shared by no pair that is asked for.
    often = materialize(each.groupBy("pivot", "shingle").agg(
        F.count(F.lit(1)).alias("often"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high").select("pivot", "shingle", "often"), "often")
    turn = F.row_number().over(
        Window.partitionBy("pivot", "doc_id").orderBy(F.desc("often"), "shingle"))
    begun = lambda x: reduce(lambda m, low: m + (x >= low).cast("int"), EXCESS[1:], F.lit(0))
    # Up to which excess of the other text so few are needed that this shingle counts. One
    # is always needed: the excesses of two components' texts add up to more than none.
    room = (2 * F.col("turn") + 1e-6 - F.col("excess")) / F.col("unit")
    posted = materialize(
        each.join(often, ["pivot", "shingle"]).withColumn("turn", turn).where(room >= EXCESS[0]).select(
            "pivot", "shingle", "doc_id", "component", begun(F.col("excess") / F.col("unit")).alias("own"),
            begun(room).alias("reach")), "posted")
    # Classes meet before texts do: a few numbers a shingle, however many texts.
    reached = materialize(posted.groupBy("pivot", "shingle", "own").agg(
        F.max("reach").alias("reach"), F.min("component").alias("low"), F.max("component").alias("high")),
        "classes")
    facing = reached.select("pivot", "shingle", F.col("own").alias("other"), F.col("reach").alias("back"),
                            F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    faces = reached.join(facing, ["pivot", "shingle"]).where(
        "other <= reach and own <= back and (low <> other_high or high <> other_low)").select(
        "pivot", "shingle", "own", "other")
    spot = lambda x, y: F.xxhash64("pivot", "shingle", x, y)
    posted = materialize(
        posted.join(materialize(faces, "faces"), ["pivot", "shingle", "own"]).where("other <= reach").select(
            "doc_id", "component", spot("own", "other").alias("spot"), spot("other", "own").alias("facing")),
        "facing")
    here = posted.select("spot", "facing", "component").distinct()
    there = posted.select(F.col("spot").alias("facing"), F.col("component").alias("b_c")).distinct()
    meet = materialize(here.join(there, "facing").where("component < b_c"), "meet")
    left = meet.join(posted.select("spot", "component", F.col("doc_id").alias("a")), ["spot", "component"])
    right = posted.select(F.col("spot").alias("facing"), F.col("component").alias("b_c"),
                          F.col("doc_id").alias("b"))
    return left.join(right, ["facing", "b_c"]).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``doc_id`` and ``component`` (its smallest id) of all that have links ``a``, ``b``."""
    both = materialize(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("doc_id"), F.least("a", "m").alias("component")), "labels")
    while True:
        around = (both.join(labels, both["b"] == labels["doc_id"])
                  .groupBy("a").agg(F.min("component").alias("near")))
        # One step along the links, one along the labels.
        stepped = labels.join(around, labels["doc_id"] == around["a"]).select(
            "doc_id", "component", F.least("component", "near").alias("near"))
        jump = labels.select(F.col("doc_id").alias("near"), F.col("component").alias("far"))
        new = materialize(stepped.join(jump, "near", "left").select(
            "doc_id", F.least("near", F.coalesce("far", "near")).alias("component"),
            (F.least("near", F.coalesce("far", "near")) != F.col("component")).alias("changed")),
            "labels")
        labels = new.select("doc_id", "component")
        if new.where("changed").isEmpty():
            return labels


def _grown(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links between the components so far."""
    name = lambda side: F.coalesce(F.col(f"{side}_c"), F.col(side))
    of = lambda side: labels.select(F.col("doc_id").alias(side), F.col("component").alias(f"{side}_c"))
    between = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
               .select(name("a").alias("a"), name("b").alias("b")).where("a <> b"))
    merged = components(between).select(F.col("doc_id").alias("component"), F.col("component").alias("to"))
    ends = links.select(F.col("a").alias("doc_id")).unionByName(links.select(F.col("b").alias("doc_id")))
    known = labels.unionByName(
        ends.distinct().join(labels, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("component")))
    return materialize(known.join(merged, "component", "left").select(
        "doc_id", F.coalesce("to", "component").alias("component")), "components")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``class_id``, ``class_size``, ``kept``, ``n_links``.

    A class holds all documents that a chain of links joins, a link being a
    similarity of at least ``similarity`` between shingle sets; it is named
    after its smallest ``doc_id``, which is the one document kept. Documents
    with the same set are one node of the chain; ``n_links`` counts a node's
    verified links that were needed to join the class. Documents without words
    and rows without an id are classes of their own. Rows that repeat a
    ``doc_id`` are one document: the row with most shingles speaks for it, and
    they are kept or not together. An empty table gives no rows; other columns
    are ignored.

    Buckets are of any size and none is cut: each text is first tried against
    the most central texts of its buckets, which joins a group of copies by as
    many comparisons as it has members. What is then still in different
    components of one bucket is compared pair by pair in small buckets. In large ones
    texts are described by what they have otherwise than a central text, and meet only
    if they share enough of that, so that a large group of texts that are alike, but not
    enough, does not meet pair by pair. No link between texts of a bucket is left out.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    profiles = _profiles(texts.where("doc_id is not null"), bands, rows)
    # A document is its id: should rows differ, the one with most shingles counts.
    one = F.max(F.struct("n", "set_key", "bands")).alias("one")
    documents = profiles.where("n > 0").groupBy("doc_id").agg(one).select("doc_id", "one.*")
    nodes = materialize(
        documents.groupBy("set_key", "n").agg(F.min(F.struct("doc_id", "bands")).alias("one"))
        .select("set_key", F.col("one.doc_id").alias("doc_id"), "n", F.col("one.bands").alias("bands")),
        "nodes")
    members = materialize(documents.select("doc_id", "set_key"), "members")
    posted = nodes.select("doc_id", "n", F.explode("bands").alias("bucket"))
    shared = posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    posted = materialize(posted.join(shared, "bucket"), "postings")
    central = materialize(posted.groupBy("doc_id").agg(F.sum("members").alias("central")), "central")
    sets = _sets(texts, nodes.join(central, "doc_id", "left_semi").select("doc_id", "set_key"))
    alike = F.least("n", "b_n") >= similarity * F.greatest("n", "b_n")
    labels = central.select("doc_id", F.col("doc_id").alias("component"))
    rest = posted.join(central, "doc_id").select(
        "bucket", "doc_id", "n", "central", F.col("doc_id").alias("component"))
    links, tried = None, None
    for _ in range(HUB_ROUNDS):
        free = rest if tried is None else rest.join(tried, ["bucket", "doc_id"], "left_anti")
        # Aggregates, reduced in every task: a bucket of any size gives one hub.
        hubs = materialize(free.groupBy("bucket").agg(
            F.max_by(F.struct("doc_id", "n", "central", "component"),
                     F.struct("central", -F.col("doc_id"))).alias("hub")).select(
            "bucket", F.col("hub.doc_id").alias("b"), F.col("hub.n").alias("b_n"),
            F.col("hub.central").alias("b_central"), F.col("hub.component").alias("b_c")), "hubs")
        best = materialize(
            rest.select("bucket", "doc_id", "n", "component").join(hubs, "bucket")
            .where((F.col("component") != F.col("b_c")) & alike)
            .groupBy(F.col("doc_id").alias("a"))
            .agg(F.max_by("b", F.struct("b_central", -F.col("b"))).alias("b")), "pairs")
        used = hubs.select("bucket", F.col("b").alias("doc_id"))
        tried = used if tried is None else materialize(tried.unionByName(used), "tried")
        if not best.isEmpty():
            found = _verified(best, sets, similarity)
            links = found if links is None else links.unionByName(found)
            labels = _grown(labels, found)
        # Only buckets whose members are still in different components go on.
        placed = posted.join(labels, "doc_id")
        mixed = placed.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        rest = materialize(placed.join(mixed.select("bucket"), "bucket").join(central, "doc_id").select(
            "bucket", "doc_id", "n", "central", "component"), "rest")
        if rest.isEmpty():
            break
    large = materialize(rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
                        .where(F.col("members") > PAIRWISE).select("bucket"), "large")
    pairs = _within(rest.join(large, "bucket", "left_anti").select("bucket", "doc_id", "n", "component"),
                    similarity)
    if not large.isEmpty():
        apart = _apart(rest.join(large, "bucket", "left_semi"), sets, similarity)
        found = _to_pivots(apart, labels, similarity)
        links = found if links is None else links.unionByName(found)
        labels = _grown(labels, found)
        pairs = pairs.unionByName(_by_differences(apart, labels))
    found = _verified(pairs.distinct(), sets, similarity)
    links = found if links is None else links.unionByName(found)
    labels = _grown(labels, found)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    counted = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = (nodes.join(labels, "doc_id", "left").join(counted, F.col("doc_id") == F.col("node"), "left")
             .select("set_key", F.coalesce("component", "doc_id").alias("class_id"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    classes = members.join(named, "set_key").select("doc_id", "class_id", "n_links")
    # Rows in turn: those of one id share its class.
    placed = materialize(
        profiles.select("doc_id").join(classes, "doc_id", "left").select(
            "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")), "classes")
    # Written, so that the join reads both sides as they are and can split a large class.
    sizes = materialize(
        placed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")), "class-sizes")
    unnamed = texts.where("doc_id is null").select(
        "doc_id", F.lit(None).cast("bigint").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"),
        F.lit(True).alias("kept"), F.lit(0).cast("bigint").alias("n_links"))
    return placed.join(sizes, "class_id").select(
        "doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"),
        "n_links").unionByName(unnamed)


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class, its columns unchanged."""
    gone = near_duplicates(docs, **options).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["gone"], "left_anti")


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Classes of near duplicates over all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))
