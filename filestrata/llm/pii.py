"""Personal data: fixed formats, and contexts bootstrapped from them.

Entities of the fixed formats are seeds. The words before a seed are a pattern;
a pattern counts by the share of all its places in the corpus that hold a known
entity. Patterns and instances form a graph that is scored in turns: patterns by
the instances they hold, instances by the patterns that hold them. Identifiers
of no fixed format that stand in confident patterns are found in the end.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import count
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

KINDS = ("email", "ip", "card", "phone")
# A pattern is the words before an entity, this many.
CONTEXT = 2
# It must hold so many different known entities, and they must be in this share of its
# places; an instance must reach the same score.
LEAST_SEEDS = 5
CONFIDENCE = 0.8
# Word pairs are looked up in a table of so many bits before they leave a task, and
# leave it in parts of so many.
BITS = 1 << 20
PAIRS_AT_ONCE = 200_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits does: looking back keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
# A token with a digit, an inner sign of an address or name, or a capital after a
# small letter may be an identifier; contexts decide whether it is one.
_MARK = re.compile(r"[\d@_]|[a-z][A-Z]")
LEAST_LENGTH = 4
# Scores that change by less in all have settled.
SETTLED = 1e-6
_EDGES = "\"'`.,;:!?()[]{}<>*#$&%=|"


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the fixed formats by start, then kind; the kind is
    a place in ``KINDS``. Matches of a kind do not overlap, those that fail its
    condition are dropped."""
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdecimal, m[0])) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2]))


def candidates(text: str, base: list[tuple[int, int, int]]):
    """``(start, end, kind, instance, pattern)`` of seeds (with their kind) and of
    other identifiers (kind -1), each with the words before it."""
    def words(start: int) -> str | None:
        """The words before a place, if there are enough."""
        reach = 100
        while True:
            before = text[max(0, start - reach):start].split()
            # The first word of a part may be cut; take a longer part then.
            if len(before) > CONTEXT or reach >= start:
                break
            reach *= 4
        return " ".join(before[-CONTEXT:]).lower() if len(before) >= CONTEXT else None

    def token_start(place: int) -> int:
        while place and not text[place - 1].isspace():
            place -= 1
        return place

    for start, end, kind in base:
        pattern = words(token_start(start))
        if pattern is not None:
            yield start, end, kind, text[start:end].lower(), pattern
    taken = sorted((s, e) for s, e, _ in base)
    known = [s for s, _ in taken]
    reach = []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))
    mark = _MARK.search(text)
    while mark:
        at = token_start(mark.start())
        whole = _TOKEN.match(text, at)
        mark = _MARK.search(text, whole.end())
        token = whole[0].strip(_EDGES)
        if len(token) < LEAST_LENGTH or not _MARK.search(token):
            continue
        start = at + whole[0].index(token)
        end = start + len(token)
        before = bisect_right(known, end - 1) - 1
        if before >= 0 and reach[before] > start:
            continue
        pattern = words(at)
        if pattern is not None:
            yield start, end, -1, token.lower(), pattern


def _pattern_counts(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern`` and ``places``: how often its words are followed by anything.

    Words whose bit no pattern has are dropped in the task; the others are counted
    and joined with the patterns, whose number has no bound.
    """
    bits = bytearray(BITS)
    for bit in patterns.agg(F.collect_set(F.pmod(F.crc32("pattern"), F.lit(BITS)).cast("int"))).first()[0]:
        bits[bit] = 1
    table = bytes(bits)

    def packed(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"pattern": pa.array(list(seen), pa.string()),
                                           "places": pa.array(list(seen.values()), pa.int64())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = text.lower().split()
                # The last words have nothing after them.
                for pattern in map(" ".join, zip(*(words[k:k - CONTEXT] for k in range(CONTEXT)))):
                    if table[crc32(pattern.encode()) % BITS]:
                        seen[pattern] += 1
                if len(seen) >= PAIRS_AT_ONCE:
                    yield packed(seen)
                    seen.clear()
        yield packed(seen)

    counted = texts.select("text").mapInArrow(run, "pattern string, places bigint").groupBy(
        "pattern").agg(F.sum("places").alias("places"))
    return counted.join(patterns, "pattern", "left_semi")


def _scored(edges: DataFrame, totals: DataFrame, rounds: int | None, least: int,
            confidence: float) -> DataFrame | None:
    """``pattern``, ``k``, ``instance`` of the unseen instances that confident patterns
    of kind ``k`` reach, null if none. ``edges`` has pattern, instance, kind (-1: unseen), n.

    What a round finds counts for the patterns of the next one as seeds do, by its score.
    Scores only rise and have a bound, so the rounds come to an end: when no pattern
    and no instance is new and the scores have settled.
    """
    graph = materialize(edges.join(totals, "pattern"), "graph")
    seeds = materialize(graph.where("kind >= 0").select(
        "instance", F.lit(1.0).alias("score"), "kind").distinct(), "seeds")
    trust, confident, found = seeds, None, None
    before = None
    for _ in count() if rounds is None else range(rounds):
        scores = (graph.join(trust.select("instance", "score", F.col("kind").alias("k")), "instance")
                  .groupBy("pattern", "k").agg(F.sum(F.col("n") * F.col("score")).alias("held"),
                                               F.max("places").alias("places"),
                                               F.countDistinct("instance").alias("instances")))
        confident = materialize(
            scores.withColumn("confidence", F.col("held") / F.greatest("held", "places"))
            .where((F.col("confidence") >= confidence) & (F.col("instances") >= least))
            .select("pattern", "k", "confidence"), "patterns")
        if confident.isEmpty():
            return None
        reached = (graph.where("kind = -1").join(confident, "pattern")
                   .groupBy("instance", "k").agg(
                       (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))))
                       .alias("score")).where(F.col("score") >= confidence))
        best = reached.groupBy("instance").agg(F.max(F.struct("score", "k")).alias("best")).select(
            "instance", F.col("best.score").alias("score"), F.col("best.k").alias("kind"))
        found = materialize(best, "instances")
        trust = materialize(trust.unionByName(found.select("instance", "score", "kind"))
                            .groupBy("instance", "kind").agg(F.max("score").alias("score")), "trust")
        now = (confident.count(), *trust.agg(F.count(F.lit(1)), F.sum("score")).first())
        if before and now[:2] == before[:2] and abs(now[2] - before[2]) < SETTLED:
            break
        before = now
    return (graph.where("kind = -1").select("pattern", "instance")
            .join(confident.select("pattern", "k"), "pattern")
            .join(found.select("instance", F.col("kind").alias("k")), ["instance", "k"]))


def find(docs: DataFrame, rounds: int | None = None, least_seeds: int = LEAST_SEEDS,
         confidence: float = CONFIDENCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``base`` and ``found`` (arrays of start, end,
    kind; code points, end exclusive).

    ``base`` holds the fixed formats by start, then kind. ``found`` holds other
    identifiers in contexts that mostly hold known entities, with the kind of
    those; they never overlap base spans. Contexts and identifiers are scored in turns
    until nothing is new, or for so many ``rounds``. Null and empty texts have none;
    repeated rows give repeated rows, an empty table none; other columns are
    ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
    candidate = pa.struct([*span, ("instance", pa.string()), ("pattern", pa.string())])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, others = [], []
            for text in batch.column(1).to_pylist():
                own = base_spans(text)
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in own])
                others.append([{"start": s, "end": e, "kind": k, "instance": i, "pattern": p}
                               for s, e, k, i, p in candidates(text, own)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(span)), pa.array(others, pa.list_(candidate))],
                names=["doc_id", "base", "candidates"])

    spans = "array<struct<start:int,end:int,kind:int>>"
    scanned = materialize(
        texts.mapInArrow(scan, f"doc_id bigint, base {spans}, candidates "
                               "array<struct<start:int,end:int,kind:int,instance:string,pattern:string>>")
        .withColumn("row", F.monotonically_increasing_id()), "scanned")
    held = scanned.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    edges = materialize(held.groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n")), "edges")
    # A pattern with fewer instances, seen or not, can hold enough in no round.
    kept = materialize(
        edges.groupBy("pattern").agg(F.countDistinct("instance").alias("instances"))
        .where(F.col("instances") >= least_seeds).select("pattern"), "kept-patterns")
    new = None
    if rounds != 0 and not kept.isEmpty():
        totals = materialize(_pattern_counts(texts, kept), "pattern-places")
        new = _scored(edges.join(kept, "pattern", "left_semi"), totals, rounds, least_seeds, confidence)
    if new is not None:
        placed = (held.where("kind = -1").drop("kind").join(new, ["pattern", "instance"])
                  .groupBy("row").agg(F.collect_set(F.struct(
                      "start", "end", F.col("k").cast("int").alias("kind"))).alias("found")))
        scanned = scanned.join(placed, "row", "left")
    else:
        scanned = scanned.withColumn("found", F.lit(None).cast(spans))
    none = F.array().cast(spans)
    return scanned.select("doc_id", "base", F.array_sort(F.coalesce("found", none)).alias("found"))


def _written(spans):
    """Spans as ``kind:start:end``, by start, then kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    spans = find(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))
                                ).cast("bigint").alias(f"n_{kind}")
    return spans.select(
        "doc_id", *map(count, KINDS), F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "found")).alias("spans"))
