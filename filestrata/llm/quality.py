"""Quality of documents by a factorisation machine.

A document's features are its hashed words, statistics of its structure and what
the table says about it (metadata). Every feature has a weight and a short vector;
two features interact by the product of their vectors. The sum over all pairs of
features is half the square of the sum minus the sum of squares, so a document is
scored in time linear in its features.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

# The model is fitted on at most so many labelled rows, drawn by a seeded digest.
TRAINING_ROWS = 12_000
THRESHOLD = 0.3
# Buckets that words are hashed to, places of each statistic's scale, length of a vector.
WORDS, PLACES, RANK = 1 << 15, 16, 8
# Few rows are gone through more often than EPOCHS, until so many batches are done.
EPOCHS, LEAST_BATCHES, BATCH, RATE, PENALTY, SEED = 8, 300, 256, 0.05, 1e-6, 11

# Classes of bytes that structure is read from.
_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789", "space": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".?",
    "shout": b"!", "pause": b",;:'\"()-", "bar": b"|/\\",
}
_SYMBOL, _WIDE = len(_CLASSES), len(_CLASSES) + 1
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[128:] = _WIDE
for _n, _bytes in enumerate(_CLASSES.values()):
    _CLASS[list(_bytes)] = _n
_NAMES = [*_CLASSES, "symbol", "wide"]

STATISTICS = ("words", "characters", "word length", "distinct words", "commonest word", "repeated next",
              "capitals", "digits", "symbols", "bars", "shouts", "pauses", "stops", "wide letters",
              "line length", "repeated lines", "short words", "declared length", "declared difference")
FEATURES = WORDS + len(STATISTICS) * PLACES


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def statistics(text: str, words: list[str], counts: Counter, declared: int | None) -> list[float]:
    """The statistics of a text, each from 0 to 1; ``declared`` is the length that
    the table gives for it, or null."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    of = dict(zip(_NAMES, np.bincount(_CLASS[raw], minlength=len(_NAMES)).tolist()))
    n, chars, size = max(len(words), 1), max(len(text), 1), max(len(raw), 1)
    letters = max(of["lower"] + of["upper"], 1)
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    return [
        np.log2(1 + len(words)) / 16, np.log2(1 + len(text)) / 20, min(chars / n / 16, 1),
        len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        of["upper"] / letters, (of["digit"] / size) ** 0.5, (of["symbol"] / size) ** 0.5,
        (of["bar"] / size) ** 0.5, (of["shout"] / size) ** 0.5, (of["pause"] / size) ** 0.5,
        (of["stop"] / size) ** 0.5, of["wide"] / size,
        np.log2(1 + chars / len(lines)) / 16, 1 - len(set(lines)) / len(lines),
        sum(c for w, c in counts.items() if len(w) < 3) / n,
        0.0 if declared is None or declared < 0 else np.log2(2 + declared) / 20,
        1.0 if declared is None else min(abs(declared - len(text)) / chars, 1),
    ]


_OFFSETS = WORDS + PLACES * np.arange(len(STATISTICS))


def features(text: str | None, declared: int | None, buckets: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a document's features. Words weigh by the logarithm of
    their count, with length 1 in all; a statistic is shared by the two places of its scale that
    it lies between. ``buckets`` remembers where words go."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    places = np.empty(len(counts), np.int64)
    for i, word in enumerate(counts):
        place = buckets.get(word)
        if place is None:
            place = zlib.crc32(word.encode("utf-8", "replace")) % WORDS
            if len(buckets) < 500_000:
                buckets[word] = place
        places[i] = place
    values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    values /= max(float(np.sqrt(values @ values)), 1e-9)
    at = np.clip(np.asarray(statistics(text, words, counts, declared)), 0, 1) * (PLACES - 1)
    low = np.minimum(at.astype(np.int64), PLACES - 2)
    return (np.concatenate([places, _OFFSETS + low, _OFFSETS + low + 1]),
            np.concatenate([values, 1 - (at - low), at - low]).astype(np.float32))


@dataclass
class Machine:
    """Constant, weights and vectors."""

    constant: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, places: np.ndarray, values: np.ndarray) -> float:
        """Probability of label 1: constant, weights, and all pairs by the identity."""
        parts = self.vectors[places] * values[:, None]
        total = parts.sum(0)
        pairs = 0.5 * float(total @ total - (parts * parts).sum())
        logit = self.constant + float(self.weights[places] @ values) + pairs
        return 1 / (1 + float(np.exp(-np.clip(logit, -30, 30))))


def fit_machine(starts: np.ndarray, places: np.ndarray, values: np.ndarray, label: np.ndarray) -> Machine:
    """Adaptive gradient descent on the logistic loss, in a seeded order of batches.
    Row ``i`` has the features from ``starts[i]`` to ``starts[i + 1]``; none is empty."""
    rng = np.random.default_rng(SEED)
    n = len(label)
    share = np.clip(label.mean(), 0.01, 0.99)
    constant, seen = float(np.log(share / (1 - share))), 1e-6
    weights, w_seen = np.zeros(FEATURES, np.float32), np.full(FEATURES, 1e-6, np.float32)
    vectors = rng.normal(0, 0.02, (FEATURES, RANK)).astype(np.float32)
    v_seen = np.full((FEATURES, RANK), 1e-6, np.float32)
    for _ in range(max(EPOCHS, -(-LEAST_BATCHES // -(-n // BATCH)))):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            rows = order[begin:begin + BATCH]
            sizes = starts[rows + 1] - starts[rows]
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            own = np.repeat(np.arange(len(rows)), sizes)
            take = np.arange(sizes.sum()) - heads[own] + starts[rows][own]
            at, x = places[take], values[take]
            parts = vectors[at] * x[:, None]
            total = np.add.reduceat(parts, heads)
            pairs = 0.5 * ((total ** 2).sum(1) - np.add.reduceat((parts ** 2).sum(1), heads))
            logit = constant + np.add.reduceat(weights[at] * x, heads) + pairs
            miss = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[rows]).astype(np.float32) / len(rows)
            touched, where = np.unique(at, return_inverse=True)
            pull = miss[own] * x
            slope = np.bincount(where, pull, len(touched)).astype(np.float32) + PENALTY * weights[touched]
            w_seen[touched] += slope ** 2
            weights[touched] -= RATE * slope / np.sqrt(w_seen[touched])
            each = pull[:, None] * (total[own] - parts)
            slopes = np.stack([np.bincount(where, each[:, k], len(touched)) for k in range(RANK)], 1)
            slopes = slopes.astype(np.float32) + PENALTY * vectors[touched]
            v_seen[touched] += slopes ** 2
            vectors[touched] -= RATE * slopes / np.sqrt(v_seen[touched])
            seen += float(miss.sum()) ** 2
            constant -= RATE * float(miss.sum()) / seen ** 0.5
    return Machine(constant, weights, vectors)


def _inputs(docs: DataFrame) -> list[Column]:
    declared = docs["n_chars"].try_cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return [docs["text"].cast("string").alias("text"), declared.alias("declared")]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Machine | None:
    """The machine learnt from at most ``rows`` labelled documents that are not held
    out; none without such rows."""
    draw = (labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("bigint").alias("l_doc"))
            .agg(F.max("quality").cast("int").alias("quality"))
            .orderBy(F.md5(F.col("l_doc").cast("string")), "l_doc").limit(rows))
    draw = materialize(draw, "quality-draw")
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("t_doc"), *_inputs(docs))
    # At most ``rows`` rows of two numbers. An id that many rows share gives one of them.
    chosen = wanted.join(F.broadcast(draw), F.col("t_doc") == F.col("l_doc")).groupBy("t_doc").agg(
        F.max("quality").alias("quality"), F.min(F.struct("text", "declared")).alias("own"))

    def read_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[str, int] = {}
        for batch in batches:
            ids, label, texts, declared = (c.to_pylist() for c in batch.columns)
            found = [features(t, d, buckets) for t, d in zip(texts, declared)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "quality": pa.array(label, pa.int32()),
                "places": pa.array([p.astype(np.int32).tobytes() for p, _ in found], pa.binary()),
                "x": pa.array([v.tobytes() for _, v in found], pa.binary())})

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        own = [np.frombuffer(b, np.int32) for b in table["places"].to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in own])])
        places = np.concatenate(own)
        values = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32)
        machine = fit_machine(starts, places, values, table["quality"].to_numpy().astype(np.float32))
        return pa.table({"constant": [machine.constant], "weights": [machine.weights.tobytes()],
                         "vectors": [machine.vectors.tobytes()]})

    learnt = chosen.select("t_doc", "quality", "own.text", "own.declared").mapInArrow(
        read_features, "doc_id bigint, quality int, places binary, x binary")
    # The bounded draw is what one task fits.
    fitted = learnt.withColumn("model", F.lit("quality")).groupBy("model").applyInArrow(
        train, "constant double, weights binary, vectors binary").first()
    if fitted is None:
        return None
    return Machine(fitted.constant, np.frombuffer(fitted.weights, np.float32),
                   np.frombuffer(fitted.vectors, np.float32).reshape(FEATURES, RANK))


def scorer(machine: Machine | None):
    """A function from text and declared length to the score."""
    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        buckets: dict[str, int] = {}
        for texts, declared in batches:
            known = [None if pd.isna(d) else int(d) for d in declared]
            yield pd.Series([0.5 if machine is None else machine.score(*features(t, d, buckets))
                             for t, d in zip(texts, known)], dtype="float64")

    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    A null text is empty and is scored by its statistics, as every text of any
    length is. A null or absent ``n_chars`` is a case of its own. Repeated rows
    give repeated rows, an empty table none. Labels other than 0 and 1, null ids
    and labels without a text teach nothing; of several labels of a document the
    larger counts. Without any label every text scores 0.5.
    """
    score = scorer(fit(docs, labels, rows))
    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"),
                       score(*_inputs(docs)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op11_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the labels."""
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
