"""Toxicity by weak supervision.

Many voters (terms found with the labelled toxic texts, a general lexicon by
theme, patterns) look at a text. A generative label model estimates how often
each votes in toxic and in other texts and which voters repeat each other, and
gives every training text a posterior. A linear classifier over the voters is
trained on the posteriors and scores all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

# The model is fitted on at most so many labelled rows, drawn by a seeded digest.
TRAINING_ROWS = 30_000
# A term needs so many toxic training texts to become a voter; the most telling
# terms do, up to the size of the model.
LEAST_TOXIC = 5
LEAST_LOG_ODDS = 2.0
VOTERS = 512
THRESHOLD = 0.7
ROUNDS = 25
BLOCK_ROWS = 2_000

# A small general lexicon by theme and patterns of abuse.
LEXICON = {
    "insult": "idiot idiots moron morons stupid dumb fool loser losers clown imbecile dimwit cretin",
    "contempt": "worthless pathetic disgusting trash garbage scum filth vermin useless subhuman",
    "threat": "kill murder strangle lynch exterminate",
    "obscenity": "shit bullshit fuck fucking bitch bastard asshole crap",
}
PATTERNS = {
    "masked": r"\b[a-z][*#@$]{2,}[a-z]{0,4}\b",
    "addressed": r"\byou(?:'re| are)? (?:a |an |all |such a )?(?:idiot|moron|loser|fool|clown|trash|scum)",
    "command": r"\b(?:shut up|go to hell|drop dead|get lost)\b",
}
_WORD = re.compile(r"\w+")
_THEMES = {w: f"lexicon:{theme}" for theme, words in LEXICON.items() for w in words.split()}
_PATTERNS = {f"pattern:{n}": re.compile(p) for n, p in PATTERNS.items()}


def terms(text: str) -> set[str]:
    """Words of a text in lower case, and the heads of longer ones (``head*``)."""
    words = set(_WORD.findall(text.lower()))
    heads = {w[:4] + "*" for w in words if len(w) > 4}
    return words | heads | {w[:5] + "*" for w in words if len(w) > 5}


def _fixed_votes(text: str, words: Iterable[str]) -> set[str]:
    """The lexicon's and the patterns' votes; patterns read the text in lower case."""
    out = {_THEMES[w] for w in words if w in _THEMES}
    lower = text.lower()
    return out | {n for n, p in _PATTERNS.items() if p.search(lower)}


FIXED = sorted(set(_THEMES.values()) | set(_PATTERNS))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``text`` and ``toxic`` of a seeded draw of labelled rows, at most ``rows``."""
    draw = (labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
                         & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("bigint").alias("l_doc"))
            .agg(F.max("toxic").cast("int").alias("toxic"))
            .orderBy(F.md5(F.col("l_doc").cast("string")), "l_doc").limit(rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most ``rows`` rows of two numbers.
    return materialize(texts.join(F.broadcast(draw), texts["doc_id"] == draw["l_doc"])
                       .select("doc_id", "text", "toxic"), "toxicity-training")


def _voter_terms(training: DataFrame) -> list[str]:
    """The most telling terms of the training texts."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        rows = [0, 0]
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                seen[toxic].update(terms(text))
                rows[toxic] += 1
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict({
            "term": pa.array([*names, ""], pa.string()),
            "clean": pa.array([*(seen[0][n] for n in names), rows[0]], pa.int64()),
            "toxic": pa.array([*(seen[1][n] for n in names), rows[1]], pa.int64())})

    counts = materialize(
        training.select("text", "toxic").mapInArrow(count, "term string, clean bigint, toxic bigint")
        .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    total = counts.where("term = ''").first()
    if total is None or not total.toxic:
        return []
    odds = (F.log((F.col("toxic") + 0.5) / (total.toxic - F.col("toxic") + 0.5))
            - F.log((F.col("clean") + 0.5) / (total.clean - F.col("clean") + 0.5)))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (counts.where((F.col("term") != "") & (F.col("toxic") >= LEAST_TOXIC))
            .withColumn("odds", odds).where(F.col("odds") >= LEAST_LOG_ODDS)
            .orderBy((F.col("odds") / spread).desc(), "term").limit(VOTERS))
    return sorted(r.term for r in best.select("term").collect())


def label_model(votes: np.ndarray, label: np.ndarray, rounds: int = ROUNDS):
    """Posterior of each row, from votes (rows by voters, 0 or 1) and given labels.

    The latent truth is found by expectation and maximisation; the given label is
    one more voter whose accuracy is estimated too. Voters that agree beyond what
    the truth explains (residual correlation) share one voice: each counts by the
    inverse of the sum of its squared correlations. Returns the posteriors and,
    per voter, its log odds and that share.
    """
    n, m = votes.shape
    # Votes are small numbers, gone through in blocks: no wider copy of all of them.
    blocks = [slice(at, at + BLOCK_ROWS) for at in range(0, n, BLOCK_ROWS)]

    def weighed(by: np.ndarray) -> np.ndarray:
        return sum((by[b] @ votes[b] for b in blocks), np.zeros(m))

    posterior = np.where(label == 1, 0.9, 0.05)
    share = np.ones(m)
    for turn in range(rounds):
        weight = posterior.sum()
        rate = np.stack([(weighed(1 - posterior) + 0.1) / (n - weight + 1),
                         (weighed(posterior) + 0.1) / (weight + 1)])
        if turn in (0, rounds // 2):
            moments = np.zeros((m, m))
            for b in blocks:
                rest = votes[b] - np.outer(1 - posterior[b], rate[0]) - np.outer(posterior[b], rate[1])
                moments += rest.T @ rest
            deviation = np.sqrt(np.maximum(np.diag(moments), 1e-9))
            share = 1 / np.maximum(((moments / np.outer(deviation, deviation)) ** 2).sum(0), 1.0)
        agree = np.clip(np.array([((1 - posterior) @ (label == 0) + 1) / (n - weight + 2),
                                  (posterior @ (label == 1) + 1) / (weight + 2)]), 0.55, 0.99)
        on = np.log(rate[1] / rate[0]) * share
        off = np.log((1 - rate[1]) / (1 - rate[0])) * share
        prior = np.clip(weight / n, 1e-3, 1 - 1e-3)
        said = np.concatenate([votes[b] @ (on - off) for b in blocks]) if blocks else np.zeros(0)
        logit = (np.log(prior / (1 - prior)) + said + off.sum()
                 + np.where(label == 1, np.log(agree[1] / (1 - agree[0])),
                            np.log((1 - agree[1]) / agree[0])))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, on - off, share


def linear_classifier(features: np.ndarray, posterior: np.ndarray, steps: int = 400,
                      penalty: float = 1e-5) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression on posteriors."""
    n, m = features.shape
    weights, first, second = np.zeros(m + 1), np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        logit = features @ weights[:-1].astype(features.dtype) + weights[-1]
        miss = ((1 / (1 + np.exp(-logit)) - posterior) / max(n, 1)).astype(features.dtype)
        slope = np.append(features.T @ miss + penalty * weights[:-1], miss.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        weights -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    return weights


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> dict[str, float]:
    """The classifier: weight by voter, ``""`` for the constant. Without any toxic
    label it has no voters and scores every text alike."""
    training = training_texts(docs, labels, rows)
    chosen = _voter_terms(training)
    names = chosen + FIXED
    place = {n: i for i, n in enumerate(names)}

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = []
            for text in batch.column(1).to_pylist():
                own = terms(text)
                votes.append(sorted(place[v] for v in (own | _fixed_votes(text, own)) if v in place))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(votes, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "votes"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        label = table["toxic"].to_numpy()
        matrix = np.zeros((len(label), len(names)), np.float32)
        own = table["votes"].combine_chunks()
        matrix[np.repeat(np.arange(len(label)), own.value_lengths().to_numpy()), own.flatten().to_numpy()] = 1
        posterior, _, _ = label_model(matrix, label)
        weights = linear_classifier(matrix, posterior)
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64()))})

    votes = training.select("doc_id", "text", "toxic").mapInArrow(
        vote, "doc_id bigint, toxic int, votes array<int>")
    # The bounded draw is what one task fits; its rows are short lists of numbers.
    fitted = votes.withColumn("model", F.lit("toxic")).groupBy("model").applyInArrow(train, "weights array<double>").first()
    if fitted is None:
        return {"": -3.0}
    return dict(zip([*names, ""], fitted.weights))


def scorer(model: dict[str, float]):
    """A function from a text column to its score: that of a text no voter speaks
    on for null and empty ones. Nothing else is an input."""
    constant = model[""]

    def one(text: str) -> float:
        own = terms(text)
        votes = [model[v] for v in own | _fixed_votes(text, own) if v in model and v]
        return 1 / (1 + float(np.exp(-np.clip(sum(sorted(votes)) + constant, -30, 30))))

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([one(t or "") for t in batch], dtype="float64")

    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Repeated rows give repeated rows, an empty table none. Labels other than 0
    and 1, null ids and labels without a text teach nothing; of several labels
    of a document the larger counts.
    """
    score = scorer(fit(docs, labels, rows))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text").cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows the classifier rejects, columns unchanged."""
    score = scorer(fit(docs, labels))
    return docs.where(score(docs["text"].cast("string")) < threshold)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the labels."""
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
