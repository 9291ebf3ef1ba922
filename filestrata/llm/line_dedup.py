"""Repeated lines and sentences: every later copy goes, the earliest stays.

A unit is a line, or a sentence within a line, of any length. Units are normalised
(lower case, one space between words) and hashed; the digest of a unit that occurs
again is looked up once, and the earliest occurrence by document and offset is kept.
Where ``line_words`` says that a list or a refrain may repeat short lines, they are
told apart by their turn within a document: the n-th copy goes if an earlier
document has n of them. ``op9_line_dedup`` spares no line.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import read

# Lines of fewer words are short for ``remove_repeats`` by default. A letter of a script that is written without
# spaces is a word of its own.
LINE_WORDS = 5

_LINE = re.compile(r"[^\n]+")
_SENTENCE = re.compile(r"[^\s][^\n]*?(?:[.!?](?=\s)|[\u3002\uff01\uff0e\uff1f\uff61]|(?=\n)|$)")
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
                       r"\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def units(text: str, line_words: int = 0):
    """``(start, end, digest)`` of each unit; lines come before their sentences,
    offsets are code points of the text as given."""
    short: Counter = Counter()
    for line in _LINE.finditer(text):
        words = line[0].lower().split()
        if not words:
            continue
        key = "\n".join(words)
        if len(words) < line_words and len(words) + len(_UNSPACED.findall(key)) < line_words:
            short[key] += 1
            if short[key] > 1:
                # No word begins with a line end.
                key = f"{key}\n\n{short[key]}"
        yield line.start(), line.end(), md5(key.encode()).digest()
        for sentence in _SENTENCE.finditer(text, line.start(), line.end()):
            # A line's only sentence is the line.
            if sentence[0].strip() != line[0].strip():
                key = "\n".join(sentence[0].lower().split())
                yield sentence.start(), sentence.end(), md5(key.encode()).digest()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, line_words: int = LINE_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text`` (as given), ``kept_text`` and
    ``removed`` (array of start, end in the given text, merged).

    The earliest occurrence has the smallest ``doc_id`` (null first), then the
    smallest offset; a repeat within one document goes too, but for lines of fewer
    than ``line_words`` words (see above; 0: none). Line ends stay. Null
    and empty texts give an empty text and no spans; rows with the same
    ``doc_id`` and text are one document, given out as often as they came; an
    empty table gives no rows; other columns are ignored.
    """
    def halves(digests: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = halves([d for text in batch.column(0).to_pylist() for *_, d in units(text, line_words)])
            seen, n = np.unique(half[:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], names=["half", "n"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(doc, key, s, e, d)
                   for doc, key, text in zip(*(c.to_pylist() for c in batch.columns))
                   for s, e, d in units(text, line_words)]
            *columns, digests = list(zip(*out)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, types)), *map(pa.array, halves(digests).T.copy())],
                names=["doc_id", "key", "start", "end", "half", "other"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = _merged([(s["start"], s["end"]) for s in spans or ()])
                ends = [0, *(e for _, e in spans)]
                kept.append("".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in spans), len(text)])))
                removed.append([{"start": s, "end": e} for s, e in spans])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kept, pa.string()), pa.array(removed, kind)],
                names=["doc_id", "text", "kept_text", "removed"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint"), text.alias("text")).withColumn(
        "key", F.xxhash64("text"))
    # Half a digest tells what cannot be a repeat: all units are counted by it, and
    # only those it leaves are written. Scanning twice costs less disk than writing all.
    # Written, so that the join reads both sides as they are and can split a common unit.
    again = materialize(
        texts.select("text").mapInArrow(count, "half bigint, n bigint").groupBy("half").agg(
            F.sum("n").alias("n")).where("n > 1").select("half"), "again")
    found = materialize(texts.select("doc_id", "key", "text").mapInArrow(
        scan, "doc_id bigint, key bigint, start int, end int, half bigint, other bigint")
        .join(again, "half"), "units")
    digest, place = ["half", "other"], F.struct("doc_id", "key", "start")
    # Rows may repeat a document: places, not rows, make a repeat.
    firsts = found.groupBy(*digest).agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        F.col("first") != F.col("last")).select(*digest, "first")
    later = found.join(firsts, digest).where(place != F.col("first"))
    spans = later.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")).select(
        F.col("doc_id").alias("s_doc"), F.col("key").alias("s_key"), "spans")
    joined = texts.join(spans, texts["doc_id"].eqNullSafe(spans["s_doc"])
                        & (texts["key"] == spans["s_key"]), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, "doc_id bigint, text string, kept_text string, "
             "removed array<struct<start:int,end:int>>")


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document loses to earlier copies of its lines and sentences."""
    done = remove_repeats(read(spark, sf_dir, "documents"), line_words=0)
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return done.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        (F.length("text") - F.length("kept_text")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.array_join(spans, ",").alias("spans"), F.sha2("kept_text", 256).alias("kept_sha256"))
