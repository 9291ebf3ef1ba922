"""Byte-level BPE by a table of distinct words.

Texts are split into the words that BPE never merges across. A block of
documents ships each of its distinct words once; every distinct word is encoded
once; ids go back to the blocks and are put at the places of the words. Decoding
joins ids with the vocabulary's pieces.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pack, partitions, read, text_blocks, unpack

# Fixed values of the split pattern of byte-level BPE: its white space (as ranges)
# and the English endings it cuts off, in its order.
WHITE_SPACE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
               (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
               (0x3000, 0x3000))
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

# They bound a task's memory: code points of a block's texts, code points of all
# texts for each bucket of words, words that the tokenizer encodes at a time, and
# code points that are split at a time.
BLOCK_CHARS = 2 << 20
BUCKET_CHARS = 64 << 20
WORDS_AT_ONCE = 10_000
SPLIT_CHARS = 1 << 18


def character_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    for low, high in WHITE_SPACE:
        table[low:high + 1] = SPACE
    return table


def _segments(texts: list[str], special: list[str]) -> tuple[list[str], list[int], list[bool]]:
    """Texts cut at special tokens: pieces, their text's index, whether special."""
    pieces, owners, marks = [], [], []
    for owner, text in enumerate(texts):
        rest = text
        while rest:
            hits = [(rest.find(s), -len(s), s) for s in special if s in rest]
            if not hits:
                pieces.append(rest)
                owners.append(owner)
                marks.append(False)
                break
            at, _, found = min(hits)
            if at:
                pieces.append(rest[:at])
                owners.append(owner)
                marks.append(False)
            pieces.append(found)
            owners.append(owner)
            marks.append(True)
            rest = rest[at + len(found):]
    return pieces, owners, marks


def split_words(texts: list[str], special: list[str],
                classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and for each text the index of its first
    word (with the total at the end). Joined, a text's words give the text.
    ``classes`` is ``character_classes()``, built once on the driver.

    A code point takes some 60 bytes while it is looked at, so texts are split a
    few at a time; no word reaches from one text into another.
    """
    words, first, total, start, held = [], [np.zeros(1, np.int64)], 0, 0, 0
    for at, text in enumerate(texts, 1):
        held += len(text)
        if held >= SPLIT_CHARS or at == len(texts):
            own, begins = _split(texts[start:at], special, classes)
            words.append(own)
            first.append(begins[1:] + total)
            total, start, held = total + len(own), at, 0
    return pa.chunked_array(words, pa.large_string()).combine_chunks(), np.concatenate(first)


def _split(texts: list[str], special: list[str],
           classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """``split_words`` of some texts at once.

    The rule is the public split pattern of byte-level BPE: runs of letters,
    numbers or other signs, each with one leading space; English endings; white
    space, the last of a run being left to what follows.
    """
    pieces, owners, marks = _segments(texts, special)
    code = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
    n = len(code)
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    begins = np.concatenate([[0], ends])[:-1].astype(np.int64)
    kind = classes[code]
    start = np.empty(n + 1, bool)
    start[n] = True
    if n:
        np.not_equal(kind[1:], kind[:-1], out=start[1:n])
        start[begins] = True
        # Ends of white-space runs before something else in the same piece.
        before = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
        first = np.zeros(n + 1, bool)
        first[begins] = True
        before = before[~first[before + 1]]
        start[before] = True
        attached = before[code[before] == 0x20]
        start[attached + 1] = False
        # Endings: an apostrophe that begins a word, then letters in the same piece.
        quote = np.flatnonzero((code[:-1] == 0x27) & start[:n - 1] & (kind[1:] == LETTER))
        quote = quote[~first[quote + 1]]
        taken = np.zeros(len(quote), bool)
        padded = np.concatenate([code, np.zeros(2, np.uint32)])
        cut = np.concatenate([first, [True]])
        for ending in ENDINGS:
            hit = ~taken & (padded[quote + 1] == ord(ending[0]))
            if len(ending) == 2:
                hit &= (padded[quote + 2] == ord(ending[1])) & ~cut[quote + 2]
            taken |= hit
            start[quote[hit] + 1] = False
            start[quote[hit] + 1 + len(ending)] = True
        for at in np.flatnonzero(marks):
            start[begins[at] + 1:ends[at]] = False
            start[ends[at]] = True
    width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    where = np.flatnonzero(start)
    offsets = np.concatenate([[0], np.cumsum(width)])[where]
    words = pa.LargeStringArray.from_buffers(
        len(where) - 1, pa.py_buffer(offsets.astype(np.int64)),
        pa.py_buffer("".join(pieces).encode()))
    per_text = np.zeros(len(texts) + 1, np.int64)
    np.add.at(per_text[1:], owners, ends - begins)
    return words, np.searchsorted(where, np.cumsum(per_text))


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def _gather(offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of chosen lists one after the other, and their counts."""
    counts = (offsets[1:] - offsets[:-1])[chosen]
    total = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(total[-1]) - np.repeat(total[:-1] - offsets[:-1][chosen], counts), counts


def _dealt(words: pa.Array, buckets: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each place the index of its distinct word, the distinct words by bucket and
    then by letters, and where each bucket's begin (with the total at the end)."""
    import zlib

    coded = words.dictionary_encode()
    distinct = coded.dictionary
    letters = pc.sort_indices(distinct).to_numpy()
    distinct = distinct.take(pa.array(letters))
    bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in distinct.to_pylist()),
                         np.int64, len(distinct))
    order = np.argsort(bucket, kind="stable")
    index = np.empty(len(order), np.int64)
    index[letters[order]] = np.arange(len(order))
    return (index[coded.indices.to_numpy()], distinct.take(pa.array(order)),
            np.searchsorted(bucket[order], np.arange(buckets + 1)))


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``id`` and ``piece`` (bytes) of every token: its size is the tokenizer's."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign_of = {byte: byte for byte in plain}
    sign_of |= {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in sign_of)}
    byte_of = {chr(sign): byte for byte, sign in sign_of.items()}
    pieces = {i: bytes(byte_of[c] for c in token) for token, i in model["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in model["added_tokens"]}
    ids = sorted(pieces)
    # A table of Arrow: from rows, Spark would start Python workers of another kind on
    # the executors, which stay beside those of the tasks.
    return spark.createDataFrame(pa.table({
        "id": pa.array(ids, pa.int32()), "piece": pa.array([pieces[i] for i in ids], pa.binary())}))


def encode_and_decode(docs: DataFrame, tokenizer_path: str,
                      block_bytes: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` of every row of ``docs``.

    The ids are those of the whole text with no special tokens added; special
    tokens that a text spells out are recognised. Null and empty texts have no
    ids; repeated rows give repeated rows; an empty table none; other columns
    are ignored.
    """
    spark = docs.sparkSession
    blocks = text_blocks(docs, block_bytes)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(partitions(spark), -(-size // BUCKET_CHARS))
    special, classes = special_tokens(tokenizer_path), character_classes()
    tokenizers: dict = {}  # one for each task
    pieces = [row.piece for row in vocabulary(spark, tokenizer_path).orderBy("id").collect()]
    shared = spark.sparkContext.broadcast(pieces)
    kind = np.uint16 if len(pieces) <= 1 << 16 else np.int32

    def words_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs_blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, _ = split_words(
                    unpack(docs_blob.as_buffer())["text"].to_pylist(), special, classes)
                _, distinct, edges = _dealt(words, buckets)
                used = np.flatnonzero(np.diff(edges))
                blobs = [pack(pa.table({"word": distinct[edges[b]:edges[b + 1]]})) for b in used]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(used, pa.int32()),
                    "block": pa.array(np.full(len(used), block), pa.int64()),
                    "words": pa.array(blobs, pa.binary())})

    def encode(table: pa.Table) -> pa.Table:
        if not tokenizers:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tokenizers[0] = Tokenizer.from_file(tokenizer_path)
        lists = [unpack(w)["word"].combine_chunks() for w in table["words"].to_pylist()]
        coded = pa.chunked_array(lists).combine_chunks().dictionary_encode()
        per_slice, ids_of_slice = [], []
        for at in range(0, len(coded.dictionary), WORDS_AT_ONCE):
            # What the tokenizer returns of a word is far larger than its ids.
            encoded = [e.ids for e in tokenizers[0].encode_batch(
                coded.dictionary.slice(at, WORDS_AT_ONCE).to_pylist(), add_special_tokens=False)]
            per_slice.append(np.fromiter(map(len, encoded), np.int64, len(encoded)))
            ids_of_slice.append(np.fromiter((i for e in encoded for i in e), kind, per_slice[-1].sum()))
        counts, ids = np.concatenate(per_slice), np.concatenate(ids_of_slice)
        at, n = _gather(np.concatenate([[0], np.cumsum(counts)]), coded.indices.to_numpy())
        per_word = np.concatenate([[0], np.cumsum(n)])
        edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        replies = [pack(pa.table({
            "counts": pa.array([n[a:b].astype(np.int32)], pa.list_(pa.int32())),
            "ids": pa.array([ids[at[per_word[a]:per_word[b]]]])})) for a, b in zip(edges[:-1], edges[1:])]
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "ids": pa.array(replies, pa.binary())})

    def put_back(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        ordered = replies.sort_by("bucket") if len(replies) else replies
        parts = [unpack(x) for x in ordered["ids"].to_pylist()]
        join = lambda name, kind: np.concatenate(
            [np.empty(0, kind), *(p[name].chunk(0).values.to_numpy() for p in parts)])
        n, ids = join("counts", np.int64).astype(np.int64), join("ids", kind).astype(np.int32)
        piece_of = pa.array(shared.value, pa.large_binary())
        for docs_blob in blocks["docs"]:
            packed = unpack(docs_blob.as_buffer())
            words, first = split_words(packed["text"].to_pylist(), special, classes)
            places, distinct, _ = _dealt(words, buckets)
            if len(n) != len(distinct):
                raise ValueError("a block's words and its replies differ")
            at, per_place = _gather(np.concatenate([[0], np.cumsum(n)]), places)
            own = ids[at]
            edges = np.concatenate([[0], np.cumsum(per_place)])[first]
            joined = piece_of.take(pa.array(own))
            spots = np.frombuffer(joined.buffers()[1], np.int64, len(own) + 1)[edges]
            data = memoryview(joined.buffers()[2] or b"")
            decoded = [bytes(data[a:b]).decode("utf-8", "replace")
                       for a, b in zip(spots[:-1], spots[1:])]
            out.append(pa.table({
                "doc_id": packed["doc_id"],
                "ids": pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()),
                                                     pa.array(own)).cast(pa.list_(pa.int32())),
                "decoded": pa.array(decoded, pa.string())}))
        return pa.concat_tables(out)

    dealt = blocks.select("block", "docs").mapInArrow(
        words_of, "bucket int, block bigint, words binary")
    replies = dealt.groupBy("bucket").applyInArrow(
        encode, "block bigint, bucket int, ids binary")
    return blocks.select("block", "docs").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        put_back, "doc_id bigint, ids array<int>, decoded string")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents and the round trip, as digests."""
    import public_tokenizers

    coded = encode_and_decode(read(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
