"""Repeated byte strings by suffix order and longest previous factors.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller id. Suffixes are needed only to that depth, and only
where a repeat is possible at all:

1. Every window of ``length`` bytes picks an anchor, its gram of the smallest
   hash. Equal windows pick equal grams, so a window can repeat only where its
   anchor's gram is found again. The windows of an anchor make a piece of text.
   Blocks of documents send the digests of each gram and piece, once, with the
   smallest document that has it, to the gram's bucket.
2. The bucket answers, for each piece of a block, whether a smaller document of
   another block has the same one, which settles all its windows, and whether its
   gram stands in other pieces too. Only the first holders of those, the borders
   of repeated text, send text: to the bucket of their gram, or, where very many
   blocks share the gram, window by window to buckets of the window's own text.
3. A bucket sorts its windows' suffixes, takes the common prefix of neighbours,
   and from the previous and the next suffix of a smaller document the longest
   previous factor of each. What reaches ``length`` is a repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import partitions, read, text_blocks, unpack

LENGTH = 50
# Bytes of the grams that anchor windows; a power of 2.
GRAM = 32
# A gram in more blocks than this is dealt out window by window.
HOT_BLOCKS = 64
BLOCK_BYTES = 4 << 20

_K = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# A null id comes after all others.
_LAST = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_K), n, 1 << 64))


def _hashes(data: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of all grams and of all windows."""
    size, whole = 1, data.astype(np.uint64) + np.uint64(1)
    grams, window, covered = whole, None, 0
    rest = length
    while True:
        if rest & 1:
            # Windows are put together from powers of two, the smallest first.
            if window is None:
                window, covered = whole, size
            else:
                n = len(data) - size - covered + 1
                window = whole[:n] * _power(covered) + window[size:size + n]
                covered += size
        if size == gram:
            grams = whole
        rest >>= 1
        if not rest and size >= gram:
            return grams, window
        whole = whole[:len(whole) - size] * _power(size) + whole[size:]
        size *= 2


class Anchors:
    """Windows of a block by anchor.

    ``gram`` (hash), ``doc`` (index in the block), ``first`` (byte in the block)
    and ``count`` of the windows that pick it, in order. ``hash`` is that of the
    window at each byte.
    """

    def __init__(self, texts: list[str], length: int, gram: int):
        encoded = [t.encode() for t in texts]
        self.raw = b"".join(encoded)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.gram, self.doc = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        if len(self.data) < length:
            return
        grams, self.hash = _hashes(self.data, gram, length)
        span = length - gram + 1
        # The smallest hash, the leftmost of equal ones; its place is in the low half.
        low = (_mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[:len(low) - (span - size)], low[span - size:])
        place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(len(place), bool)
        valid = np.flatnonzero(self.ends - self.begins >= length)
        step = np.zeros(len(place) + 1, np.int32)
        np.add.at(step, self.begins[valid], 1)
        np.add.at(step, self.ends[valid] - length + 1, -1)
        inside = np.cumsum(step[:-1]) > 0
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
        fresh[self.begins[valid]] = True
        starts = np.flatnonzero(fresh & inside)
        stops = np.flatnonzero(~inside)
        after = np.append(starts[1:], len(place))
        if len(stops):
            k = np.searchsorted(stops, starts)
            hard = np.where(k < len(stops), stops[np.minimum(k, len(stops) - 1)], len(place))
            after = np.minimum(after, hard)
        self.gram, self.first, self.count = grams[place[starts]], starts, after - starts
        self.doc = np.searchsorted(self.ends, starts, side="right")


def _short(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and digest (40 bits) of grams. Grams whose digests meet by chance cost
    a comparison, not a wrong result."""
    scrambled = _mix(gram * _K)
    return (scrambled % np.uint64(buckets)).astype(np.int64), scrambled >> np.uint64(24)


def _narrow(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of 64-bit numbers."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widen(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1).astype(np.uint64)


class Pieces:
    """The anchors of a block in the order of bucket, gram, piece, id and place.

    ``entry`` numbers the distinct (gram, piece) in that order; ``heads`` are their
    first anchors, those of the smallest id. ``piece`` is a digest (48 bits) of all
    a piece's bytes: of its first and its last window, which cover it.
    """

    def __init__(self, anchors: Anchors, ids: np.ndarray, buckets: int):
        first, last = anchors.hash[anchors.first], anchors.hash[anchors.first + anchors.count - 1]
        piece = _mix(_mix(first) * _K + last + anchors.count.astype(np.uint64)) >> np.uint64(16)
        bucket, gram = _short(anchors.gram, buckets)
        id_of = ids[anchors.doc]
        order = np.lexsort((anchors.first, id_of, piece, gram, bucket))
        self.bucket, self.gram, self.piece = bucket[order], gram[order], piece[order]
        self.id, self.row = id_of[order], anchors.doc[order]
        self.first, self.count = anchors.first[order], anchors.count[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = ((self.bucket[1:] != self.bucket[:-1]) | (self.gram[1:] != self.gram[:-1])
                     | (self.piece[1:] != self.piece[:-1]))
        self.heads, self.entry = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        # A gram in very many pieces, the end of a common passage, is sent once for
        # all of them: ``sent`` is each entry's place among those sent.
        bucket, gram = self.bucket[self.heads], self.gram[self.heads]
        first_of_gram = np.ones(len(self.heads), bool)
        first_of_gram[1:] = (bucket[1:] != bucket[:-1]) | (gram[1:] != gram[:-1])
        at = np.flatnonzero(first_of_gram)
        per_gram = np.diff(np.append(at, len(self.heads)))
        self.many = np.repeat(per_gram > MANY_PIECES, per_gram)
        goes = ~self.many | first_of_gram
        self.sent, self.senders = np.cumsum(goes) - 1, np.flatnonzero(goes)
        self.digest = np.where(self.many, MANY, self.piece[self.heads])[goes]
        least = np.minimum.reduceat(self.id[self.heads], at) if len(at) else self.id[:0]
        self.smallest = np.where(self.many, np.repeat(least, per_gram), self.id[self.heads])[goes]


def _leaders(text: np.ndarray, begin: np.ndarray, sizes: np.ndarray, rank: np.ndarray,
             head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """For each piece of text the equal one of smallest rank. Hashes of the first and
    the last window bring equal pieces together, their bytes decide."""
    order = np.lexsort((rank, sizes, tail, head))
    fresh = np.ones(len(order), bool)
    for key in (head, tail, sizes):
        k = key[order]
        fresh[1:] &= k[1:] == k[:-1]
    fresh[1:] = ~fresh[1:]
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    others = np.flatnonzero(leader != np.arange(len(order)))
    width = np.arange(sizes.max(initial=0))
    for at in range(0, len(others), 100_000):
        part = others[at:at + 100_000]
        inside = width < sizes[part][:, None]
        last = len(text) - 1
        same = (text[np.minimum(begin[part][:, None] + width, last)]
                == text[np.minimum(begin[leader[part]][:, None] + width, last)]) | ~inside
        wrong = part[~same.all(1)]
        leader[wrong] = wrong
    return leader


def _nearest_smaller(rank: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each suffix the common prefix with the nearest one before it that has a
    smaller rank (0 if none). ``common[i]`` is that of i - 1 and i."""
    at, prefix = np.arange(len(rank)) - 1, common.copy()
    while True:
        wrong = np.flatnonzero((at >= 0) & (rank[at] >= rank) & (prefix > 0))
        if not len(wrong):
            return np.where(at >= 0, prefix, 0)
        to = at[wrong]
        at[wrong], prefix[wrong] = at[to], np.minimum(prefix[wrong], prefix[to])


def longest_previous(windows: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each row of ``windows`` (suffixes cut at the same depth) the longest
    prefix it shares with a row of smaller rank: the longer one of those with the
    previous and the next smaller row in suffix order."""
    n, depth = windows.shape
    padded = np.zeros((n, -(-depth // 8) * 8), np.uint8)
    padded[:, :depth] = windows
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((rank, *words.T[::-1]))
    sorted_rows, ranks = words[order], rank[order]
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = sorted_rows[1:] != sorted_rows[:-1]
        word = np.argmax(differ, 1)
        some = differ[np.arange(n - 1), word]
        a = np.ascontiguousarray(padded[order][1:]) != padded[order][:-1]
        common[1:] = np.where(some, np.argmax(a, 1), depth)
    before = _nearest_smaller(ranks, common)
    flipped = np.concatenate([[0], common[1:][::-1]])
    after = _nearest_smaller(ranks[::-1], flipped)[::-1]
    out = np.empty(n, np.int64)
    out[order] = np.maximum(before, after)
    return out


def _spans(docs: np.ndarray, firsts: np.ndarray, counts: np.ndarray, length: int):
    """Document, start and end of the bytes that windows cover, in order and merged;
    ``counts`` windows follow each other from every one of ``firsts``."""
    order = np.lexsort((firsts, docs))
    d, s = docs[order], firsts[order]
    e = s + counts[order] + length - 1
    new = np.ones(len(d), bool)
    # Starts rise within a document, and so do ends: anchors follow each other.
    new[1:] = (d[1:] != d[:-1]) | (s[1:] > np.maximum.accumulate(e)[:-1])
    at = np.flatnonzero(new)
    return d[at], s[at], np.maximum.reduceat(e, at) if len(at) else e[:0]


def _squeeze(numbers: np.ndarray) -> bytes:
    """Numbers as compressed differences: short where they mostly rise slowly."""
    raw = np.diff(numbers.astype(np.int64), prepend=np.int64(0)).tobytes()
    return pa.compress(raw, "zstd", asbytes=True) + len(raw).to_bytes(8, "little")


def _unsqueeze(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), "zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, np.int64))


# A block sends a gram with more pieces than this as one, under this digest.
MANY_PIECES = 16
MANY = np.uint64((1 << 48) - 1)

# What a bucket says of a piece: no other of its gram; an earlier document has the
# same; to be compared with others of its gram, as a whole or window by window.
ALONE, SETTLED, BY_PIECE, BY_WINDOW = range(4)

# Pieces a block sends to a bucket, by their place in the block; at bucket -1 the
# spans that are settled without a comparison, as ``firsts`` and bytes ``counts``.
_PIECE_TYPES = {"bucket": pa.int32(), "block": pa.int64()} | dict.fromkeys(
    ("text", "firsts", "counts", "ids", "docs"), pa.binary())
_PIECES = ", ".join(f"{n} {'int' if n == 'bucket' else 'bigint' if n == 'block' else 'binary'}"
                    for n in _PIECE_TYPES)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   hot_blocks: int = HOT_BLOCKS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``removed`` (array of start,
    end: maximal runs of bytes) and ``kept`` (the other bytes).

    Strings are judged on the input, matches never cross documents, overlaps
    count. Rows with the same ``doc_id`` are not earlier than each other; a null
    id comes after all others; null texts are empty and shorter ones than
    ``length`` stay whole. Repeated rows give repeated rows, an empty table none;
    other columns are ignored.
    """
    if not gram <= length <= gram + 127 or gram & (gram - 1):
        raise ValueError("gram must be a power of 2, at most length and less than 128 below it")
    spark = docs.sparkSession
    blocks = text_blocks(docs, block_bytes).select("block", "docs")
    buckets = max(partitions(spark), blocks.count())

    def ids_of(packed: pa.Table) -> np.ndarray:
        return pa.compute.fill_null(packed["doc_id"], _LAST).to_numpy().astype(np.int64)

    def block_of(blob) -> tuple[np.ndarray, Anchors]:
        packed = unpack(blob)
        ids = ids_of(packed)
        return ids, Anchors(packed["text"].to_pylist(), length, gram)

    def grams_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, anchors = block_of(blob.as_buffer())
                pieces = Pieces(anchors, ids, buckets)
                heads = pieces.heads[pieces.senders]
                bucket, gram = pieces.bucket[heads], pieces.gram[heads]
                piece, smallest = pieces.digest, pieces.smallest
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                parts = [slice(edges[b], edges[b + 1]) for b in used]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(used, pa.int32()),
                    "block": pa.array(np.full(len(used), block), pa.int64()),
                    "grams": pa.array([_narrow(gram[p], 5) + _narrow(piece[p], 6) for p in parts],
                                      pa.binary()),
                    "ids": pa.array([_squeeze(smallest[p]) for p in parts], pa.binary())})

    def share(table: pa.Table) -> pa.Table:
        lists = table["grams"].to_pylist()
        counts = np.array([len(x) // 11 for x in lists])
        gram = np.concatenate([_widen(x[:5 * n], 5) for x, n in zip(lists, counts)])
        piece = np.concatenate([_widen(x[5 * n:], 6) for x, n in zip(lists, counts)])
        smallest = np.concatenate([_unsqueeze(x) for x in table["ids"].to_pylist()])
        order = np.lexsort((smallest, piece, gram))
        g, p, i = gram[order], piece[order], smallest[order]
        new_gram = np.concatenate([[True], g[1:] != g[:-1]])
        new_piece = new_gram | np.concatenate([[True], p[1:] != p[:-1]])
        gram_at, piece_at = np.flatnonzero(new_gram), np.flatnonzero(new_piece)
        per_gram = np.diff(np.append(gram_at, len(g)))
        least = np.repeat(i[piece_at], np.diff(np.append(piece_at, len(p))))
        other_pieces = np.repeat(np.add.reduceat(new_piece, gram_at) > 1, per_gram)
        other_ids = np.repeat(np.minimum.reduceat(i, gram_at) != np.maximum.reduceat(i, gram_at), per_gram)
        many = np.repeat(np.logical_or.reduceat(p == MANY, gram_at), per_gram)
        hot = many | np.repeat(per_gram > hot_blocks, per_gram)
        # Blocks that hold a piece for the same id all send it: they are one document.
        settled = (i > least) & (p != MANY)
        said = np.where(settled, SETTLED, np.where(many | (other_pieces & other_ids), np.where(
            hot, BY_WINDOW, BY_PIECE), ALONE)).astype(np.uint8)
        answers = np.empty(len(order), np.uint8)
        answers[order] = said
        parts = np.split(answers, np.cumsum(counts)[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "said": pa.array([x.tobytes() for x in parts], pa.binary())})

    def pieces_of(block_rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = block_rows["block"][0].as_py()
        if not len(replies):
            return pa.table({n: pa.array([], kind) for n, kind in _PIECE_TYPES.items()})
        ids, anchors = block_of(block_rows["docs"][0].as_buffer())
        pieces = Pieces(anchors, ids, buckets)
        replies = replies.sort_by("bucket")
        said = np.frombuffer(b"".join(replies["said"].to_pylist()), np.uint8)
        said = said[pieces.sent][pieces.entry]
        # A later document of the block repeats the piece of an earlier one.
        settled = (said == SETTLED) | (pieces.id > pieces.id[pieces.heads][pieces.entry])
        d, s, e = _spans(pieces.row[settled], pieces.first[settled], pieces.count[settled], length)
        out = {n: [] for n in _PIECE_TYPES}
        out["bucket"].append(-1)
        out["block"].append(block)
        for name, data in (("docs", d), ("firsts", s), ("counts", e - s)):
            out[name].append(_squeeze(data))
        for name in ("text", "ids"):
            out[name].append(b"")
        whole = np.flatnonzero(~settled & (said == BY_PIECE))
        single = np.flatnonzero(~settled & (said == BY_WINDOW))
        # A window of a hot gram is a piece of its own.
        times = pieces.count[single]
        first = np.concatenate([pieces.first[whole], np.repeat(pieces.first[single], times)
                                + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)])
        count = np.concatenate([pieces.count[whole], np.ones(times.sum(), np.int64)])
        row = np.concatenate([pieces.row[whole], np.repeat(pieces.row[single], times)])
        bucket = np.concatenate([pieces.bucket[whole], (
            _mix(anchors.hash[first[len(whole):]]) % np.uint64(buckets)).astype(np.int64)])
        order = np.lexsort((first, bucket))
        first, count, row, bucket = (x[order] for x in (first, count, row, bucket))
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            text = b"".join(anchors.raw[f:f + c + length - 1] for f, c in zip(first[part], count[part]))
            out["bucket"].append(b)
            out["block"].append(block)
            out["text"].append(pa.compress(text, "zstd", asbytes=True)
                               + len(text).to_bytes(8, "little"))
            for name, data in (("firsts", first), ("counts", count), ("ids", ids[row]), ("docs", row)):
                out[name].append(_squeeze(data[part]))
        return pa.table({n: pa.array(v, _PIECE_TYPES[n]) for n, v in out.items()})

    def compare(table: pa.Table) -> pa.Table:
        def joined(name: str) -> tuple[np.ndarray, np.ndarray]:
            lists = [_unsqueeze(x) for x in table[name].to_pylist()]
            return np.concatenate(lists), np.array([len(x) for x in lists])

        text = np.frombuffer(b"".join(
            pa.decompress(t[:-8], int.from_bytes(t[-8:], "little"), "zstd", asbytes=True)
            for t in table["text"].to_pylist()), np.uint8)
        (count, per_block), (first, _), (rank, _), (doc, _) = map(
            joined, ("counts", "firsts", "ids", "docs"))
        sizes = count + length - 1
        begin = np.cumsum(sizes) - sizes
        _, hashed = _hashes(text, 1, length)
        # Equal pieces of several blocks: all of a later document's repeats the
        # earliest one's, which alone is compared with other pieces.
        leader = _leaders(text, begin, sizes, rank, hashed[begin], hashed[begin + count - 1])
        whole = rank > rank[leader]
        alone = np.flatnonzero(leader == np.arange(len(count)))
        times = count[alone]
        piece = np.repeat(alone, times)
        offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start = begin[piece] + offset
        hashed = hashed[start]
        # Windows whose hash no other document's has are no repeats.
        order = np.lexsort((rank[piece], hashed))
        h, r = hashed[order], rank[piece][order]
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        per_run = np.diff(np.append(heads, len(h)))
        several = np.repeat(r[heads] != r[heads + per_run - 1], per_run)
        chosen, runs = order[several], np.repeat(np.arange(len(heads)), per_run)[several]
        found = np.zeros(len(start), bool)
        # Equal hashes are next to each other: a part ends where a run of them does.
        step = 250_000
        cuts, at = [0], 0
        while at < len(chosen):
            at = min(at + step, len(chosen))
            while at < len(chosen) and runs[at] == runs[at - 1]:
                at += 1
            cuts.append(at)
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = chosen[a:b]
            windows = text[start[part][:, None] + np.arange(length)]
            found[part] = longest_previous(windows, rank[piece[part]]) >= length
        # Every piece's windows: those of its leader, or all.
        window_of = np.zeros(len(count), np.int64)
        window_of[alone] = np.cumsum(times) - times
        window_edge = np.concatenate([[0], np.cumsum(count)])
        each = np.repeat(np.arange(len(count)), count)
        offset = np.arange(window_edge[-1]) - window_edge[:-1][each]
        repeat = whole[each] | found[window_of[leader[each]] + offset]
        piece = each
        edge = np.concatenate([[0], np.cumsum(per_block)])
        out = {n: [] for n in ("block", "docs", "firsts", "counts")}
        for k, block in enumerate(table["block"].to_pylist()):
            hit = np.flatnonzero(repeat[window_edge[edge[k]]:window_edge[edge[k + 1]]]) + window_edge[edge[k]]
            if not len(hit):
                continue
            d, s, e = _spans(doc[piece[hit]], first[piece[hit]] + offset[hit],
                             np.ones(len(hit), np.int64), length)
            out["block"].append(block)
            for name, data in (("docs", d), ("firsts", s), ("counts", e - s)):
                out[name].append(_squeeze(data))
        return pa.table({n: pa.array(v, _PIECE_TYPES[n]) for n, v in out.items()})

    def cut(block_rows: pa.Table, spans: pa.Table) -> pa.Table:
        packed = unpack(block_rows["docs"][0].as_buffer())
        texts = [t.encode() for t in packed["text"].to_pylist()]
        d, s, n = (np.concatenate([np.empty(0, np.int64), *map(_unsqueeze, spans[name].to_pylist())])
                   for name in ("docs", "firsts", "counts"))
        order = np.lexsort((s, d))
        begins = np.cumsum([0, *map(len, texts)])
        d, s, e = d[order], (s - begins[d])[order], (s + n - begins[d])[order]
        edges = np.searchsorted(d, np.arange(len(texts) + 1))
        removed, kept = [], []
        for k, text in enumerate(texts):
            own: list[list[int]] = []
            for a, b in zip(s[edges[k]:edges[k + 1]].tolist(), e[edges[k]:edges[k + 1]].tolist()):
                if own and a <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], b)
                else:
                    own.append([a, b])
            ends = [0, *(b for _, b in own)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in own), len(text)])))
            removed.append([{"start": a, "end": b} for a, b in own])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": packed["doc_id"],
                         "n_bytes": pa.array(list(map(len, texts)), pa.int64()),
                         "removed": pa.array(removed, kind), "kept": pa.array(kept, pa.binary())})

    said = (blocks.mapInArrow(grams_of, "bucket int, block bigint, grams binary, ids binary")
            .groupBy("bucket").applyInArrow(share, "block bigint, bucket int, said binary"))
    pieces = materialize(
        blocks.groupBy("block").cogroup(said.groupBy("block")).applyInArrow(pieces_of, _PIECES), "pieces")
    known = pieces.where("bucket < 0").select("block", "docs", "firsts", "counts")
    spans = known.unionByName(pieces.where("bucket >= 0").groupBy("bucket").applyInArrow(
        compare, "block bigint, docs binary, firsts binary, counts binary"))
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        cut, "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 50 bytes in documents before it."""
    done = remove_repeats(read(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
