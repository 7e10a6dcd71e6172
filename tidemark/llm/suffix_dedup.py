"""Exact substring deduplication by distributed prefix doubling over sampled suffixes.

A byte goes if a string of ``length`` bytes over it also starts in a document with a
smaller doc_id. Plain prefix doubling gives every position of the corpus a
rank by its first 1, 2, 4, ... bytes and sorts (rank, rank at the offset)
pairs until ranks are unique or pass the threshold; each round shuffles all
positions. Here ranks are fingerprints, so the rounds up to ``seed`` bytes
need no shuffle: each is made from the one before at offsets 1, 2, 4, 8, ...
And only one suffix of every ``length - seed + 1`` neighbours is taken to
Spark, the one of least rank, which all copies of a string choose alike.

1. Spark sorts the ranks of the sampled suffixes. Those in one document only
   retire, with all strings that chose them.
2. The others are sorted again at ``length`` bytes: rank pairs of the bytes
   left and right of the sample, for every place of the string around it, with the
   least doc_id of each. That is past the threshold, and ends it.

Sampled suffixes travel packed, one row per chunk of documents and bucket of
ranks, and each distinct one once per chunk. A passage that a third of all
documents share is thus as many entries as there are chunks. Every step is
one plan: the texts are shuffled once, into chunks, and that exchange is
reused by the three passes over them.

Defined cases: null and empty texts keep nothing and remove nothing; texts
under ``length`` bytes lose nothing; a null doc_id counts as larger than any
other; rows with equal doc_id never remove from each other; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import mix, small_batches, text_column, utf8

SCHEMA = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "starts array<long>, ends array<long>")
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Doubling:
    length: int = 50           # bytes a repeat has at least
    seed: int = 20             # bytes of the first shuffled rank
    chunk_bytes: int = 2 << 20
    bucket_items: int = 200_000
    segment: int = 1 << 18     # bytes that the array kernels look at in one go

    @property
    def reach(self) -> int:    # suffixes of which one is sampled, and one more than the bytes on either side of it
        return self.length - self.seed + 1


_RNG = np.random.default_rng(11)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LEVEL = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def doubled(buf: np.ndarray, n: int) -> np.ndarray:
    """Rank (64-bit fingerprint) of the ``n`` bytes at every position, by doubling."""
    level, size, out, done = _BYTE[buf], 1, None, 0
    step = 0
    while True:
        if n & size:
            if out is None:
                out = level
            else:
                m = len(buf) - done - size + 1
                out = out[:m] * _LEVEL[32 + step] + level[done:done + m]
            done += size
        if done == n:
            return mix(out[:len(buf) - n + 1])
        m = len(level) - size
        level = level[:m] * _LEVEL[step] + level[size:size + m]
        size, step = size * 2, step + 1


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours, by doubling."""
    size = 1
    while size * 2 <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (w - size)], h[w - size:]) if w > size else h


@dataclass
class Runs:
    """Neighbouring strings that chose the same sampled suffix."""

    rank: np.ndarray     # of the sample
    row: np.ndarray      # document (row of the chunk)
    first: np.ndarray    # start of the first string in its document
    last: np.ndarray     # start of the last one
    sample: np.ndarray   # place of the sampled suffix in its document


def _segments(texts: list[bytes], p: Doubling) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Buffers of about ``segment`` bytes: [(row, start in text)], bytes, offset of each part (and the end)."""
    parts, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - p.length + 1), p.segment):
            piece = text[at:at + p.segment + p.length - 1]
            if parts and size + len(piece) > p.segment:
                yield _buffer(parts)
                parts, size = [], 0
            parts.append((row, at, piece))
            size += len(piece)
    if parts:
        yield _buffer(parts)


def _buffer(parts: list[tuple[int, int, bytes]]) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    offsets = np.cumsum([0, *(len(x) for *_, x in parts)])
    return [(r, a) for r, a, _ in parts], np.frombuffer(b"".join(x for *_, x in parts), np.uint8), offsets


def _least(buf: np.ndarray, offsets: np.ndarray, p: Doubling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of all suffixes; the string starts inside a part; the least rank each chooses."""
    ranks = doubled(buf, p.seed)
    least = sliding_min(ranks, p.reach)
    inside = np.ones(len(least), bool)
    for end in offsets[1:-1].tolist():
        inside[max(0, end - p.length + 1):end] = False
    at = np.flatnonzero(inside)
    return ranks, at, least[at]


def sampled(texts: list[bytes], ids: np.ndarray, p: Doubling) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ranks of the chunk's sampled suffixes, and which of them two documents have."""
    ranks, rows = [], []
    for parts, buf, offsets in _segments(texts, p):
        _, at, least = _least(buf, offsets, p)
        new = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        part = np.searchsorted(offsets, at[new], "right") - 1
        ranks.append(least[new])
        rows.append(np.array([r for r, _ in parts])[part])
        # a run that goes on in the next part is one of its own there
        cross = np.flatnonzero((least[1:] == least[:-1]) & np.isin(at[1:], offsets))
        if len(cross):
            part = np.searchsorted(offsets, at[cross + 1], "right") - 1
            ranks.append(least[cross + 1])
            rows.append(np.array([r for r, _ in parts])[part])
    if not ranks:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    rank, owner = np.concatenate(ranks), ids[np.concatenate(rows)]
    order = np.lexsort((owner, rank))
    rank, owner = rank[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
    last = np.append(first[1:], len(rank)) - 1
    return rank[first], owner[first] != owner[last]


def runs_of(texts: list[bytes], shared: np.ndarray, p: Doubling) -> tuple[Runs, np.ndarray]:
    """Runs whose sample is in ``shared`` (sorted), and the bytes around each sample.

    The bytes are ``reach - 1`` to the left and to the right of the sample,
    0 where no string of the run reaches.
    """
    side, found, context = p.reach - 1, [], []
    for parts, buf, offsets in _segments(texts, p):
        ranks, at, least = _least(buf, offsets, p)
        if not len(shared):
            continue
        hit = np.minimum(np.searchsorted(shared, least), len(shared) - 1)
        keep = shared[hit] == least
        at, least = at[keep], least[keep]
        if not len(at):
            continue
        sample = _samples(ranks, at, least, p)
        new = np.concatenate(([True], (sample[1:] != sample[:-1]) | (at[1:] != at[:-1] + 1)))
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(at)) - 1
        part = np.searchsorted(offsets, at[start], "right") - 1
        row, base = np.array(parts)[part].T
        shift = base - offsets[part]
        found.append((least[start], row, at[start] + shift, at[stop] + shift, sample[start] + shift))
        mid = sample[start][:, None]
        where = np.concatenate((mid + np.arange(-side, 0), mid + np.arange(p.seed, p.seed + side)), 1)
        seen = (where >= at[start][:, None]) & (where < at[stop][:, None] + p.length)
        context.append(np.where(seen, buf[np.clip(where, 0, len(buf) - 1)], 0).astype(np.uint8))
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none.astype(np.uint64), none, none, none, none), np.zeros((0, 2 * side), np.uint8)
    return Runs(*(np.concatenate(x) for x in zip(*found, strict=True))), np.concatenate(context)


def _samples(ranks: np.ndarray, at: np.ndarray, least: np.ndarray, p: Doubling) -> np.ndarray:
    """The first place of its least rank in each string (``at`` ascending)."""
    out = np.full(len(at), -1, np.int64)

    def seek(todo: np.ndarray) -> None:
        for o in range(p.reach):
            if not len(todo):
                return
            hit = ranks[at[todo] + o] == least[todo]
            out[todo[hit]] = at[todo[hit]] + o
            todo = todo[~hit]

    new = np.concatenate(([True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)))
    start = np.flatnonzero(new)
    seek(start)
    out = out[start][np.cumsum(new) - 1]      # neighbours share it up to its place
    seek(np.flatnonzero(out < at))            # a rank that comes again further on
    return out


def _contents(runs: Runs, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first run (least doc_id) of each distinct content, and each run's content."""
    padded = np.zeros((len(context), -(-context.shape[1] // 8) * 8), np.uint8)
    padded[:, :context.shape[1]] = context
    key = (padded.view(np.uint64) * _PLACE[:padded.shape[1] // 8]).sum(1, dtype=np.uint64)
    key = mix(key) + runs.rank
    key = mix(key + (runs.sample - runs.first).astype(np.uint64) * _PLACE[80]
              + (runs.sample - runs.last).astype(np.uint64) * _PLACE[81])
    order = np.lexsort((ids[runs.row], key))
    new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, bool)
    content = np.empty(len(order), np.int64)
    content[order] = np.cumsum(new) - 1
    return order[new], content


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    some, first = np.unique(bucket[order], return_index=True)
    yield from zip(some.tolist(), np.split(order, first[1:]), strict=True)


def _head(p: Doubling) -> np.dtype:
    return np.dtype([("rank", "<u8"), ("doc", "<i8"), ("lo", "u1"), ("hi", "u1")])


def repeats(rank: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, context: np.ndarray,
            p: Doubling) -> np.ndarray:
    """For every content, the bits of the places whose string starts in a smaller doc_id too.

    Place o: the string starts o bytes before the sample. One sort per place,
    of (rank, rank of the bytes around it, doc_id).
    """
    side = p.reach - 1
    sums = np.zeros((len(rank), 2 * side + 1), np.uint64)
    np.cumsum(_BYTE[context] * _PLACE[:2 * side], axis=1, dtype=np.uint64, out=sums[:, 1:])
    bits = np.zeros(len(rank), np.uint64)
    for o in range(p.reach):
        at = np.flatnonzero((lo <= o) & (o <= hi))
        key = mix(sums[at, 2 * side - o] - sums[at, side - o]) + rank[at]
        order = np.lexsort((doc[at], key))
        new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, bool)
        least = doc[at][order][new][np.cumsum(new) - 1] if len(order) else doc[at]
        later = doc[at][order] > least
        bits[at[order[later]]] |= np.uint64(1 << o)
    return bits


def remove_repeats(docs: DataFrame, p: Doubling = Doubling()) -> DataFrame:
    """doc_id, sizes, digest of the kept bytes and the removed spans (bytes) of every document."""
    if p.reach > 64 or p.seed < 1:
        raise ValueError("length - seed must be from 0 to 63")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // p.chunk_bytes))
    buckets = max(1, int(2 * total / p.reach) // p.bucket_items)
    texts = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def ids_of(table: pa.Table) -> np.ndarray:
        return np.array([NO_ID if v is None else v for v in table.column("doc_id").to_pylist()], np.int64)

    def chunk_texts(table: pa.Table) -> list[bytes]:
        return [t for c in table.column("text").chunks for t in utf8(c)]

    def first_ranks(table: pa.Table) -> pa.Table:
        rank, twice = sampled(chunk_texts(table), ids_of(table), p)
        out = list(_by_bucket((rank % np.uint64(buckets)).astype(np.int64)))
        raw = rank.view(np.uint8).reshape(-1, 8)
        return pa.table({
            "bucket": pa.array([b for b, _ in out], pa.int64()),
            "chunk": pa.array([table.column("chunk")[0].as_py()] * len(out), pa.int64()),
            "data": pa.array([np.packbits(twice[i]).tobytes() + raw[i, :6].tobytes() for _, i in out], pa.binary())})

    def first_shared(table: pa.Table) -> pa.Table:
        packed = [d.as_py() for d in table.column("data")]
        # n entries are 6 n bytes after ceil(n / 8) bytes of bits
        sizes = [8 * len(d) // 49 for d in packed]
        bits = [np.unpackbits(np.frombuffer(d, np.uint8, -(-n // 8)), count=n) for d, n in zip(packed, sizes, strict=True)]
        raw = np.zeros((sum(sizes), 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(d[-6 * n:] for d, n in zip(packed, sizes, strict=True)), np.uint8).reshape(-1, 6)
        _, back, count = np.unique(raw.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
        shared = (count[back] > 1) | (np.concatenate(bits) > 0)
        parts = np.split(shared, np.cumsum(sizes)[:-1])
        some = [i for i, x in enumerate(parts) if x.any()]
        return pa.table({"chunk": table.column("chunk").take(pa.array(some, pa.int64())),
                         "bucket": table.column("bucket").take(pa.array(some, pa.int64())),
                         "data": pa.array([np.packbits(parts[i]).tobytes() for i in some], pa.binary())})

    def shared_ranks(texts: list[bytes], ids: np.ndarray, marks: dict[int, bytes]) -> np.ndarray:
        rank, _ = sampled(texts, ids, p)
        keep = np.zeros(len(rank), bool)
        for b, i in _by_bucket((rank % np.uint64(buckets)).astype(np.int64)):
            if b in marks:
                keep[i] = np.unpackbits(np.frombuffer(marks[b], np.uint8), count=len(i)).astype(bool)
        return rank[keep]

    def second_ranks(table: pa.Table, marked: pa.Table) -> pa.Table:
        out = [(-1 - c, c, b"%d:" % b + d) for c, b, d in zip(*(marked.column(k).to_pylist() for k in (
            "chunk", "bucket", "data")), strict=True)]
        if table.num_rows and out:
            marks = dict(zip(marked.column("bucket").to_pylist(), marked.column("data").to_pylist(), strict=True))
            texts, ids = chunk_texts(table), ids_of(table)
            runs, context = runs_of(texts, shared_ranks(texts, ids, marks), p)
            firsts, _ = _contents(runs, context, ids)
            head = np.empty(len(firsts), _head(p))
            head["rank"], head["doc"] = runs.rank[firsts], ids[runs.row[firsts]]
            head["lo"] = (runs.sample - runs.last)[firsts]
            head["hi"] = (runs.sample - runs.first)[firsts]
            for b, i in _by_bucket((head["rank"] % np.uint64(buckets)).astype(np.int64)):
                out.append((b, out[0][1], zlib.compress(head[i].tobytes() + context[firsts[i]].tobytes(), 1)))
        return pa.table({name: pa.array(x, t) for name, x, t in zip(
            ("bucket", "chunk", "data"), zip(*out, strict=True) if out else ([],) * 3,
            (pa.int64(), pa.int64(), pa.binary()), strict=True)})

    def second_shared(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:  # the first round's marks, on their way to the last pass
            return table.select(["chunk", "bucket", "data"])
        packed = [zlib.decompress(d.as_py()) for d in table.column("data")]
        kind, wide = _head(p), 2 * (p.reach - 1)
        sizes = [len(d) // (kind.itemsize + wide) for d in packed]
        head = np.concatenate([np.frombuffer(d, kind, n) for d, n in zip(packed, sizes, strict=True)])
        context = np.concatenate([np.frombuffer(d, np.uint8, offset=n * kind.itemsize).reshape(n, wide)
                                  for d, n in zip(packed, sizes, strict=True)])
        bits = repeats(head["rank"], head["doc"], head["lo"], head["hi"], context, p)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "data": pa.array([zlib.compress(x.tobytes(), 1) for x in np.split(bits, np.cumsum(sizes)[:-1])],
                                          pa.binary())})

    def cut(table: pa.Table, marked: pa.Table) -> pa.Table:
        texts, ids = chunk_texts(table), ids_of(table)
        gone = _removed(texts, ids, marked)
        out = []
        for i, text in enumerate(texts):
            spans = gone.get(i, [])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            out.append((table.column("doc_id")[i].as_py(), len(text), sum(b - a for a, b in spans), len(spans),
                        kept.hexdigest(), [a for a, _ in spans], [b for _, b in spans]))
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.table({n: pa.array(x, t) for n, x, t in zip(
            names, zip(*out, strict=True) if out else ([],) * 7, kinds, strict=True)})

    def _removed(texts: list[bytes], ids: np.ndarray, marked: pa.Table) -> dict[int, list[tuple[int, int]]]:
        marks, bits_of = {}, {}
        for b, d in zip(marked.column("bucket").to_pylist(), marked.column("data").to_pylist(), strict=True):
            if b < 0:
                name, _, mark = d.partition(b":")
                marks[int(name)] = mark
            else:
                bits_of[b] = np.frombuffer(zlib.decompress(d), np.uint64)
        if not marks:
            return {}
        runs, context = runs_of(texts, shared_ranks(texts, ids, marks), p)
        firsts, content = _contents(runs, context, ids)
        bits = np.zeros(len(firsts), np.uint64)
        for b, i in _by_bucket((runs.rank[firsts] % np.uint64(buckets)).astype(np.int64)):
            bits[i] = bits_of[b]
        own = ids[runs.row]
        bits = np.where(own > own[firsts][content], ~np.uint64(0), bits[content])
        some = np.flatnonzero(bits)
        # the strings of each run that go, then the bytes they cover
        n = (runs.last - runs.first + 1)[some]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(runs.first[some], n) + nth
        place = (np.repeat(runs.sample[some], n) - start).astype(np.uint64)
        hit = (np.repeat(bits[some], n) >> place) & np.uint64(1) > 0
        row, start = np.repeat(runs.row[some], n)[hit], start[hit]
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        if not len(row):
            return {}
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] > start[:-1] + p.length)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        out: dict[int, list[tuple[int, int]]] = {}
        for r, a, b in zip(row[first].tolist(), start[first].tolist(), (start[last] + p.length).tolist(), strict=True):
            out.setdefault(r, []).append((a, b))
        return out

    packed = "bucket long, chunk long, data binary"
    answered = "chunk long, bucket long, data binary"
    marks = (texts.groupBy("chunk").applyInArrow(first_ranks, packed)
             .groupBy("bucket").applyInArrow(first_shared, answered))
    found = (texts.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(second_ranks, packed)
             .groupBy("bucket").applyInArrow(second_shared, answered))
    return texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(cut, SCHEMA)
