"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document is the set of its distinct k-word shingles. Two sets of sizes n
and m with similarity at least t share a token among the first
n - ceil(t n) + 1 tokens of each, under any fixed order of all tokens. All
orders used here put frequent tokens last (frequency classes from one
count sketch of fixed size) and differ in how they order the rest. The first order
makes candidates through an inverted index; the prefixes under the other
orders, kept as 32-bit hashes per class, are intersected for every candidate, and only
pairs that share a token under each order have their full sets fetched and verified.

Before that, a class goes no further if more than n - ceil(t n) of its tokens
are in no other class: no set can then be similar enough. That is counted
exactly over a hash sample of all tokens (a sample can only count too few), so
documents that merely share passages never meet in the index.

Equal sets are one class from the start. A token that few classes share makes
all its pairs; for one that many share, the classes are first linked to a
pivot (the class most central in its groups) and verified, and only pairs of
classes that are then still in different components are made, in blocks, so
large groups of near copies never become all pairs of rows, and no link between
components is lost. All links lie within components, so the links of a
document are counted there at the end: the classes of a component meet in
blocks, and a task returns one count per class. A parity bitmap of each set bounds the symmetric
difference of a pair from below; a pair beyond the bound cannot link and is
dropped before any set is looked at.

Defined cases: null and empty texts have no shingle and link with nothing;
fewer than k words are one shingle; repeated rows link (equal sets), and every
row has its own in the result, whatever its doc_id; a component without any
doc_id has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import (WORD, batches_of_bytes, joined, mix, row_keys, settle, small_batches, text_column,
                                  utf8, width, window_hashes, words)
from tidemark.llm.components import components
from tidemark.session import materialize


@dataclass(frozen=True)
class Join:
    k: int = 4
    percent: int = 85            # links: 100 * intersection >= percent * union
    orders: int = 3              # token orders whose prefix filters must all hold
    heavy: int = 64              # classes from which a token's group is linked by pivots first
    block: int = 1024            # classes of a heavy group compared in one go
    pivot_rounds: int = 2
    sample: int = 4              # one token in so many counts as lone or not
    buckets: int | None = None   # of the inverted index; twice the session's shuffle partitions by default


SKETCH_BITS = 21                 # cells of the count sketch, whatever the corpus
SLICE_BITS = 15                  # cells in one row of the sketch's shuffle
FILTER_BITS = 24                 # bits of the candidate filter: 2 MB, whatever the corpus
SETS = 4000                      # full sets, or class rows with bitmaps, that a task holds at once
PARITY_BITS = 2048               # bits of a set's parity bitmap
_ORDER = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                                 0x85EBCA77C2B2AE63)]


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    buf, offsets = joined(texts)
    starts, _, h = words(buf, lower=True)
    ends = np.searchsorted(starts, offsets[1:])
    begin = np.concatenate(([0], ends[:-1]))
    roll = window_hashes(h, k)
    out = []
    for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(roll[a:b - k + 1]))
        elif b > a:  # the whole sequence; its length keeps it apart from longer shingles
            v = np.array([b - a], np.uint64)
            for x in h[a:b]:
                v = mix(v * np.uint64(3) ^ x)
            out.append(v)
        else:
            out.append(h[:0])
    return out


def set_digest(tokens: np.ndarray) -> int:
    """Signed 64-bit digest of a set; equal sets are taken to be one class."""
    total = np.add.reduce(mix(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A))) + np.uint64(len(tokens))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets_of(batch: pa.RecordBatch, text_at: int, k: int) -> Iterator[tuple[int, np.ndarray]]:
    rows = zip(utf8(batch.column(text_at)), range(batch.num_rows), strict=True)
    for group in batches_of_bytes(rows):
        yield from zip((i for _, i in group), shingle_sets([t for t, _ in group], k), strict=True)


def parity(tokens: np.ndarray) -> bytes:
    """Bitmap whose bits are the parities of the tokens' counts per cell."""
    cells = np.bincount((tokens & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """False where parities (rows of words) or sizes prove a pair below the similarity.

    A set bit of x ^ y takes a token of the symmetric difference of its own,
    and similarity t bounds that difference by (1 - t) / (1 + t) * (n + m).
    """
    apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return (((100 + percent) * apart <= (100 - percent) * (n + m))
            & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))


def _text_key() -> Column:
    """Hash that stands for a whole text; its low bits are the candidate filter's slot."""
    return F.xxhash64(text_column())


def _profile(docs: DataFrame, k: int, keys: list[Column]) -> DataFrame:
    """One pass: (doc_id, class, n, parity, text, key, key2) of every row, and sketch slices per task."""
    names = ["doc_id", "class", "n", "parity", "text", "key", "key2", "slice", "counts"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.uint64)
        for batch in batches:
            rows = [(0, 0, None)] * batch.num_rows
            every = []
            for i, tokens in _sets_of(batch, 1, k):
                if len(tokens):
                    rows[i] = set_digest(tokens), len(tokens), parity(tokens)
                    every.append(tokens >> np.uint64(64 - SKETCH_BITS))
            if every:
                cell, count = np.unique(np.concatenate(every), return_counts=True)
                cells[cell.astype(np.int64)] += count.astype(np.uint64)
            digests, sizes, bits = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, types[1]), pa.array(sizes, types[2]), pa.array(bits, types[3]),
                 *(batch.column(c) for c in (2, 3, 4)), *(pa.nulls(batch.num_rows, t) for t in types[7:])], names=names)
        parts = cells.reshape(-1, 1 << SLICE_BITS)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(some), t) for t in types[:7]] + [
                pa.array(some, types[7]), pa.array([zlib.compress(parts[s].tobytes(), 1) for s in some], types[8])],
            names=names)

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text"), _text_key().alias("text_key"),
                       keys[0].alias("key"), keys[1].alias("key2")).mapInArrow(
        run, "doc_id long, class long, n long, parity binary, text long, key long, key2 long, slice int, counts binary")


def _sketch(profile: DataFrame) -> np.ndarray:
    """Counts per cell over all tasks, as frequency classes (uint8): at most 2**SKETCH_BITS bytes."""
    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << SLICE_BITS, np.uint64)
        for blob in table.column("counts"):
            total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint64)
        return pa.table({"slice": table.column("slice")[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    # two levels, so that no task reads a slice of every task of a large scan
    part = profile.where("slice is not null").select(
        "slice", "counts", F.pmod(F.xxhash64("counts"), F.lit(width(profile.sparkSession))).alias("salt"))
    once = part.groupBy("slice", "salt").applyInArrow(add, "slice int, counts binary")
    cells = np.zeros((1 << SKETCH_BITS - SLICE_BITS, 1 << SLICE_BITS), np.uint64)
    for row in once.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        cells[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
    cells = cells.ravel()
    usual = 4 * cells.mean() + 16
    return np.maximum(0, np.floor(np.log2(np.maximum(cells, 1) / usual)) + 1).astype(np.uint8)


def _prefix(tokens: np.ndarray, frequency: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under one global order: by frequency class, then by a hash."""
    p = prefix_length(len(tokens), percent)
    cls = frequency[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    key = (cls << np.uint64(56)) | (mix(tokens * _ORDER[order]) >> np.uint64(8))
    return tokens if p >= len(tokens) else tokens[np.argpartition(key, p - 1)[:p]]


def _by_bucket(rows: np.ndarray, bucket: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Packed rows of every bucket."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    some, first = np.unique(bucket, return_index=True)
    edge = np.append(first, len(rows))
    return (pa.array(some, pa.int32()),
            pa.array([rows[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()))


_RUN = np.dtype([("class", "<i8"), ("n", "<u4")])


def _lone_tokens(docs: DataFrame, join: Join, buckets: int) -> DataFrame:
    """(class, lone): how many of a class's sampled tokens no other class has.

    Per task batch and bucket, tokens travel as six bytes behind (class, number of
    tokens); counts travel packed too, so nothing here is a row per token.
    """
    low6 = np.uint64((1 << 48) - 1)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            for _, tokens in _sets_of(batch, 0, join.k):
                if len(tokens):
                    known[set_digest(tokens)] = tokens[(tokens >> np.uint64(48)) % np.uint64(join.sample) == 0]
            known = {c: t for c, t in known.items() if len(t)}
            if not known:
                continue
            every = np.concatenate(list(known.values()))
            owner = np.repeat(np.array(list(known), np.int64), [len(t) for t in known.values()])
            bucket = (every % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((owner, bucket))
            every, owner, bucket = every[order] & low6, owner[order], bucket[order]
            some, first = np.unique(bucket, return_index=True)
            data = []
            for a, b in zip(first.tolist(), np.append(first[1:], len(every)).tolist(), strict=True):
                cls, n = np.unique(owner[a:b], return_counts=True)
                head = np.empty(len(cls), _RUN)
                head["class"], head["n"] = cls, n
                raw = np.ascontiguousarray(every[a:b]).view(np.uint8).reshape(-1, 8)[:, :6]
                data.append(np.uint32(len(cls)).tobytes() + head.tobytes() + raw.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(data, pa.binary())],
                                             names=["bucket", "data"])

    def count(table: pa.Table) -> pa.Table:
        tokens, owners = [], []
        for d in (x.as_py() for x in table.column("data")):
            k = int(np.frombuffer(d, np.uint32, 1)[0])
            head = np.frombuffer(d, _RUN, k, 4)
            raw = np.frombuffer(d, np.uint8, offset=4 + k * _RUN.itemsize).reshape(-1, 6)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :6] = raw
            tokens.append(wide.view(np.uint64).ravel())
            owners.append(np.repeat(head["class"], head["n"]))
        pair = np.unique(np.rec.fromarrays((np.concatenate(tokens), np.concatenate(owners)), names="token,owner"))
        _, first, n = np.unique(pair["token"], return_index=True, return_counts=True)
        cls, lone = np.unique(pair["owner"][first[n == 1]], return_counts=True)
        rows = np.empty(len(cls), _RUN)
        rows["class"], rows["n"] = cls, lone
        part, data = _by_bucket(rows, (cls.view(np.uint64) % np.uint64(buckets)).astype(np.int64))
        return pa.table({"part": part, "data": data})

    def total(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("data").to_pylist()), _RUN)
        cls, back = np.unique(rows["class"], return_inverse=True)
        return pa.table({"class": cls, "lone": np.bincount(back, rows["n"]).astype(np.int64)})

    return (docs.select(text_column().alias("text")).mapInArrow(sample, "bucket int, data binary")
            .groupBy("bucket").applyInArrow(count, "part int, data binary")
            .groupBy("part").applyInArrow(total, "class long, lone long"))


def _bit_filter(slots: DataFrame) -> np.ndarray:
    """Bitmap of ``FILTER_BITS`` bits (as words) of the column ``slot``."""
    filled = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in (slots.groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))).collect():
        filled[row["word"]] = row["bits"]
    return filled


def _passes(filled: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return ((filled[slot >> 6] >> (slot & 63)) & 1).astype(bool)


_POSTING = np.dtype([("token", "<u8"), ("class", "<i8"), ("n", "<u4")])


def _index(docs: DataFrame, linkable: DataFrame, frequency: np.ndarray, join: Join, buckets: int) -> DataFrame:
    """Of the ``linkable`` classes (and a few that pass their bit filter by chance): the first order's
    postings, packed, a row per task batch and bucket; and a row (class, heads) with the prefixes
    under the other orders as 32-bit hashes."""
    mask = (1 << FILTER_BITS) - 1
    filled = _bit_filter(linkable.select(F.col("class").bitwiseAND(F.lit(mask)).alias("slot")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, parts, heads = {}, [], []
            for _, tokens in _sets_of(batch, 0, join.k):
                if (len(tokens) and (digest := set_digest(tokens)) not in seen
                        and _passes(filled, np.array([digest & mask]))[0]):
                    seen[digest] = len(seen)
                    heads.append(b"".join(
                        np.sort(_prefix(tokens, frequency, o, join.percent).astype(np.uint32)).tobytes()
                        for o in range(1, join.orders)))
                    head = _prefix(tokens, frequency, 0, join.percent)
                    part = np.empty(len(head), _POSTING)
                    part["token"], part["class"], part["n"] = head, digest, len(tokens)
                    parts.append(part)
            if parts:
                every = np.concatenate(parts)
                bucket, packed = _by_bucket(every, (every["token"] % np.uint64(buckets)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([bucket, pa.nulls(len(heads), pa.int32())]),
                     pa.concat_arrays([packed, pa.nulls(len(heads), pa.binary())]),
                     pa.concat_arrays([pa.nulls(len(bucket), pa.int64()), pa.array(list(seen), pa.int64())]),
                     pa.concat_arrays([pa.nulls(len(bucket), pa.binary()), pa.array(heads, pa.binary())])],
                    names=["bucket", "postings", "class", "heads"])

    return docs.select(text_column().alias("text")).mapInArrow(
        run, "bucket int, postings binary, class long, heads binary")


def _near(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _shared(postings: DataFrame, join: Join) -> DataFrame:
    """From the index: pairs (a, b) of classes that share a light token, and rows
    (token, a) of the heavy ones, whose b is null."""
    def run(table: pa.Table) -> pa.Table:
        rows = np.unique(np.frombuffer(b"".join(table.column("postings").to_pylist()), _POSTING))
        _, first, count = np.unique(rows["token"], return_index=True, return_counts=True)
        pairs = []
        for size in np.unique(count[(count > 1) & (count <= join.heavy)]).tolist():
            at = first[count == size]
            i, j = np.triu_indices(size, 1)
            step = max(1, (1 << 18) // len(i))
            for k in range(0, len(at), step):
                one = rows[(at[k:k + step, None] + i).ravel()]
                two = rows[(at[k:k + step, None] + j).ravel()]
                ok = _near(one["n"].astype(np.int64), two["n"].astype(np.int64), join.percent)
                found = np.stack((one["class"][ok], two["class"][ok]), 1)
                found.sort(axis=1)
                pairs.append(np.unique(found, axis=0))
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        heavy = rows[np.repeat(count > join.heavy, count)]
        none = pa.nulls(len(pairs), pa.int64())
        return pa.table({
            "token": pa.concat_arrays([none, pa.array(heavy["token"].view(np.int64))]),
            "a": np.concatenate((pairs[:, 0], heavy["class"])),
            "b": pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(heavy), pa.int64())])})

    return postings.groupBy("bucket").applyInArrow(run, "token long, a long, b long")


def _candidate_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(class, tokens) of the given classes.

    ``classes``: class, text (the key of one of its texts). A bit filter of fixed size drops
    nearly all other documents before any set is built or shuffled, a task builds equal
    texts' set once, and the join then keeps exactly the wanted ones.
    """
    mask = (1 << FILTER_BITS) - 1
    filled = _bit_filter(classes.select(F.col("text").bitwiseAND(F.lit(mask)).alias("slot")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            fresh = []
            for i in np.flatnonzero(_passes(filled, keys & mask)).tolist():
                if keys[i] not in done:
                    done.add(keys[i])
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            rows = [(i, tokens) for i, tokens in _sets_of(batch, 1, k) if len(tokens)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([i for i, _ in rows], pa.int64())),
                 pa.array([t.tobytes() for _, t in rows], pa.binary())], names=["text", "tokens"])

    sets = docs.select(_text_key().alias("key"), text_column().alias("text")).mapInArrow(run, "text long, tokens binary")
    wanted = classes.select("class", F.col("text").alias("_text"))
    return (sets.join(wanted, F.col("text") == F.col("_text"))
            .groupBy("class").agg(F.first("tokens").alias("tokens")))  # one of equal values


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and parity bitmaps do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                        for c in (2, 4))
                ok = may_link(x, y, batch.column(3).to_numpy(), batch.column(5).to_numpy(), percent)
                yield batch.select([0, 1]).filter(pa.array(ok))

    one, two = (classes.select(F.col("class").alias(c), F.col("parity").alias(f"p{c}"), F.col("n").alias(f"n{c}"))
                for c in "ab")
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "pa", "na", "pb", "nb")
            .mapInArrow(run, "a long, b long"))


def _meet_in_all_orders(pairs: DataFrame, heads: DataFrame, join: Join) -> DataFrame:
    """The pairs that share a prefix token (by its 32-bit hash) under every further order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = (np.frombuffer(raw, np.uint32).reshape(join.orders - 1, -1) for raw in (x, y))
                keep.append(all(np.isin(p, q).any() for p, q in zip(x, y, strict=True)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one, two = (heads.select(F.col("class").alias(c), F.col("heads").alias(f"h{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, heads: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that pass every order's prefix filter and the exact similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= join.percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    if join.orders > 1:
        pairs = settle(_meet_in_all_orders(pairs.select("a", "b"), heads, join))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = settle(_candidate_sets(docs, ends.join(classes.select("class", "text"), "class"), join.k), SETS)
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("b_tokens"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "a_tokens", "b_tokens")
            .mapInArrow(run, "a long, b long"))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    one, two = (label.select(F.col("node").alias(f"_{c}"), F.col("component").alias(f"_c{c}")) for c in "ab")
    return (pairs.join(one, F.col("a") == F.col("_a"), "left").join(two, F.col("b") == F.col("_b"), "left")
            .where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b"))


def _open(heavy: DataFrame, label: DataFrame) -> DataFrame:
    """Heavy rows with their components, of the tokens whose classes are in two components or more."""
    group = heavy.join(label, F.col("class") == F.col("node"), "left").select(
        "token", "class", F.coalesce("component", "class").alias("component"))
    tokens = (group.groupBy(F.col("token").alias("_token"))
              .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
              .where("lo <> hi").select("_token"))
    return group.join(tokens, F.col("token") == F.col("_token"), "left_semi")


def _pivot_pairs(group: DataFrame) -> DataFrame:
    """Each class with its best pivot: a token's pivot is the class that shares most with others."""
    sizes = group.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("size"))
    central = (group.join(sizes, F.col("token") == F.col("_token")).groupBy(F.col("class").alias("_class"))
               .agg(F.sum("size").alias("weight")))
    weighed = group.join(central, F.col("class") == F.col("_class"))
    pivots = weighed.groupBy(F.col("token").alias("_token")).agg(
        F.max(F.struct("weight", "class", "component")).alias("pivot"))
    return (group.join(pivots, F.col("token") == F.col("_token"))
            .where(F.col("component") != F.col("pivot.component"))
            .groupBy(F.col("class").alias("b"), F.col("pivot.class").alias("a")).agg(F.count(F.lit(1)).alias("hits"))
            .groupBy("b").agg(F.max(F.struct("hits", "a")).alias("best")).select(F.col("best.a").alias("a"), "b"))


def _block_pairs(group: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Pairs across components within each open heavy token that parities do not rule out.

    A group is cut into blocks by hash; every two blocks meet in a task of
    their own, so a row travels as often as its token has blocks.
    """
    sizes = group.groupBy(F.col("token").alias("_token")).agg(
        F.ceil(F.count(F.lit(1)) / join.block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class", "token"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(
        F.least(i, F.col("own")).alias("lo"), F.greatest(i, F.col("own")).alias("hi")))
    info = classes.select(F.col("class").alias("_class"), "n", "parity")
    rows = (group.join(sizes, F.col("token") == F.col("_token")).withColumn("own", own)
            .join(info, F.col("class") == F.col("_class"))
            .select("token", "class", "component", "n", "parity", "own", F.explode(meets).alias("meet"))
            .select("token", "meet.lo", "meet.hi", "own", "class", "component", "n", "parity"))

    def run(table: pa.Table) -> pa.Table:
        own, cls, comp, n = (table.column(c).to_numpy() for c in ("own", "class", "component", "n"))
        bits = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(len(cls), -1)
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        out = [np.zeros((0, 2), np.int64)]
        for i in left.tolist():
            j = right[right > i] if lo == hi else right
            j = j[(comp[j] != comp[i]) & _near(n[j], n[i], join.percent)]
            j = j[may_link(bits[j], bits[i], n[j], n[i], join.percent)]
            out.append(np.stack((np.minimum(cls[j], cls[i]), np.maximum(cls[j], cls[i])), 1))
        found = np.concatenate(out)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    # every two blocks in a task of their own, few as the rows may be
    rows = rows.repartition(width(group.sparkSession), "token", "lo", "hi")
    return rows.groupBy("token", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def _degrees(links: DataFrame, label: DataFrame, classes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """(class, n_links): the links of every linked class to other classes, all of them.

    Where the verified links are already all pairs of a component, they are
    counted; in any other, every two classes are compared. Such a component is cut into
    blocks by hash, every two blocks meet in a task of their own, and only sums per class leave it.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(
        F.count(F.lit(1)).alias("n_links"))
    found = settle(label.join(ends, F.col("node") == F.col("class")).select("class", "component", "n_links"))
    sizes = (found.groupBy(F.col("component").alias("_component"))
             .agg(F.count(F.lit(1)).alias("size"), F.sum("n_links").alias("seen"))
             .withColumn("part", F.col("seen") < F.col("size") * (F.col("size") - 1)))
    found = settle(found.join(sizes, F.col("component") == F.col("_component"))
                   .select("class", "component", "n_links", "size", "part"))
    known = found.where("not part").select("class", "n_links")
    part = found.where("part").select(F.col("class").alias("_class"), "component", F.ceil(
        F.col("size") / F.greatest(F.lit(join.block), F.sqrt(8 * F.col("size")))).cast("int").alias("blocks"))
    if part.isEmpty():
        return known
    sets = _candidate_sets(docs, part.join(classes, F.col("_class") == F.col("class")).select("class", "text"), join.k)
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(
        F.least(i, F.col("own")).alias("lo"), F.greatest(i, F.col("own")).alias("hi")))
    rows = (sets.join(part, F.col("class") == F.col("_class"))
            .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .select("component", "class", "tokens", "own", F.explode(meets).alias("meet"))
            .select("component", "meet.lo", "meet.hi", "own", "class", "tokens"))

    def run(table: pa.Table) -> pa.Table:
        own, cls = table.column("own").to_numpy(), table.column("class").to_numpy()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        order = np.argsort(own, kind="stable")  # the rows of lo, then those of hi
        raw = table.column("tokens").to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in order.tolist()]
        n = np.array([len(x) for x in sets])
        start = np.cumsum(n) - n
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        here = np.zeros(flat.max() + 1, np.int32)
        first = int((own == lo).sum())
        count = np.zeros(len(sets), np.int64)
        for i in range(first):
            begin = i + 1 if lo == hi else first  # each pair once
            if begin == len(sets):
                break
            tokens = flat[start[i]:start[i] + n[i]]
            here[tokens] = 1
            both = np.add.reduceat(here[flat[start[begin]:]], start[begin:] - start[begin])
            here[tokens] = 0
            linked = 100 * both.astype(np.int64) >= join.percent * (n[i] + n[begin:] - both)
            count[begin:] += linked
            count[i] += linked.sum()
        return pa.table({"class": cls[order], "n_links": count})

    rows = rows.repartition(width(docs.sparkSession), "component", "lo", "hi")
    counted = (rows.groupBy("component", "lo", "hi").applyInArrow(run, "class long, n_links long")
               .groupBy("class").agg(F.sum("n_links").alias("n_links")))
    return known.unionByName(counted)


def _linked(docs: DataFrame, join: Join,
            keys: list[Column] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, class, n, key, key2, group) of every row, verified links that connect every component,
    component of every linked class, and the classes that may link.

    ``group`` is the row's component, null without shingles; ``keys`` are two columns of ``docs`` to carry along.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    profile = materialize(_profile(docs, join.k, keys or [F.lit(0).cast("long")] * 2))
    table = profile.where("slice is null").select("doc_id", "class", "n", "parity", "text", "key", "key2")
    frequency = _sketch(profile)
    buckets = join.buckets or 2 * width(spark)
    lone = _lone_tokens(docs, join, max(1, buckets // 2)).select(F.col("class").alias("_class"), "lone")
    classes = settle(
        table.where("n > 0").groupBy("class").agg(F.min("text").alias("text"), F.first("n").alias("n"),
                                                  F.first("parity").alias("parity"))
        .join(lone, F.col("class") == F.col("_class"), "left")
        .where(F.coalesce("lone", F.lit(0)) <= F.col("n") - F.ceil(F.col("n") * join.percent / 100)).drop("_class", "lone"),
        16 * SETS)
    index = materialize(_index(docs, classes, frequency, join, buckets))
    heads = settle(index.where("bucket is null").groupBy("class").agg(F.first("heads").alias("heads")), 16 * SETS)
    shared = materialize(_shared(index.where("bucket is not null").select("bucket", "postings"), join))
    heavy = settle(shared.where("b is null").select("token", F.col("a").alias("class")))
    tried = settle(_possible(settle(shared.where("b is not null").select("a", "b").distinct()), classes, join.percent))
    # one partner of every class first; of the other pairs, those between components
    both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    some = settle(both).groupBy("a").agg(F.min("b").alias("b"))
    some = settle(some.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = settle(_links(some, docs, classes, heads, join))
    label = components(links)
    rest = settle(_apart(tried.join(some, ["a", "b"], "left_anti"), label))
    if not rest.isEmpty():
        links = settle(links.unionByName(_links(rest, docs, classes, heads, join)))
        label = components(links)
    for round_no in range(join.pivot_rounds + 1):
        group = settle(_open(heavy, label))
        if group.isEmpty():
            break
        pairs = (_possible(_pivot_pairs(group), classes, join.percent) if round_no < join.pivot_rounds
                 else _block_pairs(group, classes, join))
        pairs = settle(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
        pairs = settle(pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        tried = settle(tried.unionByName(pairs))
        links = settle(links.unionByName(_links(pairs, docs, classes, heads, join)))
        label = components(links)

    rows = table.join(label, F.col("class") == F.col("node"), "left").select(
        "doc_id", "class", "n", "key", "key2", F.when(F.col("n") > 0, F.coalesce("component", "class")).alias("group"))
    return rows, links, label, classes


def jaccard_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row.

    ``n_links`` counts the links of the document's set to other sets (classes),
    however many documents have one of these; equal sets add none.
    """
    rows, links, label, classes = _linked(docs, join)
    least = (rows.where("n > 0 and doc_id is not null").groupBy(F.col("group").alias("_group"))
             .agg(F.min("doc_id").alias("component_id")))
    ends = _degrees(links, label, classes, docs, join).select(F.col("class").alias("_end"), "n_links")
    return (rows.join(least, F.col("group") == F.col("_group"), "left")
            .join(ends, F.col("class") == F.col("_end"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def one_per_component(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row of every component, all of its columns, and all rows without shingles.

    The row with the least doc_id stays (nulls last), then the one with the least set digest, then
    the least hash of the row; of rows equal in all columns one stays.
    """
    keys = row_keys(docs)
    rows = _linked(docs, join, keys)[0]
    stay = (rows.where("n > 0").groupBy("group")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "class", "key", "key2")).alias("least"))
            .select(F.col("least.key").alias("_stay"), F.col("least.key2").alias("_stay2")))
    has_words = text_column().rlike(WORD)
    # equal rows meet before the shuffle, and the join keeps its layout: texts travel once
    row = (docs.where(has_words).select(keys[0].alias("_key"), keys[1].alias("_key2"), F.struct(*docs.columns).alias("_row"))
           .groupBy("_key", "_key2").agg(F.first("_row").alias("_row")))
    stays = (F.col("_key") == F.col("_stay")) & (F.col("_key2") == F.col("_stay2"))
    return row.join(stay, stays, "left_semi").select("_row.*").unionByName(docs.where(~has_words))
