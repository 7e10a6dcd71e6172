"""Alignment of two tokenizers' tokens by byte offsets.

A byte-level BPE (A) and a piece model (B) cut the same bytes differently.
Byte offsets where tokens of both end cut a text into groups; the tokens of a
group are linked with each other. Texts are cut into stretches that begin at a space after a character that is
no white space: no token of A or B has such a place inside and merges never cross one, so a stretch has the ids
that it has in the text, and its end ends a group. The distinct stretches of a batch are encoded once
and merged in lockstep: one
state vector holds an A and a B pointer per lane, and a step moves every pointer
whose token ends first, emits the overlapping pair, and a cut where both end; finished lanes are
taken out. A stretch is a lane; a long one is several, begun at ends that both tokenizers share, so the
number of steps does not follow the longest stretch. Documents are put together from their stretches.

How often a pair of ids is linked is counted over the corpus (documents that hold it):
parts of some ``part_bytes`` of text report their distinct pairs to buckets by A id, buckets
add them up and answer each part, and every document adds up the counts of its links. Texts are
tokenized once; what travels is a compressed list of pairs per document.

A worker looks up B's ids of the stretches it has met. A's ranks give the ids of its JSON file (both are
checked by tests).

Defined cases: texts null, empty, or whose joined token bytes differ from space + text (those with
U+2581) have no tokens: all numbers are 0, the digest is ''. Repeated documents each get a row and count
as documents of their own; a null doc_id stays null; very long texts are held whole, some 100 bytes
per byte of text; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import batches_of_bytes, small_batches, text_column, utf8, width


@dataclass(frozen=True)
class Pairing:
    ranks: str = "byte_bpe_50k.tiktoken"   # A: the vocabulary of byte_bpe_50k.json as ranks (a name or a path)
    pieces: str = "piece_bpe_32k.model"    # B, likewise
    lane: int = 512                        # A tokens of a lane, about
    part_bytes: int = 16 << 20             # text of a part
    bucket_bytes: int = 64 << 20           # text per bucket of pairs
    merge: int = 64                        # parts whose pairs are added up in one go
    copies: int = 64                       # equal rows of a task that stay in one part
    stretches: int = 400_000               # of B that a worker remembers


# ------------------------------------------------------------------ stretches

#: UTF-8 of white space beyond ASCII, as numbers of two and of three bytes.
_WIDE_SPACE = [np.array([int.from_bytes(x) for x in (chr(c).encode() for c in range(0x80, 0x10000)
                                                    if chr(c).isspace()) if len(x) == n], np.int64) for n in (2, 3)]


def _solid(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends with byte ``at`` is neither white space nor an ASCII control character."""
    last = buf[at]
    out = last > 0x20
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        x = sum(buf[np.maximum(at[wide] - k, 0)].astype(np.int64) << (8 * k) for k in range(3))
        out[wide] = ~(np.isin(x & 0xFFFF, _WIDE_SPACE[0]) | np.isin(x, _WIDE_SPACE[1]))
    return out


def _cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, int]:
    """Stretches of every text with a space in front: their numbers among the distinct ones, where each
    text's begin (one more than texts), the distinct ones and their bytes, and how many of them end in a
    character that is no white space; those come first."""
    raw = [f" {x}".encode() for x in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    docs = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    at = np.flatnonzero(buf == 0x20)[1:]
    starts = np.zeros(len(buf), bool)
    starts[at[_solid(buf, at - 1)]] = starts[docs[:-1]] = True
    begin = np.flatnonzero(starts)
    bounds = np.append(begin, len(buf)).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin),
                                             [None, pa.py_buffer(bounds), pa.py_buffer(buf)]).dictionary_encode()
    code, stretches = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_string())
    closed = np.zeros(len(stretches), bool)
    closed[code] = _solid(buf, bounds[1:] - 1)
    order = np.argsort(~closed, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = np.zeros(len(order), np.int64)
    size[place[code]] = np.diff(bounds)
    names = stretches.take(pa.array(order)).to_numpy(zero_copy_only=False).tolist()
    return place[code], np.searchsorted(begin, docs), names, size, int(closed.sum())


def _runs(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices begin, begin + 1, ... (``n`` of them) of every run, one run after the other."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


# ------------------------------------------------------------------ tokenizers

REMEMBERED = 64  # characters of a stretch that a worker remembers at most


@dataclass(frozen=True)
class Encoded:
    """Ids of stretches laid end to end, and how many each has."""
    a: np.ndarray
    n_a: np.ndarray
    b: np.ndarray
    n_b: np.ndarray
    good: np.ndarray


def _path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


class Tokenizers:
    """Ids and byte lengths of both tokenizers; a worker keeps one object per setting."""

    def __init__(self, pairing: Pairing):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(_path(pairing.ranks), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=_path(pairing.pieces))
        self.a_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id("▁")
        self.known: dict[str, list[int]] = {}
        self.limit = pairing.stretches
        a, b = len(self.a_bytes), len(self.b_bytes)
        self.names = pa.array([f"{mark}{i}" for mark in ",;" for i in range(a)]
                              + [f"{mark}{i}" for mark in "|," for i in range(b)], pa.large_string())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _ids_a(self, stretches: list[str], size: np.ndarray, closed: int) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of ``stretches``, one after the other, and how many each has.

        The first ``closed`` are encoded in one go; the others end in white space, whose tokens depend on what follows.
        """
        joined = np.array(self.a.encode_ordinary("".join(stretches[:closed])), np.int64)
        last = np.searchsorted(np.cumsum(self.a_size[joined]), np.cumsum(size[:closed]))
        alone = [self.a.encode_ordinary(x) for x in stretches[closed:]]
        return (np.concatenate([joined, *(np.array(x, np.int64) for x in alone)]),
                np.concatenate([np.diff(last, prepend=-1), np.array(list(map(len, alone)), np.int64)]))

    def _ids_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of ``stretches``, which have no U+2581, one after the other, and how many each has."""
        known = self.known
        ids = list(map(known.get, stretches))
        new = [i for i, x in enumerate(ids) if x is None]
        names = [stretches[i] for i in new]
        for i, x in zip(new, self.b.encode([x[1:] for x in names], num_threads=1) if names else [], strict=True):
            ids[i] = x or [self.space]
        keep = [(x, ids[i]) for x, i in zip(names, new, strict=True) if len(x) <= REMEMBERED][:self.limit]
        if len(known) + len(keep) > self.limit:
            known.clear()
        known.update(keep)
        many = np.array(list(map(len, ids)), np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum())), many

    def encode(self, stretches: list[str], size: np.ndarray, closed: int) -> Encoded:
        """Ids of distinct stretches of ``size`` bytes; those that B does not give back byte by byte are not ``good``."""
        a, n_a = self._ids_a(stretches, size, closed)
        b, n_b = self._ids_b(stretches)
        good = np.cumsum(self.b_size[b])[np.cumsum(n_b) - 1] == np.cumsum(size)
        if not good.all() or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != "".join(stretches).encode():
            at = np.concatenate(([0], np.cumsum(n_b))).tolist()
            good = np.array([b"".join(map(self.b_bytes.__getitem__, b[lo:hi].tolist())) == x.encode()
                             for lo, hi, x in zip(at, at[1:], stretches)], bool)
        return Encoded(a, n_a, b, n_b, good)


_tokenizers: dict[Pairing, Tokenizers] = {}


def tokenizers(pairing: Pairing) -> Tokenizers:
    if pairing not in _tokenizers:
        _tokenizers[pairing] = Tokenizers(pairing)
    return _tokenizers[pairing]


# ------------------------------------------------------------------ lockstep merging

def _lanes(a_ends: np.ndarray, b_ends: np.ndarray, docs: np.ndarray, lane: int) -> np.ndarray:
    """A tokens after which a lane ends: the last of every document, and inside long ones the first
    after every ``lane`` tokens whose end is an end of B too."""
    at = np.arange(lane - 1, len(a_ends), lane)
    done = []
    while len(at):
        shared = b_ends[np.searchsorted(b_ends, a_ends[at])] == a_ends[at]
        done.append(at[shared])
        at = at[~shared] + 1
    return np.unique(np.concatenate([docs, *done]))


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_docs: np.ndarray,
             lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping token pairs (i, j), and cuts: the tokens (i, j) that end at the same byte, in order.

    ``a_ends`` and ``b_ends``: ascending byte ends of all documents' tokens, laid end to end;
    ``a_docs``: last A token of every document that has any.
    """
    last_a = _lanes(a_ends, b_ends, a_docs, lane)
    last_b = np.searchsorted(b_ends, a_ends[last_a])
    i, j = np.concatenate(([0], last_a[:-1] + 1)), np.concatenate(([0], last_b[:-1] + 1))
    end = last_a
    links, cuts = [], []
    while len(i):
        x, y = a_ends[i], b_ends[j]
        links.append((i, j))
        cut = x == y
        cuts.append((i[cut], j[cut]))
        over = cut & (i == end)
        i, j = i + (x <= y), j + (y <= x)
        if over.any():
            i, j, end = i[~over], j[~over], end[~over]
    none = np.zeros(0, np.int64)
    link_i, link_j = (np.concatenate([none, *(x[k] for x in links)]) for k in (0, 1))
    cut_i, cut_j = (np.sort(np.concatenate([none, *(x[k] for x in cuts)])) for k in (0, 1))
    return link_i, link_j, cut_i, cut_j


# ------------------------------------------------------------------ links of groups

LARGE = 4096  # links from which a group's ids are counted before they are paired


def _pairs(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray,
           wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs (a * wide + b) of one document's groups, ascending, and how often each is linked.

    ``cut_a`` and ``cut_b``: where groups end (exclusive).
    """
    begin_a, begin_b = np.concatenate(([0], cut_a[:-1])), np.concatenate(([0], cut_b[:-1]))
    n_a, n_b = cut_a - begin_a, cut_b - begin_b
    links = n_a * n_b
    keys, times = [], []
    for lo in _slices(np.where(links > LARGE, 0, links)):
        of = lo[links[lo] <= LARGE]
        total = links[of]
        group = np.repeat(of, total)
        nth = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        key, count = np.unique(a[begin_a[group] + nth // n_b[group]] * wide + b[begin_b[group] + nth % n_b[group]],
                               return_counts=True)
        keys.append(key)
        times.append(count)
    for g in np.flatnonzero(links > LARGE).tolist():
        one, n_one = np.unique(a[begin_a[g]:cut_a[g]], return_counts=True)
        two, n_two = np.unique(b[begin_b[g]:cut_b[g]], return_counts=True)
        keys.append((one[:, None] * wide + two).ravel())
        times.append((n_one[:, None] * n_two).ravel())
    if len(keys) == 1:
        return keys[0], times[0]
    every, count = np.concatenate(keys), np.concatenate(times)
    key, back = np.unique(every, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, back, count)
    return key, total


def _slices(weight: np.ndarray, limit: int = 1 << 21) -> list[np.ndarray]:
    """Consecutive indices, cut where the weights reach ``limit``."""
    part = np.cumsum(weight) // limit
    return np.split(np.arange(len(weight)), np.flatnonzero(np.diff(part)) + 1) if len(weight) else []


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed bytes; the first (ascending) as differences, six bytes a number."""
    n = len(arrays[0])
    planes = [x.astype(np.int64).view(np.uint8).reshape(n, 8).T[:6].tobytes()
              for x in (np.diff(arrays[0], prepend=0), *arrays[1:])]
    return np.uint32(n).tobytes() + (pa.compress(b"".join(planes), "zstd", asbytes=True) if n else b"")


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    raw = pa.decompress(data[4:], 6 * n * columns, "zstd", asbytes=True) if n else b""
    wide = np.zeros((columns, n, 8), np.uint8)
    wide[:, :, :6] = np.frombuffer(raw, np.uint8).reshape(columns, 6, n).transpose(0, 2, 1)
    out = list(wide.view(np.int64).reshape(columns, n))
    return [np.cumsum(out[0]), *out[1:]]


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
           "part long, pairs binary")
_NONE = (0, 0, 0, 0, 0, "", _pack(np.zeros(0, np.int64), np.zeros(0, np.int64)))


@dataclass(frozen=True)
class Stretches:
    """The distinct stretches of some texts: their tokens, groups, links and names in the digest."""
    ids: Encoded
    a_from: np.ndarray       # first A token; so with B
    b_from: np.ndarray
    groups_from: np.ndarray  # first group
    n_groups: np.ndarray
    group_a: np.ndarray      # A tokens of every group; so with B
    group_b: np.ndarray
    n_links: np.ndarray
    large: np.ndarray        # whether a group has more than ``LARGE`` links
    n_overlaps: np.ndarray
    names: pa.Array          # of the groups, each after ";"

    @classmethod
    def of(cls, ids: Encoded, t: Tokenizers, lane: int) -> Stretches:
        a, b = ids.a, ids.b
        a_end, b_end = np.cumsum(ids.n_a), np.cumsum(ids.n_b)
        link_i, _, cut_i, cut_j = lockstep(np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b]), a_end - 1, lane)
        own = np.repeat(np.arange(len(a_end)), ids.n_a)  # stretch of an A token
        # names in the order of the digest: a group's A ids, then its B ids, each with the mark before it
        na, nb = len(t.a_bytes), len(t.b_bytes)
        first_a, first_b = np.zeros(len(a), np.int64), np.full(len(b), na * 2 + nb)
        begin_a, begin_b = np.concatenate(([0], cut_i[:-1] + 1)), np.concatenate(([0], cut_j[:-1] + 1))
        first_a[begin_a], first_b[begin_b] = na, na * 2
        order = np.empty(len(a) + len(b), np.int64)  # tokens of the groups before stand in front
        order[np.arange(len(a)) + np.repeat(begin_b, cut_i + 1 - begin_a)] = first_a + a
        order[np.arange(len(b)) + np.repeat(cut_i + 1, cut_j + 1 - begin_b)] = first_b + b
        n_groups = np.bincount(own[cut_i], minlength=len(a_end))
        group_end = np.cumsum(n_groups)
        group_a, group_b = cut_i + 1 - begin_a, cut_j + 1 - begin_b
        links = group_a * group_b
        at = group_end - n_groups
        return cls(ids, a_end - ids.n_a, b_end - ids.n_b, at, n_groups, group_a, group_b, np.add.reduceat(links, at),
                   np.maximum.reduceat(links, at) > LARGE, np.bincount(own[link_i], minlength=len(a_end)),
                   _strings(t.names.take(pa.array(order)), np.concatenate(([0], a_end + b_end))))

    def links(self, wide: int) -> np.ndarray:
        """Linked id pairs (a * wide + b) of all stretches, one after the other."""
        begin_a, begin_b = np.cumsum(self.group_a) - self.group_a, np.cumsum(self.group_b) - self.group_b
        n = self.group_a * self.group_b
        nth = _runs(np.zeros(len(n), np.int64), n)
        n_b = np.repeat(self.group_b, n)
        return self.ids.a[np.repeat(begin_a, n) + nth // n_b] * wide + self.ids.b[np.repeat(begin_b, n) + nth % n_b]

    def pairs(self, code: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """``_pairs`` of the document of these stretches, group by group."""
        ids, groups = self.ids, _runs(self.groups_from[code], self.n_groups[code])
        return _pairs(ids.a[_runs(self.a_from[code], ids.n_a[code])], ids.b[_runs(self.b_from[code], ids.n_b[code])],
                      np.cumsum(self.group_a[groups]), np.cumsum(self.group_b[groups]), wide)


def _strings(names: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Names joined: one string of those from each bound to the next."""
    at = np.frombuffer(names.buffers()[1], np.int64)[names.offset:names.offset + len(names) + 1][bounds]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1,
                                            [None, pa.py_buffer(at), names.buffers()[2]])


MANY = 1 << 21  # links that are paired in one go


def _document_pairs(code: np.ndarray, begin: np.ndarray, s: Stretches, wide: int,
                    high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_pairs`` of every document, in order; ``code``: their stretches, ``begin``: where each document's begin.

    Documents of some ``MANY`` links together are sorted in one go; pairs are below ``high``.
    """
    total = np.add.reduceat(s.n_links[code], begin[:-1])
    link = None if s.large.any() or s.n_links.sum() > 2 * MANY else s.links(wide)
    first_link = np.cumsum(s.n_links) - s.n_links
    for docs in _slices(total, MANY):
        if link is None or total[docs].sum() > 2 * MANY:
            for d in docs.tolist():
                yield s.pairs(code[begin[d]:begin[d + 1]], wide)
            continue
        own = code[begin[docs[0]]:begin[docs[-1] + 1]]
        key = link[_runs(first_link[own], s.n_links[own])] + np.repeat(np.arange(len(docs)) * high, total[docs])
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(first, append=len(key))
        key = key[first]
        bounds = np.searchsorted(key, np.arange(len(docs) + 1) * high).tolist()
        for d, (x, y) in enumerate(zip(bounds, bounds[1:])):
            yield key[x:y] - d * high, times[x:y]


def align_texts(texts: list[str], pairing: Pairing) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, packed pairs) of every text."""
    t = tokenizers(pairing)
    out: list[tuple] = [_NONE] * len(texts)
    use = [i for i, text in enumerate(texts) if text and "▁" not in text]
    if not use:
        return out
    code, begin, stretches, size, closed = _cut([texts[i] for i in use])
    ids = t.encode(stretches, size, closed)
    if not ids.good.all():  # texts that do not come back byte by byte go, and so do their stretches
        use = [use[k] for k in np.flatnonzero(np.logical_and.reduceat(ids.good[code], begin[:-1])).tolist()]
        for i, row in zip(use, align_texts([texts[i] for i in use], pairing), strict=True):
            out[i] = row
        return out
    s = Stretches.of(ids, t, pairing.lane)
    n = [np.add.reduceat(x[code], begin[:-1]).tolist() for x in (ids.n_a, ids.n_b, s.n_groups, s.n_links, s.n_overlaps)]
    names = s.names.take(pa.array(code))
    text = memoryview(names.buffers()[2])
    at = np.frombuffer(names.buffers()[1], np.int64)[begin].tolist()
    pairs = _document_pairs(code, begin, s, len(t.b_bytes), len(t.a_bytes) * len(t.b_bytes))
    for k, (i, both) in enumerate(zip(use, pairs, strict=True)):
        digest = hashlib.sha256(text[at[k] + 1:at[k + 1]]).hexdigest()  # without the mark before the first group
        out[i] = (*(x[k] for x in n), digest, _pack(*both))
    return out


def _aligned(docs: DataFrame, pairing: Pairing, parts: int) -> DataFrame:
    """A row per document: its numbers, its part and its packed pairs.

    The part follows from id and text; of many equal rows in a task, every ``copies`` have another.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}
        for batch in batches:
            texts = [raw.decode() for raw in utf8(batch.column(1))]
            rows: list[tuple] = []
            for group in batches_of_bytes(((t,) for t in texts), 4 << 20):
                rows += align_texts([t for t, in group], pairing)
            own = batch.column(2).to_pylist()
            part = []
            for h in own:
                n = met[h] = met.get(h, -1) + 1
                part.append((h + 0x9E3779B9 * (n // pairing.copies)) % parts)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string()),
                 pa.array(part, pa.int64()), pa.array(columns[6], pa.binary())],
                names=[c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text"),
                       F.xxhash64("doc_id", "text").alias("own")).mapInArrow(run, ALIGNED)


# ------------------------------------------------------------------ corpus counts

def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, count = every[order], count[order]
    first = np.flatnonzero(np.diff(every, prepend=-1))
    return every[first], np.add.reduceat(count, first) if len(first) else count


def _part_pairs(aligned: DataFrame, buckets: int, wide: int, merge: int) -> DataFrame:
    """Per part and bucket of A ids: its distinct pairs and how many of its documents hold each."""
    def run(table: pa.Table) -> pa.Table:
        keys = [_unpack(x, 2)[0] for x in table.column("pairs").to_pylist()]
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        bucket = key // wide % buckets
        some = np.unique(bucket)
        data = [_pack(key[at], count[at]) for x in some.tolist() for at in [bucket == x]]
        part = table.column("part")[0].as_py()
        return pa.table({"bucket": pa.array(some, pa.int32()), "slot": pa.array([part // merge] * len(some), pa.int64()),
                         "part": pa.array([part] * len(some), pa.int64()), "data": pa.array(data, pa.binary())})

    # all columns: the texts' shuffle is the one that the results are made from, so it runs once
    return aligned.groupBy("part").applyInArrow(run, "bucket int, slot long, part long, data binary")


def _totals(parts: DataFrame, slots: int, wide: int) -> DataFrame:
    """Per bucket: corpus-wide counts of its pairs, and whether each is its A id's highest; a row per slot."""
    def add(table: pa.Table) -> pa.Table:
        both = [_unpack(x, 2) for x in table.column("data").to_pylist()]
        key, count = _added([x for x, _ in both], [x for _, x in both])
        return pa.table({"bucket": table.column("bucket")[:1], "data": pa.array([_pack(key, count)], pa.binary())})

    def best(table: pa.Table) -> pa.Table:
        both = [_unpack(x, 2) for x in table.column("data").to_pylist()]
        key, count = _added([x for x, _ in both], [x for _, x in both])
        first = np.flatnonzero(np.diff(key // wide, prepend=-1))
        top = np.repeat(np.maximum.reduceat(count, first), np.diff(np.append(first, len(key))))
        return pa.table({"bucket": table.column("bucket")[:1],
                         "totals": pa.array([_pack(key, count, count == top)], pa.binary())})

    once = parts.select("bucket", "slot", "data").groupBy("bucket", "slot").applyInArrow(add, "bucket int, data binary")
    every = once.groupBy("bucket").applyInArrow(best, "bucket int, totals binary")
    return every.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"),
                        "totals")


def _answers(parts: DataFrame, totals: DataFrame) -> DataFrame:
    """To every part: the counts of its pairs, bucket by bucket."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            key, count, top = _unpack(right.column("totals")[0].as_py(), 3)
            for data in left.column("data").to_pylist():
                own = _unpack(data, 2)[0]
                at = np.searchsorted(key, own)
                out.append(_pack(own, count[at], top[at]))
        return pa.table({"part": left.column("part").cast(pa.int64()), "counts": pa.array(out, pa.binary())})

    return (parts.groupBy("bucket", "slot").cogroup(totals.groupBy("bucket", "slot"))
            .applyInArrow(run, "part long, counts binary"))


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string, n_overlaps long")


def align(docs: DataFrame, pairing: Pairing = Pairing()) -> DataFrame:
    """One row per document: tokens, groups and links, links that are their A id's commonest
    (``n_best``), corpus counts added over the links (``count_sum``), a digest of the groups, and
    ``n_overlaps``, the links whose tokens share a byte."""
    spark = docs.sparkSession
    small_batches(spark)
    wide = len(tokenizers(pairing).b_bytes)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(width(spark), -(-size // pairing.part_bytes))
    slots = -(-n_parts // pairing.merge)
    buckets = max(8, min(2048, -(-size // pairing.bucket_bytes)))
    aligned = _aligned(docs, pairing, n_parts)
    parts = _part_pairs(aligned, buckets, wide, pairing.merge)
    answers = _answers(parts, _totals(parts, slots, wide))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = [_unpack(x, 2) for x in left.column("pairs").to_pylist()]
        got = [_unpack(x, 3) for x in right.column("counts").to_pylist()]
        key, count, top = ((np.concatenate([x[i] for x in got]) for i in range(3)) if got
                           else (np.zeros(0, np.int64),) * 3)
        order = np.argsort(key)
        key, count, top = key[order], count[order], top[order]
        best, total = [], []
        for own, times in rows:
            at = np.searchsorted(key, own)
            best.append(int((times * top[at]).sum()))
            total.append(int((times * count[at]).sum()))
        out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_overlaps"])
        out = out.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return out.select([c.split()[0] for c in RESULT.split(", ")])

    return aligned.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(finish, RESULT)
