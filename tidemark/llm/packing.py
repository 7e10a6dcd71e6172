"""Best-fit packing: few-document length patterns by non-negative least squares.

Texts are tokenized once; what travels on is a row per piece with its length.
The histogram of lengths (at most ``seq_len`` rows, whatever the corpus) is
packed on the driver: patterns of up to three lengths that fill a sequence
exactly get repeat counts by non-negative least squares, rounded down; the
residual histogram is packed best fit, longest first, whole groups of equal
sequences at a time. The packed histogram becomes a table of intervals: the
r-th piece of a length goes to this sequence and offset. Ranks within a length
come from hash slices plus prefix counts, so a length that many pieces share
is never ordered in one task.

Defined cases: null and empty texts are a piece of the end id alone; texts over
``seq_len`` ids are cut, nothing else is; repeated rows are packed each; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm._common import batches_of_bytes, mix, power_tables, small_batches, text_column, width
from tidemark.session import materialize

SEQ_LEN = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

# ------------------------------------------------------------------ tokenization

#: Code points below this take the array path, texts with others the tokenizer itself.
LATIN = 0x180
#: Words whose ids a worker keeps.
CACHE_WORDS = 400_000
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0]


class Encoder:
    """Ids of a lower-casing, word-splitting BPE vocabulary, each distinct word encoded once.

    Splits Latin texts into the vocabulary's pre-tokens (letter runs, single
    digits, runs of other signs, English contractions) with array operations,
    encodes unseen pre-tokens with the vocabulary's own model and gathers ids
    for all occurrences. Texts outside Latin, or with marks of special tokens,
    go through ``Tokenizer.encode`` whole.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.model = self.whole.model
        self.cache: dict[int, bytes] = {}
        kinds = {"L": 1, "N": 2}
        self.kind = np.array([0 if c in _SPACES else kinds.get(unicodedata.category(chr(c))[0], 3)
                              for c in range(LATIN)], np.uint8)
        rng = np.random.default_rng(7)
        self.code = rng.integers(1, 1 << 63, LATIN, dtype=np.uint64) | np.uint64(1)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in spec] != ["Split", "ByteLevel"]:
            raise ValueError("the array path knows only a split pattern followed by byte-level symbols")
        # the byte-level alphabet: printable bytes stand for themselves, others from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def word_ids(self, word: str) -> bytes:
        text = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.symbols)
        return np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()

    def latin(self, text: str) -> bool:
        if "<|" in text or "İ" in text:
            return False
        return text.isascii() or max(text) < chr(LATIN)

    def pre_tokens(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens of lower-cased code points."""
        kind = self.kind[codes]
        prev = np.concatenate(([0], kind[:-1]))
        change = (kind != prev) | (kind == 2)
        nxt = np.concatenate((kind[1:], [0]))
        quotes = np.flatnonzero((codes == 0x27) & (prev != 3) & (nxt == 1))
        for q in quotes.tolist():
            tail = codes[q + 1:q + 3].tobytes().decode("utf-16-le")
            n = 1 if tail[0] in "stmd" else 2 if tail in ("re", "ve", "ll") else 0
            if n:
                change[q + 1] = False
                if q + 1 + n < len(codes) and kind[q + 1 + n] == 1:
                    change[q + 1 + n] = True
        edges = np.append(np.flatnonzero(change), len(codes))
        word = kind[edges[:-1]] != 0
        return edges[:-1][word], edges[1:][word]

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of Latin texts."""
        lower = "".join(t.lower() + "\n" for t in texts)
        codes = np.frombuffer(lower.encode("utf-16-le"), "<u2")
        starts, ends = self.pre_tokens(codes)
        up, down = power_tables(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.code[codes] * up[:len(codes)], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, ids = self.cache, []
        for key, i in zip(distinct.tolist(), first.tolist(), strict=True):
            found = cache.get(key)
            if found is None:
                found = cache[key] = self.word_ids(lower[starts[i]:ends[i]])
            ids.append(found)
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        begin = np.cumsum(lengths) - lengths
        n = lengths[back]
        stop = np.cumsum(n)
        out = flat[np.repeat(begin[back] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        text_end = np.cumsum([len(t.lower()) + 1 for t in texts])
        cut = np.concatenate(([0], stop))[np.searchsorted(starts, text_end, "left")]
        return [out[a:b].tobytes() for a, b in zip(np.concatenate(([0], cut[:-1])), cut, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        latin = []
        for i, t in enumerate(texts):
            if self.latin(t):
                latin.append((t, i))
            else:
                out[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        for group in batches_of_bytes(iter(latin)):
            for (_, i), ids in zip(group, self.encode_block([t for t, _ in group]), strict=True):
                out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The vocabulary's encoder, built once per worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """A row per piece of every document; the vocabulary's file is looked up where the task runs."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary or default_vocabulary())
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids_of = enc.encode(batch.column(1).to_pylist())
            rows = [(d, k // seq_len, k, min(seq_len, len(ids) // 4 - k), zlib.crc32(ids[4 * k:4 * (k + seq_len)]))
                    for d, ids in zip(batch.column(0).to_pylist(), (x + end for x in ids_of), strict=True)
                    for k in range(0, len(ids) // 4, seq_len)]
            columns = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(cut, PIECES)


# ------------------------------------------------------------------ packing the histogram


def length_patterns(present: np.ndarray, seq_len: int, heads: int = 160) -> np.ndarray:
    """Rows of three lengths (0 for none) that add up to ``seq_len``, all present.

    All single lengths and pairs; triples of two of the ``heads`` lengths
    spread evenly over those present, completed exactly.
    """
    have = np.zeros(seq_len + 1, bool)
    have[present] = True
    rows = [(seq_len, 0, 0)] if have[seq_len] else []
    rows += [(a, seq_len - a, 0) for a in range((seq_len + 1) // 2, seq_len) if have[a] and have[seq_len - a]]
    some = present[np.unique(np.linspace(0, len(present) - 1, min(heads, len(present))).astype(int))]
    triples = {tuple(sorted((int(a), int(b), int(seq_len - a - b)), reverse=True))
               for a in some for b in some if a >= b and seq_len - a - b > 0 and have[seq_len - a - b]}
    return np.array(rows + sorted(triples), np.int64).reshape(-1, 3)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats x with patterns' lengths x ≈ counts.

    Accelerated projected gradient; residuals weigh by length, so that long
    pieces, which nothing else can place, are met first. All sums are
    ``bincount`` over the patterns' entries.
    """
    size = len(counts)
    used = patterns > 0
    weight = np.arange(size) / size

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns[used], np.repeat(x, used.sum(1)), size)

    def backward(r: np.ndarray) -> np.ndarray:
        return np.where(used, r[patterns], 0).sum(1)

    power = np.ones(len(patterns))
    for _ in range(30):  # largest eigenvalue, for the step
        power = backward(weight * forward(power))
        norm = np.linalg.norm(power)
        power /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - backward(weight * (forward(y) - counts)) / (1.05 * norm))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def pack_histogram(counts: np.ndarray, seq_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, [(length, pieces of it in each)]) that place every piece of the histogram.

    ``counts[l]`` pieces have length l. Work follows the number of lengths,
    not of pieces.
    """
    left = counts.astype(np.int64).copy()
    full: list[tuple[int, list[tuple[int, int]]]] = []
    present = np.flatnonzero(left)
    patterns = length_patterns(present, seq_len) if len(present) else np.zeros((0, 3), np.int64)
    if len(patterns):
        repeats = fit_repeats(patterns, counts.astype(float))
        for k in np.argsort(-repeats, kind="stable"):
            lengths = [int(v) for v in patterns[k] if v]
            each = {v: lengths.count(v) for v in lengths}
            n = int(min(np.floor(repeats[k]), *(left[v] // m for v, m in each.items())))
            if n > 0:
                for v, m in each.items():
                    left[v] -= n * m
                full.append((n, list(each.items())))
    # best fit decreasing over groups of sequences with equal contents
    room: list[list[tuple[int, list[tuple[int, int]]]]] = [[] for _ in range(seq_len + 1)]
    some = np.zeros(seq_len + 1, bool)
    for length in range(seq_len, 0, -1):
        todo = int(left[length])
        while todo:
            fits = np.flatnonzero(some[length:])
            space = length + int(fits[0]) if len(fits) else seq_len
            fit = min(space // length, todo)
            if len(fits):
                n, holds = room[space].pop()
                some[space] = bool(room[space])
                take = min(n, todo // fit)
                if take < n:
                    room[space].append((n - take, holds))
                    some[space] = True
            else:
                take, holds = todo // fit, []
            todo -= take * fit
            room[space - fit * length].append((take, [*holds, (length, fit)]))
            some[space - fit * length] = space > fit * length
    return full + [group for groups in room for group in groups]


def intervals(packed: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset), by length and rank."""
    rows, used, sequence = [], {}, 0
    for n, holds in packed:
        offset = 0
        for length, each in holds:
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + n * each
            offset += length * each
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


RANK_BITS = 48


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``: 0, 1, ... within each length, without ordering a length as a whole."""
    slices = max(16, width(parts.sparkSession))
    sliced = parts.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counted = (sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
               .select(F.col("length").alias("_length"), F.col("slice").alias("_slice"),
                       (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("_before")))
    here = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    return (sliced.withColumn("_here", F.row_number().over(here))
            .join(counted, (F.col("length") == F.col("_length")) & (F.col("slice") == F.col("_slice")))
            .withColumn("rank", F.col("_before") + F.col("_here") - 1)
            .select(*parts.columns, "rank"))


def pack(docs: DataFrame, vocabulary: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """Every piece of every document with its sequence and offset (``PLACED``)."""
    parts = materialize(pieces(docs, vocabulary, seq_len))
    counts = np.zeros(seq_len + 1, np.int64)
    for row in parts.groupBy("length").count().collect():  # at most seq_len rows
        counts[row["length"]] = row["count"]
    table = intervals(pack_histogram(counts, seq_len))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table[:, 0] << RANK_BITS) | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            row = table[np.searchsorted(keys, (length << RANK_BITS) | rank, "right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(row[:, 2] + nth // row[:, 3]),
                 pa.array(row[:, 4] + nth % row[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(parts).mapInArrow(place, PLACED)
