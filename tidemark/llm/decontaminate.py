"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items make one automaton that recognises
every run of words of any item. Documents are streamed through it: the state after a
word stands for the longest run that ends there and occurs in an item. A
window is ``window`` consecutive words of an item (all words of a shorter
item); wherever the longest match reaches a window's length, its words are hit, and
the state says which items hold it.

Before streaming, neighbouring words that follow each other in no item are cut
apart, and pieces shorter than the shortest window are left out: no match can
span such a cut, so nothing is lost, and nearly all text ends there, in numpy.

Test items of any number are read in blocks of at most about ``block_words`` words, each an
automaton of its own; all documents pass by every block, and hits are joined per document.
A worker holds one block at a time. Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no word and are clean; a null or empty item, or one without
words, has no window; an item with a null id marks words but is not listed;
item ids that repeat are one item; repeated documents each get a row; very long texts are
handled whole, in arrays of some 30 bytes a word; an empty table gives no rows, no items leave all clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import batches_of_bytes, joined, small_batches, text_column, utf8, words
from tidemark.session import materialize


@dataclass(frozen=True)
class Rules:
    window: int = 10              # words of an item that make a hit; shorter items must occur whole
    coverage: float = 0.5         # a document with a larger share of hit words goes altogether
    block_words: int = 100_000    # words of one automaton
    piece_words: int = 20_000     # longer items are cut into pieces that overlap by window - 1 words


#: Bytes between words: ASCII but for digits and letters.
_GAP = np.ones(256, dtype=bool)
_GAP[0x80:] = False
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of all texts, and where each text's words begin (n + 1)."""
    buf, offsets = joined(texts)
    starts, ends, h = words(buf, lower=True, space=_GAP)
    first = np.searchsorted(starts, offsets)
    return starts, ends, h, first


class SuffixAutomaton:
    """Generalised suffix automaton of sequences of word numbers.

    ``windows[state]``: items that hold the window which ends in this state; ``shorts[state]``: (words,
    items) of the items shorter than a window that are suffixes of the state's run.
    """

    def __init__(self, sequences: list[tuple[str | None, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.window = window
        self.gram = self._grams()
        self.windows: dict[int, set[str | None]] = {}
        whole: dict[int, dict[int, set[str | None]]] = {}
        for item, sequence in sequences:
            state, n = 0, 0
            for word in sequence:
                state, n = self.next[state][word], n + 1
                if n >= window:
                    self.windows.setdefault(self.gram[state], set()).add(item)
            if 0 < n < window:
                whole.setdefault(state, {}).setdefault(n, set()).add(item)
        self.shorts: dict[int, list[tuple[int, set[str | None]]]] = {}
        if whole:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                found = self.shorts.get(self.link[state], []) + sorted(whole.get(state, {}).items())
                if found:
                    self.shorts[state] = found

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        """State of the run of ``last`` followed by ``word``."""
        there = self.next[last].get(word)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
        state = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            there = self.next[last][word]
            self.link[state] = (there if self.length[there] == self.length[last] + 1
                                else self._split(last, word, there))
        return state

    def _split(self, last: int, word: int, there: int) -> int:
        """A state of its own for the shorter runs of ``there``, those that ``last`` leads to."""
        own = self._state(self.length[last] + 1, self.link[there], dict(self.next[there]))
        self.link[there] = own
        while last >= 0 and self.next[last].get(word) == there:
            self.next[last][word] = own
            last = self.link[last]
        return own

    def _grams(self) -> list[int]:
        """For every state, the one up its links that holds its last ``window`` words (-1: shorter)."""
        gram = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[state] >= self.window:
                above = self.link[state]
                gram[state] = gram[above] if self.length[above] >= self.window else state
        return gram

    def stream(self, numbers: list[int]) -> tuple[list[int], list[int]]:
        """State and longest matching length after each word."""
        edges, link, length = self.next, self.link, self.length
        state, n, states, lengths = 0, 0, [], []
        for word in numbers:
            while state and word not in edges[state]:
                state = link[state]
                n = length[state]
            there = edges[state].get(word)
            if there is None:
                n = 0
            else:
                state, n = there, n + 1
            states.append(state)
            lengths.append(n)
        return states, lengths


class Block:
    """The automaton of some items and the filters before it."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        hashes = [np.frombuffer(raw, np.uint64) for _, raw in items]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        numbers = [np.searchsorted(self.vocabulary, h) for h in hashes]
        self.size = max(1, len(self.vocabulary))
        pairs = [x[:-1] * self.size + x[1:] for x in numbers]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.shortest = min((min(window, len(x)) for x in numbers), default=window)
        self.slots = np.zeros(1 << 20, bool)
        self.slots[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        self.automaton = SuffixAutomaton([(i, x.tolist()) for (i, _), x in zip(items, numbers, strict=True)], window)

    def _numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary number of every word, -1 if no item has it."""
        out = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(self.slots[(h >> np.uint64(44)).astype(np.int64)])
        if len(at) and len(self.vocabulary):
            place = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
            hit = self.vocabulary[place] == h[at]
            out[at[hit]] = place[hit]
        return out

    def pieces(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words, and start and end of the pieces that may hold a window."""
        number = self._numbers(h)
        known = number >= 0
        follows = np.zeros(len(h) + 1, bool)  # word i goes on from word i - 1
        if len(h) > 1 and len(self.pairs):
            at = np.flatnonzero(known[1:] & known[:-1]) + 1
            pair = number[at - 1] * self.size + number[at]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            follows[at[self.pairs[place] == pair]] = True
        follows[first] = False  # texts are kept apart
        starts = np.flatnonzero(known & ~follows[:-1])
        ends = np.flatnonzero(known & ~follows[1:]) + 1
        able = ends - starts >= self.shortest
        return number, starts[able], ends[able]

    def hits(self, h: np.ndarray, first: np.ndarray, add: np.ndarray, items: list[set[str | None]],
             longest: np.ndarray) -> None:
        """Enter hit words (+1 at a start, -1 after an end), items and longest matches of every text."""
        number, starts, ends = self.pieces(h, first)
        auto = self.automaton
        doc = np.searchsorted(first, starts, side="right") - 1
        for a, b, d in zip(starts.tolist(), ends.tolist(), doc.tolist(), strict=True):
            states, lengths = auto.stream(number[a:b].tolist())
            for i, (state, n) in enumerate(zip(states, lengths, strict=True), a + 1):
                if n >= auto.window:
                    add[i - auto.window] += 1
                    add[i] -= 1
                    items[d] |= auto.windows[auto.gram[state]]
                    longest[d] = max(longest[d], n)
                for size, found in auto.shorts.get(state, ()) if auto.shorts else ():
                    if size <= n:
                        add[i - size] += 1
                        add[i] -= 1
                        items[d] |= found
                        longest[d] = max(longest[d], n)


_block: tuple[object, Block] | None = None


def _load(key: tuple, items: list[tuple[str | None, bytes]], window: int) -> Block:
    """The block, kept by the worker until another one is asked for."""
    global _block
    if _block is None or _block[0] != key:
        _block = None
        _block = key, Block(items, window)
    return _block[1]


@dataclass
class Found:
    """What the blocks found in one text."""

    n_words: int
    n_hit: int
    items: list[str]
    longest: int
    spans: list[tuple[int, int]]  # bytes of the runs of hit words


def _found(texts: list[bytes], blocks: list, window: int) -> list[Found]:
    starts, ends, h, first = word_hashes(texts)
    add, longest = np.zeros(len(h) + 1, np.int64), np.zeros(len(texts), np.int64)
    items: list[set[str | None]] = [set() for _ in texts]
    if len(h):
        for key, block in blocks:
            _load((key, window), block.value, window).hits(h, first, add, items, longest)
    hit = np.cumsum(add[:-1]) > 0
    _, offsets = joined(texts)
    before = np.concatenate(([0], np.cumsum(hit)))
    inner = np.zeros(len(h) + 1, bool)  # a run goes on from the word before
    inner[1:-1] = hit[1:] & hit[:-1]
    inner[first] = False
    opens, closes = np.flatnonzero(hit & ~inner[:-1]), np.flatnonzero(hit & ~inner[1:])
    of = np.searchsorted(opens, first)
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        runs = slice(of[i], of[i + 1])
        spans = zip((starts[opens[runs]] - offsets[i]).tolist(), (ends[closes[runs]] - offsets[i]).tolist(), strict=True)
        out.append(Found(int(b - a), int(before[b] - before[a]), sorted(x for x in items[i] if x is not None),
                         int(longest[i]), list(spans)))
    return out


def _item_pieces(items: DataFrame, rules: Rules) -> DataFrame:
    """item_id (text) and word hashes of every item, long items in overlapping pieces."""
    step = max(1, rules.piece_words - rules.window + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data = [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                h = word_hashes([text])[2]
                for at in range(0, max(1, len(h) - rules.window + 1), step) if len(h) else ():
                    ids.append(item)
                    data.append(h[at:at + step + rules.window - 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(data, pa.binary())],
                                             names=["item_id", "words"])

    return items.select(F.col("item_id").cast("string"), text_column().alias("text")).mapInArrow(
        run, "item_id string, words binary")


def item_blocks(items: DataFrame, rules: Rules = Rules()) -> list:
    """(key, broadcast items) of every block: the driver holds one block at a time."""
    spark = items.sparkSession
    pieces = materialize(_item_pieces(items, rules).distinct())
    total = pieces.agg(F.sum(F.length("words") / 8).cast("long")).first()[0] or 0
    n = -(-total // rules.block_words)
    part = F.pmod(F.xxhash64("words", "item_id"), F.lit(max(1, n)))
    out = []
    for i in range(n):
        rows = sorted(((r["item_id"], bytes(r["words"])) for r in pieces.where(part == i).collect()),
                      key=lambda x: (x[0] is None, x))
        key = hashlib.sha256(b"".join(w for _, w in rows) + repr([i for i, _ in rows]).encode()).hexdigest()
        out.append((key, spark.sparkContext.broadcast(rows)))
    return out


SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items array<string>, longest long, "
          "starts array<long>, ends array<long>")


def scan(docs: DataFrame, items: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Hits of every document: one row per input row, no shuffle.

    ``starts`` and ``ends`` are the byte spans of the runs of hit words, ``longest`` is the longest match among
    them in words (an item's pieces and blocks apart).
    """
    small_batches(docs.sparkSession)
    blocks = item_blocks(items, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for group in batches_of_bytes((t,) for t in utf8(batch.column(1))):
                found += _found([t for t, in group], blocks, rules.window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([getattr(f, c) for f in found], pa.int64()) for c in ("n_words", "n_hit")),
                 pa.array([len(f.items) for f in found], pa.int64()),
                 pa.array([f.items for f in found], pa.list_(pa.string())),
                 pa.array([f.longest for f in found], pa.int64()),
                 *(pa.array([[s[i] for s in f.spans] for f in found], pa.list_(pa.int64())) for i in (0, 1))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items", "longest", "starts", "ends"])

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(run, SCHEMA)


def decontaminate(docs: DataFrame, items: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents, all columns, without the spans of hit words; those hit beyond ``coverage`` go.

    A span runs from its first word's first byte to its last word's last; clean texts (null too) stay as they are.
    """
    small_batches(docs.sparkSession)
    blocks, at = item_blocks(items, rules), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            raw, done = utf8(batch.column(at)), 0
            for group in batches_of_bytes((t,) for t in raw):
                for f in _found([t for t, in group], blocks, rules.window):
                    keep.append(f.n_hit <= rules.coverage * f.n_words)
                    if f.spans:
                        edges = [0, *(x for span in f.spans for x in span), len(raw[done])]
                        texts[done] = b"".join(raw[done][a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
                    done += 1
            column = pa.array(texts, batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), column).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(hits: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``'s rows."""
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"), "longest")


def oracle_sql() -> str:
    """The contract's columns by a plain join of windows, for DuckDB over ``documents`` and ``benchmark``."""
    def word_list(text: str) -> str:
        folded = f"translate(COALESCE({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH items AS (
    SELECT item_id, ws, CAST(least({Rules().window}, len(ws)) AS BIGINT) AS size
    FROM (SELECT item_id, {word_list('text')} AS ws FROM benchmark) WHERE len(ws) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[s:s + size - 1], ' ') AS words
    FROM (SELECT item_id, ws, size, UNNEST(range(1, len(ws) - size + 2)) AS s FROM items)),
docs AS (SELECT doc_id, {word_list('text')} AS ws FROM documents),
runs AS (
    SELECT doc_id, size, s, array_to_string(ws[s:s + size - 1], ' ') AS words
    FROM (SELECT doc_id, ws, size, UNNEST(range(1, len(ws) - size + 2)) AS s
          FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(ws) >= size)),
found AS (SELECT r.doc_id, r.s, r.size, w.item_id FROM runs r JOIN windows w USING (size, words)),
hit AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, UNNEST(range(s, s + size)) AS place FROM (SELECT DISTINCT doc_id, s, size FROM found))
        GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
