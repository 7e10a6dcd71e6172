"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

A word's letters are compared with landmark words by the gap-weighted
subsequence kernel (all common subsequences of ``p`` letters, each gap
costing a factor), normalized, so insults with inserted, doubled or missing
characters stay close to their plain form. Letters that a text sets apart (i d
i o t, i-d-i-o-t) are joined first. Landmarks are the words that tell the labelled classes
apart best; the kernel rows of a sentence (largest over its words) are
projected by the inverse root of the landmarks' kernel matrix, and a linear
SVM is trained on labelled sentences. A document scores as its worst sentence.

The model is fitted on at most ``train_rows`` labelled documents per class
(hash order of their ids) and is a few small arrays. Everything else covers every document's whole
text. No label, lang, source or id is an input of a score.

Defined cases: null and empty texts score as a sentence without any word;
null labels are not used; repeated rows each get a row; without both labels in the training rows
every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import small_batches, text_column
from tidemark.session import materialize


@dataclass(frozen=True)
class Settings:
    p: int = 3                  # letters of a subsequence
    decay: float = 0.6          # factor of every letter spanned
    support: float = 0.35       # smaller kernel values count as 0
    landmarks: int = 48
    alike: float = 0.8          # kernel value from which a word is no landmark beside a better one
    min_docs: int = 4           # toxic documents a landmark word must be in
    train_rows: int = 3000      # labelled documents per class
    sentences: int = 6          # of a labelled document, those most like the landmarks
    word: int = 24              # letters of a piece; longer words are cut into overlapping pieces
    c: float = 1.0
    epochs: int = 30


@dataclass
class Model:
    settings: Settings
    words: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # over kernel rows, projection included
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


SENTENCE = re.compile(r"[.!?\n]+")
SPELLED = re.compile(r"(?<!\w)\w(?:[\s.*_-]\w){3,}(?!\w)")


def letters(token: str) -> str:
    return token.lower() if token.isalpha() else "".join(filter(str.isalpha, token.lower()))


def pieces(token: str, size: int) -> list[str]:
    """The token's letters; beyond ``size`` in pieces that overlap by half."""
    word = letters(token)
    if len(word) <= size:
        return [word] if len(word) > 2 else []
    return [word[i:i + size] for i in range(0, len(word) - size // 2, size // 2)]


def spelled_out(text: str) -> list[str]:
    """Words whose letters stand apart, joined."""
    return [letters(m[0]) for m in SPELLED.finditer(text)]


def _codes(words: list[str], size: int) -> np.ndarray:
    """Letters as numbers, accents folded, 0 after the end."""
    flat = [w if w.isascii() else "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
            for w in words]
    return np.array(flat, f"<U{size}").view(np.uint32).reshape(len(flat), size).astype(np.int64)


def subsequence_kernel(x: np.ndarray, y: np.ndarray, p: int, decay: float) -> np.ndarray:
    """Gap-weighted subsequence kernel of row pairs (letters as numbers, 0 after the end)."""
    n, m, rows = x.shape[1], y.shape[1], len(x)
    same = [[((x[:, i] == y[:, j]) & (x[:, i] > 0)).astype(np.float32) for j in range(m)] for i in range(n)]
    # prev[i][j]: weight of common subsequences within the first i and j letters, up to those ends
    prev = np.ones((n + 1, m + 1, rows), np.float32)
    out = np.zeros(rows, np.float32)
    for step in range(p):
        if step == p - 1:
            for i in range(n):
                for j in range(m):
                    out += same[i][j] * prev[i, j] * (decay * decay)
            break
        cur = np.zeros((n + 1, m + 1, rows), np.float32)
        for i in range(n):
            run = np.zeros(rows, np.float32)
            for j in range(m):
                run = decay * run + (decay * decay) * same[i][j] * prev[i, j]
                cur[i + 1, j + 1] = decay * cur[i, j + 1] + run
        prev = cur
    return out


@lru_cache(maxsize=64)
def _places(n: int, p: int) -> np.ndarray:
    """All choices of ``p`` ascending places out of ``n``, one per row."""
    return np.array(list(combinations(range(n), p)), np.int64).reshape(-1, p)


class Kernel:
    """Normalized kernel values of words against fixed landmarks, zero outside the support.

    Every subsequence of the words is looked up among those of the landmarks, so
    no pair is ruled out beforehand: a value is 0 only if it is below ``support``.
    """

    BATCH = 1 << 20  # subsequences looked up in one go

    def __init__(self, words: list[str], settings: Settings):
        self.s, self.words = settings, words
        self.codes = _codes(words, settings.word)
        self.size = (self.codes > 0).sum(1)
        self.own = self._self(self.codes, self.size)
        distinct = np.tril(np.ones((settings.word + 1, settings.word), np.int64), -1) * np.arange(1, settings.word + 1)
        self.floor = self._self(distinct, np.arange(settings.word + 1))
        # letters as small numbers (0: in no landmark), subsequences as numbers to their base
        used = np.unique(self.codes[self.codes > 0])
        self.letter = np.zeros(0x110000, np.int64)
        self.letter[used] = np.arange(1, len(used) + 1)
        self.base = len(used) + 1
        weight: dict[tuple[int, int], float] = {}
        for k, n in enumerate(self.size.tolist()):
            keys, factors = self._subsequences(self.letter[self.codes[k:k + 1]], n)
            for key, factor in zip(keys[0].tolist(), factors.tolist(), strict=True):
                weight[key, k] = weight.get((key, k), 0.0) + factor
        found = sorted(weight)
        self.keys, self.first = np.unique(np.array([key for key, _ in found], np.int64), return_index=True)
        self.many = np.diff(np.append(self.first, len(found)))
        self.landmark = np.array([k for _, k in found], np.int64)
        self.weight = np.array([weight[x] for x in found])

    def _subsequences(self, letters: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of every subsequence of words of ``n`` letters (0 if it is in no landmark), and its decay."""
        places = _places(n, self.s.p)
        keys, known = np.zeros((len(letters), len(places)), np.int64), np.ones((len(letters), len(places)), bool)
        for place in places.T:
            keys = keys * self.base + letters[:, place]
            known &= letters[:, place] > 0
        return np.where(known, keys, 0), self.s.decay ** (places[:, -1] - places[:, 0] + 1.0)

    def _self(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.float32)
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            out[at] = subsequence_kernel(codes[at, :n], codes[at, :n], self.s.p, self.s.decay)
        return out

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) of the values that are not 0, by word."""
        codes = _codes(words, self.s.word)
        sizes = (codes > 0).sum(1)
        letters, w, k, value = self.letter[codes], [], [], []
        for n in np.unique(sizes[sizes >= self.s.p]).tolist():
            same = np.flatnonzero(sizes == n)
            step = max(1, self.BATCH // len(_places(n, self.s.p)))
            for lo in range(0, len(same), step):
                at = same[lo:lo + step]
                total = self._against_landmarks(letters[at], n)
                row, mark = np.nonzero(total)
                w.append(at[row])
                k.append(mark)
                value.append(total[row, mark])
        if not w or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        w, k, value = np.concatenate(w), np.concatenate(k), np.concatenate(value)
        order = np.argsort(w, kind="stable")
        w, k, value = w[order], k[order], value[order]
        # a word's own kernel is at least that of as many different letters: most pairs end here
        value /= np.sqrt(np.maximum(self.own[k], 1e-12))
        able = value >= 0.999 * self.s.support * np.sqrt(self.floor[sizes[w]])
        w, k, value = w[able], k[able], value[able]
        own = np.zeros(len(words), np.float32)
        some = np.unique(w)
        own[some] = self._self(codes[some], sizes[some])
        value /= np.sqrt(np.maximum(own[w], 1e-12))
        keep = value >= self.s.support
        return w[keep], k[keep], value[keep]

    def _against_landmarks(self, letters: np.ndarray, n: int) -> np.ndarray:
        """Kernel values (not normalized) of words of ``n`` letters, a column per landmark."""
        marks = len(self.words)
        if not len(self.keys):
            return np.zeros((len(letters), marks))
        keys, factors = self._subsequences(letters, n)
        row, at = np.nonzero(keys)
        place = np.minimum(np.searchsorted(self.keys, keys[row, at]), len(self.keys) - 1)
        hit = self.keys[place] == keys[row, at]
        row, at, place = row[hit], at[hit], place[hit]
        many = self.many[place]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        where = np.repeat(self.first[place], many) + nth
        return np.bincount(np.repeat(row, many) * marks + self.landmark[where],
                           np.repeat(factors[at], many) * self.weight[where],
                           len(letters) * marks).astype(float).reshape(-1, marks)


class Scorer:
    """Kernel rows of sentences; a worker keeps what it has learnt of tokens, up to ``LIMIT``."""

    LIMIT = 600_000

    def __init__(self, words: list[str], settings: Settings):
        self.kernel, self.s = Kernel(words, settings), settings
        self.known: dict[str, list[tuple[int, float]] | None] = {}  # of tokens as they stand
        self.values: dict[str, list[tuple[int, float]] | None] = {}  # of their letters
        self.ends: set[str] = set()  # tokens with the end of a sentence

    def learn(self, tokens: set[str]) -> None:
        new = tokens - self.known.keys()
        if len(self.known) + len(new) > self.LIMIT:
            for learnt in (self.known, self.values, self.ends):
                learnt.clear()
            new = tokens
        of = {t: pieces(t, self.s.word) for t in new}
        fresh = sorted({x for xs in of.values() for x in xs} - self.values.keys())
        for lo in range(0, len(fresh), 20_000):
            some = fresh[lo:lo + 20_000]
            self.values.update(dict.fromkeys(some))
            for i, k, v in zip(*(x.tolist() for x in self.kernel.rows(some)), strict=True):
                if self.values[some[i]] is None:
                    self.values[some[i]] = []
                self.values[some[i]].append((k, v))
        self.ends.update(t for t in new if SENTENCE.search(t))
        for token, xs in of.items():
            self.known[token] = [kv for x in xs for kv in self.values[x] or ()] or None

    def documents(self, texts: list[str]) -> list[list[np.ndarray]]:
        """For every text, the kernel rows of its sentences that have a word like a landmark;
        spelled-out words are sentences of their own."""
        tokens = [set(t.split()) for t in texts]
        spelled = [spelled_out(t) for t in texts]
        self.learn(set().union(*tokens, *spelled))
        known, out = self.known, []
        for text, some, alone in zip(texts, tokens, spelled, strict=True):
            rows = []
            if any(known[t] for t in some):
                # only tokens like a landmark matter; two of them share a sentence if none from the
                # first to before the second ends one
                every = text.split()
                at = [i for i, token in enumerate(every) if known[token]]
                groups = [[every[at[0]]]]
                for i, j in zip(at, at[1:]):
                    if self.ends.isdisjoint(every[i:j]):
                        groups[-1].append(every[j])
                    else:
                        groups.append([every[j]])
                rows += [self._row(g) for g in groups]
            rows += [r for w in alone if (r := self._row([w])) is not None]
            out.append(rows)
        return out

    def _row(self, tokens: list[str]) -> np.ndarray | None:
        hits = [kv for t in tokens for kv in self.known[t] or ()]
        if not hits:
            return None
        row = np.zeros(len(self.kernel.words), np.float32)
        for k, v in hits:
            row[k] = max(row[k], v)
        return row


_scorers: dict[tuple[Settings, tuple[str, ...]], Scorer] = {}


def scorer_of(words: list[str], settings: Settings) -> Scorer:
    """The worker's scorer of these landmarks, kept from task to task; one at a time."""
    key = settings, tuple(words)
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(words, settings)
    return _scorers[key]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text, toxic of the sample: at most ``train_rows`` documents per class, of rows that share a
    doc_id the one with the least text."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    sample = None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(
            settings.train_rows)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * train_rows rows of two numbers
    sample = F.broadcast(sample.select(F.col("doc_id").alias("_doc"), "toxic"))
    return (docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
            .join(sample, F.col("doc_id") == F.col("_doc")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .select("doc_id", "text", "toxic"))


def landmark_words(rows: DataFrame, settings: Settings) -> list[str]:
    """Words whose document counts differ most between the classes, in standard errors;
    one that is much like a better one is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted({w for t in {*text.split(), *spelled_out(text)} for w in pieces(t, settings.word)})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())],
                                                 names=["word", "toxic"])

    counts = (rows.select("text", "toxic").mapInArrow(run, "word string, toxic int").groupBy("word")
              .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    score = (F.col("bad") - F.col("good")) / F.sqrt(F.col("bad") + F.col("good") + 1)
    best = (counts.where((F.col("bad") >= settings.min_docs) & (F.col("bad") > 3 * F.col("good")))
            .orderBy(score.desc(), "word").limit(8 * settings.landmarks).collect())
    chosen: list[str] = []
    for word in (r["word"] for r in best):
        if len(chosen) < settings.landmarks and not (
                chosen and (Kernel(chosen, settings).rows([word])[2] > settings.alike).any()):
            chosen.append(word)
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Linear SVM (hinge loss, classes weighted alike) by dual coordinate descent."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    alpha, w, norm = np.zeros(len(y)), np.zeros(x.shape[1]), (x * x).sum(1)
    rng = np.random.default_rng(3)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(y)).tolist():
            new = min(max(alpha[i] + (1 - y[i] * (x[i] @ w)) / norm[i], 0), settings.c * weight[i])
            w += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    small_batches(docs.sparkSession, 200)
    rows = materialize(training_rows(docs, labels, settings))
    words = landmark_words(rows, settings)
    model = Model(settings, words)
    if not words:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(words, settings)
        none = np.zeros(len(words), np.float32)
        for batch in batches:
            # the sentences most like the landmarks stand for their document, a bounded number of rows
            best = [sorted(found, key=lambda r: (-float(r.sum()), r.tobytes()))[:settings.sentences] or [none]
                    for found in scorer.documents(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b"".join(r.tobytes() for r in rows) for rows in best], pa.binary()), batch.column(1)],
                names=["rows", "toxic"])

    got = sorted((r["toxic"], bytes(r["rows"])) for r in rows.select("text", "toxic").mapInArrow(
        run, "rows binary, toxic int").collect())  # at most 2 * train_rows * sentences rows
    if len({toxic for toxic, _ in got}) < 2:
        return model
    parts = [np.frombuffer(r, np.float32).reshape(-1, len(words)).astype(float) for _, r in got]
    k = np.concatenate(parts)
    y = np.repeat([1.0 if toxic else -1.0 for toxic, _ in got], [len(x) for x in parts])
    # Nyström: landmarks against landmarks, and the inverse root that maps kernel rows to features
    i, j, v = Kernel(words, settings).rows(words)
    gram = np.zeros((len(words), len(words)))
    gram[i, j] = v
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    w, model.bias = _svm(k @ root, y, settings)
    model.weights = root @ w
    # a sigmoid over the training margins makes scores of them
    margin = np.array([max(0.0, (x @ model.weights).max()) for x in parts]) + model.bias
    y = np.array([1.0 if toxic else -1.0 for toxic, _ in got])
    a, b = 1.0, 0.0
    for _ in range(200):
        prob = 1 / (1 + np.exp(-(a * margin + b)))
        miss = prob - (y > 0)
        a, b = max(0.05, a - 0.5 * float((miss * margin).mean()) - 1e-3 * a), b - 0.5 * float(miss.mean())
    model.slope, model.shift = a, b
    return model


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_sentences long"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every document's whole text: one row per input row, no shuffle."""
    small_batches(docs.sparkSession, 200)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model.words, model.settings) if len(model.weights) else None
        for batch in batches:
            scores, hits = [], []
            texts = batch.column(2).to_pylist()
            for rows in scorer.documents(texts) if scorer else [[]] * len(texts):
                hits.append(len(rows))
                margin = max([0.0, *(float(r @ model.weights) for r in rows)]) + model.bias
                scores.append(1 / (1 + np.exp(-(model.slope * margin + model.shift))) if scorer else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(hits, pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "n_sentences"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"),
                       text_column().alias("text")).mapInArrow(run, SCHEMA)
