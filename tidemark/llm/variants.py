"""Spelling variants: words one edit apart, grouped under their commonest form.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: their common prefix and common suffix together then reach the
longer length minus one. Words meet by what such an edit leaves alone. For the
shorter length m, the places 0..m-1 are cut into ``parts`` intervals; if the edit lies in
interval [lo, hi), both words have the same first lo and the same last m - hi code
points, so (m, lo, hi, these) is the key under which they meet. The edit's place
is the length of the common prefix (m - 1 at most), which lies in exactly one
interval: every pair is found once, and is counted without removing repeats.

Within a key, words are laid into padded code-point matrices and compared tile by
tile, every row of a block with every row of another, column by column. Keys with more than
``hot`` words are cut at finer intervals, again and again, down to a single
place; there only words that agree everywhere else remain (one code point is free, two in the
longer words), so a key's words are bounded by the alphabet and not by their number.

Only sums leave a tile: near words per word and the best of them. No pair is written.

Defined cases: null and empty texts have no word; a null doc_id reads as empty
in the hash of ``noisy_words``; repeated rows count again; ties of n go to the word first in code-point
order; very long words cost a matrix as wide as they are, in blocks of bounded size; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import text_column, width
from tidemark.session import materialize


@dataclass(frozen=True)
class Spelling:
    letters: int = 7         # code points of a word at least
    count: int = 2           # occurrences of a word at least
    ratio: int = 10          # a form occurs at least so many times as often as its variant
    parts: int = 3           # intervals of the edit's place
    hot: int = 4000          # words of a key beyond which its interval is halved
    bucket_rows: int = 200_000  # key rows of a task
    tile: int = 256          # rows of a block
    cells: int = 1 << 20     # code points compared in one go


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs(text: Column, letters: int) -> Column:
    """Maximal runs of at least ``letters`` Latin letters."""
    return F.regexp_extract_all(text, F.lit("([A-Za-zÀ-ÿ]{%d,})" % letters), F.lit(1))


def noisy_words(docs: DataFrame, settings: Spelling = Spelling(), one_in: int = 31) -> DataFrame:
    """word, n: lower-cased runs of the texts, one run in ``one_in`` (by hash) short of a code point.

    Runs under ``letters`` code points cannot become words and are never made.
    """
    run = F.translate("run", UPPER, LOWER)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(_runs(text_column(), settings.letters)).alias("run")).select("id", run.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (rows.withColumn("h", h).select(F.when(F.col("h") % one_in == 0, short).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= settings.letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= settings.count))


# ------------------------------------------------------------------ keys

def _key(word: Column, base: Column, lo: Column, hi: Column) -> Column:
    tail = base - hi
    return F.xxhash64(base, lo, hi, word.substr(F.lit(1), lo), word.substr(F.length(word) - tail + 1, tail))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, base, lo, hi) with their key."""
    return rows.withColumn("key", _key(F.col("word"), F.col("base"), F.col("lo"), F.col("hi")))


def _first_keys(words: DataFrame, parts: int) -> DataFrame:
    """(word, n, base, lo, hi, key) of every word: as the shorter of a pair and as the longer one."""
    cuts = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(
        F.floor(F.col("base") * i / parts).cast("int").alias("lo"),
        F.floor(F.col("base") * (i + 1) / parts).cast("int").alias("hi")))
    bases = F.explode(F.array(F.length("word"), F.length("word") - 1))
    return _keyed(words.select("word", "n", bases.alias("base")).where("base > 0")
                  .select("word", "n", "base", F.explode(cuts).alias("cut"))
                  .select("word", "n", "base", "cut.lo", "cut.hi").where("lo < hi"))


def _split_keys(rows: DataFrame) -> DataFrame:
    """The rows with their interval halved."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi"))))
    return _keyed(rows.select("word", "n", "base", halves.alias("half")).select("word", "n", "base", "half.lo", "half.hi"))


def _bounded_keys(words: DataFrame, settings: Spelling) -> DataFrame:
    """Key rows whose keys hold at most ``hot`` words, or a single place."""
    done, rows = None, _first_keys(words, settings.parts)
    while True:
        hot = materialize(rows.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("size"),
                                                                       F.max(F.col("hi") - F.col("lo")).alias("free"))
                          .where((F.col("size") > settings.hot) & (F.col("free") > 1)).select("_key"))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(hot, F.col("key") == F.col("_key"), "left_anti")
        done = rest if done is None else done.unionByName(rest)
        rows = materialize(_split_keys(rows.join(hot, F.col("key") == F.col("_key"), "left_semi")))


# ------------------------------------------------------------------ tiles

def code_points(words: list[str], wide: int) -> np.ndarray:
    """Padded code-point matrix, a row per word, 0 after its end; as narrow as the code points allow."""
    codes = np.array(words, f"<U{wide}").view(np.uint32).reshape(len(words), wide)
    top = int(codes.max()) if codes.size else 0
    return codes.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _tiles(sizes: np.ndarray, shorter: np.ndarray, tile: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Block pairs of all groups, by padded block size: rows of each block, -1 beyond its end.

    A group has ``shorter`` rows of base length, then the longer ones; left blocks are of the former.
    """
    begin = np.cumsum(sizes) - sizes
    out: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

    def put(t: int, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray) -> None:
        place = np.arange(t)
        both = out.setdefault(t, ([], []))
        for rows, at, n in ((both[0], left, n_left), (both[1], right, n_right)):
            rows.append(np.where(place < n[:, None], at[:, None] + place, -1))

    able = (sizes > 1) & (shorter > 0)
    t = 2
    while t <= tile:  # whole groups, padded to the next power of two
        at = np.flatnonzero(able & (sizes <= t) & (sizes > t // 2))
        if len(at):
            put(t, begin[at], shorter[at], begin[at], sizes[at])
        t *= 2
    for g in np.flatnonzero(able & (sizes > t // 2)).tolist():  # larger ones, every block against every other
        left, right = np.arange(0, shorter[g], tile), np.arange(0, sizes[g], tile)
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        put(tile, begin[g] + i, np.minimum(shorter[g] - i, tile), begin[g] + j, np.minimum(sizes[g] - j, tile))
    return {t: (np.concatenate(x), np.concatenate(y)) for t, (x, y) in out.items()}


def near_pairs(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of one edit among the tiles ``x`` by ``y`` (row numbers, -1 for none).

    ``left`` and ``right`` are the words' code points set at the left and at the right margin; the
    words of ``x`` have the base length, those of ``y`` that or one more; lo and hi bound the edit's place.
    """
    shape = (len(x), x.shape[1], y.shape[1])
    small = np.uint8 if left.shape[1] < 255 else np.int32
    total = []
    for codes, order in ((left, range(left.shape[1])), (right, range(right.shape[1] - 1, -1, -1))):
        alive, common = np.ones(shape, bool), np.zeros(shape, small)
        for c in order:
            column = codes[:, c]
            alive &= column[x][:, :, None] == column[y][:, None, :]
            common += alive
        total.append(common)
    base = lengths[x][:, :, None]
    longer = np.maximum(base, lengths[y][:, None, :])
    prefix, suffix = np.minimum(total[0], base), np.minimum(total[1], base)  # padding equals padding
    near = (prefix.astype(np.int64) + suffix >= longer - 1) & (prefix < longer)
    place = np.minimum(prefix, base - 1)
    near &= (place >= lo[x][:, :, None]) & (place < hi[x][:, :, None])
    near &= (x >= 0)[:, :, None] & (y >= 0)[:, None, :]
    g, i, j = np.nonzero(near)
    return x[g, i], y[g, j]


def _best(who: np.ndarray, count: np.ndarray, other: np.ndarray, n: np.ndarray,
          rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: sum of counts, and of the others that with the largest n, ties by rank."""
    order = np.lexsort((rank[other], -n[other], who))
    who, count, other = who[order], count[order], other[order]
    first = np.flatnonzero(np.diff(who, prepend=-1))
    return who[first], np.add.reduceat(count, first) if len(first) else count, other[first]


def _near_of_base(key: np.ndarray, words: list[str], n: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int,
                  settings: Spelling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, near words, row of the best) among key rows of one base length, sorted by key, shorter words first."""
    lengths = np.array([len(w) for w in words])
    left = code_points(words, base + 1)
    right = left.copy()
    short = lengths == base
    right[short, 1:], right[short, 0] = left[short, :-1], 0
    edge = np.flatnonzero(np.diff(key, prepend=key[0], append=key[-1]) != 0)
    edge = np.concatenate(([0], edge, [len(key)])) if len(key) else edge
    sizes = np.diff(edge)
    shorter = np.add.reduceat(short.astype(np.int64), edge[:-1])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    parts = [(np.zeros(0, np.int64),) * 3]
    for t, (x, y) in _tiles(sizes, shorter, settings.tile).items():
        step = max(1, settings.cells // (t * t))
        for at in range(0, len(x), step):
            i, j = near_pairs(left, right, lengths, lo, hi, x[at:at + step], y[at:at + step])
            back = lengths[j] > base  # pairs of base length come both ways by themselves
            i, j = np.concatenate((i, j[back])), np.concatenate((j, i[back]))
            parts.append(_best(i, np.ones(len(i), np.int64), j, n, rank))
    return _best(*(np.concatenate(p) for p in zip(*parts, strict=True)), n, rank)


def near_words(words: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """word, n_near, best, best_n of every word that has near words. ``words`` (word, n): each word once."""
    buckets = max(width(words.sparkSession),
                  -(-2 * settings.parts * words.count() // settings.bucket_rows))

    def run(table: pa.Table) -> pa.Table:
        table = table.append_column("length", pa.array([len(w) for w in table.column("word").to_pylist()], pa.int64()))
        table = table.sort_by([("base", "ascending"), ("key", "ascending"), ("length", "ascending")])
        text = table.column("word").to_pylist()
        key, n, lo, hi, base = (table.column(c).to_numpy() for c in ("key", "n", "lo", "hi", "base"))
        edges = np.flatnonzero(np.diff(base, prepend=-1))
        out: tuple[list, ...] = ([], [], [], [])
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(text)], strict=True):
            some = text[a:b]
            row, count, best = _near_of_base(key[a:b], some, n[a:b], lo[a:b], hi[a:b], int(base[a]), settings)
            for column, values in zip(out, ([some[i] for i in row.tolist()], count.tolist(),
                                            [some[i] for i in best.tolist()], n[a:b][best].tolist()), strict=True):
                column.extend(values)
        return pa.table(dict(zip(("word", "n_near", "best", "best_n"), (
            pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
            pa.array(out[3], pa.int64())), strict=True)))

    rows = _bounded_keys(words, settings).select(
        F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), "key", "base", "lo", "hi", "word", "n")
    found = rows.groupBy("bucket").applyInArrow(run, "word string, n_near long, best string, best_n long")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("first"))
            .select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.minus")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow from ``word`` (word, form).

    Forms grow in n, so there is no ring; each round doubles the steps taken and is cut with a checkpoint.
    """
    ahead = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = ahead.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = materialize(ahead.join(on, F.col("root") == F.col("_word"), "left")
                           .select("word", F.coalesce("_root", "root").alias("root"), F.col("_word").isNotNull().alias("moved")))
        ahead = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ahead


def spelling_variants(words: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n): each word once."""
    words = materialize(words.select("word", "n"))
    near = near_words(words, settings)
    able = F.col("best_n") >= settings.ratio * F.col("n")
    table = materialize(words.join(near.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").select(
        "word", F.when(able, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(able, F.col("best_n")).alias("form_n")))
    root = roots(table.where("form is not null")).select(F.col("word").alias("_of"), "root")
    return (table.join(root, F.col("word") == F.col("_of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
