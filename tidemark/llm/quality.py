"""Quality rules with adaptive thresholds per language and source.

Per document, word and line statistics (numpy kernels inside tasks). The
fixed rules (too few words, too much repeated text) come first. Everything
else is judged against its own kind: quantiles of each rate come from
mergeable sketches (``approx_percentile`` merges partial sketches before the
shuffle), one per (lang, source) and one per lang; a document falls out when a rate
lies beyond an upper or lower fence of its group. Groups with fewer than
``min_group`` documents use their language's fences, small languages those
of all documents.

Defined cases: null text counts as empty; null lang or source form a group
of their own; repeated rows each get a row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import (_SPACE, batches_of_bytes, joined, mix, small_batches, text_column, utf8,
                                  window_hashes, words)
from tidemark.session import materialize

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS_SCHEMA = ("doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                "n_lines long, n_dup_lines long, n_repeat_words long, n_distinct_words long")


@dataclass(frozen=True)
class Rules:
    """Fence rule: beyond quartile ± ``reach`` × max(interquartile range, the rate's slack)."""

    reach: float = 4.0
    accuracy: int = 1000
    min_group: int = 50


#: Rate name -> (expression over the statistics, least spread, check below too).
RATES: dict[str, tuple[str, float, bool]] = {
    "symbols_per_word": ("try_divide(n_symbols, n_words)", 0.05, False),
    "chars_per_word": ("try_divide(word_chars, n_words)", 0.75, True),
    "dup_lines": ("try_divide(n_dup_lines, n_lines)", 0.08, False),
    "repeat_words": ("try_divide(n_repeat_words, n_words)", 0.05, False),
}


def _line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def text_stats(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The statistics of each text; one pass of array work over all of them."""
    buf, offsets = joined(texts)
    n = len(texts)
    starts, _, hashes = words(buf)
    owner = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(owner, minlength=n)
    solid = ~_SPACE[buf] & ((buf & 0xC0) != 0x80)
    chars = np.add.reduceat(solid.astype(np.int64), offsets[:-1])
    symbols = np.add.reduceat(_SYMBOL[buf].astype(np.int64), offsets[:-1])
    repeat = np.zeros(n, np.int64)
    if len(hashes) >= WINDOW:
        win = window_hashes(hashes, WINDOW)
        first = owner[:len(win)]
        inside = np.flatnonzero(first == owner[WINDOW - 1:])
        key = mix(win[inside] + first[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = inside[count[back] > 1]
        size = len(hashes) + 1
        cover = np.bincount(twice, minlength=size) - np.bincount(twice + WINDOW, minlength=size)
        repeat = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)
    key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    distinct = np.bincount(owner[np.unique(key, return_index=True)[1]], minlength=n)
    lines = np.array([_line_counts(t) for t in texts], np.int64).reshape(n, 2)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_lines": lines[:, 0],
            "n_dup_lines": lines[:, 1], "n_repeat_words": repeat, "n_distinct_words": distinct}


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statistics of the text in the fourth column; the columns beside it are handed on."""
    for batch in batches:
        rows = zip(utf8(batch.column(3)), range(batch.num_rows), strict=True)
        for group in batches_of_bytes(rows):
            at = pa.array([i for _, i in group])
            stats = text_stats([t for t, _ in group])
            names = batch.schema.names
            beside = [k for k in range(len(names)) if k != 3]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(at) for k in beside[:3]] + [pa.array(v.astype(np.int64)) for v in stats.values()]
                + [batch.column(k).take(at) for k in beside[3:]],
                names=[*names[:3], *stats, *(names[k] for k in beside[3:])])


def document_stats(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """Word and line statistics of every document (``STATS_SCHEMA``), with the row itself as ``row`` on demand."""
    small_batches(docs.sparkSession)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []
    schema = STATS_SCHEMA + (f", row {docs.schema.simpleString()}" if whole_rows else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
                       text_column().alias("text"), *row).mapInArrow(_stats_batches, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _fences(stats: DataFrame, keys: list[str], prefix: str, rules: Rules) -> DataFrame:
    """Quartiles of every rate per group, from sketches merged across tasks."""
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_n")]
    for name, (expr, _, _) in RATES.items():
        aggs.append(F.percentile_approx(F.expr(expr), [0.25, 0.75],
                                        rules.accuracy).alias(f"{prefix}_{name}"))
    return stats.where(~base_failed()).groupBy(*[F.col(k).alias(f"{prefix}_{k}") for k in keys]).agg(*aggs)


def _beyond(name: str, rules: Rules) -> Column:
    expr, slack, below = RATES[name]
    rate = F.expr(expr)
    q = (F.when(F.coalesce(F.col("g_n"), F.lit(0)) >= rules.min_group, F.col(f"g_{name}"))
         .when(F.coalesce(F.col("l_n"), F.lit(0)) >= rules.min_group, F.col(f"l_{name}"))
         .otherwise(F.col(f"a_{name}")))
    spread = F.greatest(q[1] - q[0], F.lit(slack)) * rules.reach
    out = rate > q[1] + spread
    return (out | (rate < q[0] - spread)) if below else out


def judged(stats: DataFrame, rules: Rules = Rules(), basis: DataFrame | None = None) -> DataFrame:
    """Statistics plus ``base_failed`` and ``kept``; thresholds from ``basis`` (the same statistics by default).

    The threshold tables have a row per group, per language and one in all;
    their joins are left to the optimizer, which broadcasts them only below
    the session's size limit and otherwise splits hot groups (skew join).
    """
    basis = stats if basis is None else basis
    out = (stats
           .join(_fences(basis, ["lang", "source"], "g", rules),
                 F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
           .join(_fences(basis, ["lang"], "l", rules), F.col("lang").eqNullSafe(F.col("l_lang")), "left")
           # one row on the right: a single aggregate
           .join(F.broadcast(_fences(basis, [], "a", rules)), F.lit(True), "left"))
    odd = reduce(lambda a, b: a | b, [F.coalesce(_beyond(name, rules), F.lit(False)) for name in RATES])
    return out.select(*stats.columns, base_failed().alias("base_failed"), (~base_failed() & ~odd).alias("kept"))


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Statistics and verdict of every document (one row per input row)."""
    return judged(materialize(document_stats(docs)), rules)


def kept_rows(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that the rules keep, all columns: each row is judged by itself, whatever its doc_id.

    The thresholds come first, from the statistics alone; then one pass over the rows filters them.
    """
    basis = materialize(document_stats(docs))
    return judged(document_stats(docs, whole_rows=True), rules, basis).where("kept").select("row.*")
