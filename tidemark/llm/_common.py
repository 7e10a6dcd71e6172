"""Helpers shared by the operators: table access, batch sizes, byte-level words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Rows handed to Python at once. Documents average a few kB, so a batch stays a few MB.
ARROW_ROWS = 1000

#: Bytes of text that the numpy kernels look at in one go.
BLOCK = 1 << 20

#: The word pattern of the contracts, for Java and RE2 alike: no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Keep Arrow batches small: a batch of whole documents must fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def width(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for; bucket counts follow it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def settle(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``materialize``, then as few partitions as hold about ``rows`` rows each.

    A frame that fits one partition is joined and grouped with others like it without any
    shuffle, so rounds over few rows don't each write a file per pair of tasks.
    """
    out = materialize(df)
    return out.coalesce(max(1, -(-out.count() // rows)))


def text_column(name: str = "text") -> Column:
    """Text with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_keys(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns, which place holds a null included; together they stand for a row."""
    parts = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


# ------------------------------------------------------------------ hashing kernels

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the polynomial base modulo 2**64, and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        def build(base: int) -> np.ndarray:
            p = np.full(n, np.uint64(base))
            p[0] = 1
            return np.multiply.accumulate(p)
        built = build(_STEP), build(pow(_STEP, -1, 1 << 64))
        if n > 2 * BLOCK:  # one huge token: do not keep its tables
            return built
        _powers = built
    return _powers


def _block_words(buf: np.ndarray, lower: bool, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of one block that cuts no word."""
    solid = ~space[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    up, down = power_tables(len(buf) + 1)
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[_LOWER[buf] if lower else buf] * up[:len(buf)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, hashes


def words(buf: np.ndarray, lower: bool = False,
          space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word in ``buf`` (UTF-8 bytes).

    Words are maximal runs without a byte of ``space`` (ASCII white space). The hash is a
    polynomial over the word's bytes (A-Z folded when ``lower``), so it does
    not depend on where the word stands. Memory follows one block, not the
    text: blocks are cut after a byte of ``space``.
    """
    parts, at, n = [], 0, len(buf)
    while at < n:
        end = min(n, at + BLOCK)
        while end < n and not space[buf[end - 1]]:
            gap = np.flatnonzero(space[buf[end:end + BLOCK]])
            end = end + int(gap[0]) + 1 if len(gap) else min(n, end + BLOCK)
        s, e, h = _block_words(buf[at:end], lower, space)
        parts.append((s + at, e + at, h))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one buffer, a line feed after each, and where each begins (n + 1 offsets)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8), starts


def batches_of_bytes(rows: Iterator[tuple], limit: int = BLOCK) -> Iterator[list[tuple]]:
    """Group rows (text bytes first) until about ``limit`` bytes; a longer text stands alone."""
    group, size = [], 0
    for row in rows:
        if group and size + len(row[0]) > limit:
            yield group
            group, size = [], 0
        group.append(row)
        size += len(row[0])
    if group:
        yield group


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (order matters)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[i:i + n]
    return mix(out)
