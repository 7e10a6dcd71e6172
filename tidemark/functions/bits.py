"""Activity over any number of periods as fixed-width bit words per user.

A user's active periods (numbered from 0) fold into words of ``WORD`` bits with
``bit_or``: one row per user with one bigint per word, combined map-side.
Users are then counted per (word, mask). A word has at most 2^(WORD + 1)
masks, so what follows the fold is bounded by the periods, not by the users.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 16


def n_words(periods: int) -> int:
    return -(-periods // WORD)


def fold(k: Column, words: int, overlap: int = 0) -> list[Column]:
    """Aggregates m0, m1, ...: word w holds periods w*WORD .. w*WORD + WORD - 1 + overlap.

    With an overlap of one bit a word knows the first period of the next, so a
    period and the one before it can always be read from one word.
    """
    one = F.lit(1).cast("bigint")
    out = []
    for w in range(words):
        i = (k - F.lit(w * WORD)).cast("int")
        inside = i.between(0, WORD - 1 + overlap)
        out.append(F.bit_or(F.when(inside, F.call_function("shiftleft", one, i))).alias(f"m{w}"))
    return out


def unfold(words: int) -> Column:
    """Generator of (word, mask) from the columns of ``fold``; empty words are left out."""
    pairs = F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"m{w}").alias("mask"))
                      for w in range(words)])
    return F.inline(F.filter(pairs, lambda p: p["mask"].isNotNull()))


def is_set(mask: str, i: Column) -> Column:
    return F.call_function("shiftright", F.col(mask), i).bitwiseAND(F.lit(1).cast("bigint")) == 1
