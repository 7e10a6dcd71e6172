"""Deterministic hash columns: user buckets and uniform draws.

Spark's ``xxhash64`` is signed and depends on the input width, so a plain
``xxhash64(user_id) % n`` is neither stable across integer widths nor
non-negative. The default here is the first 32 bits of an MD5 digest, which
any SQL engine reproduces exactly; ``xxhash64`` (with ``pmod``) is offered
where only speed matters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32


def md5_u32(*parts) -> Column:
    """Unsigned 32-bit integer (as bigint) from the MD5 of ``parts`` joined by ':'."""
    cols = [p if isinstance(p, Column) else F.col(p) if isinstance(p, str) else F.lit(p)
            for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def xx_u32(*parts) -> Column:
    """Unsigned 32-bit integer from ``xxhash64`` (faster, Spark-only)."""
    cols = [p if isinstance(p, Column) else F.col(p) if isinstance(p, str) else F.lit(p)
            for p in parts]
    return F.pmod(F.xxhash64(*cols), F.lit(TWO_32))


def uniform_u32(*parts, method: str = "md5") -> Column:
    if method == "md5":
        return md5_u32(*parts)
    if method == "xxhash64":
        return xx_u32(*parts)
    raise ValueError(f"unknown hash method {method!r}")


def hash_bucket(col: str | Column, n: int, method: str = "md5") -> Column:
    """Bucket in ``0 .. n-1`` from a hash of ``col``; independent of ``col % k`` arms."""
    return F.pmod(uniform_u32(col, method=method), F.lit(n)).cast("bigint")
