"""One-permutation MinHash fingerprints with optimal densification and b-bit packing.

Column expressions only. Words are hashed once, shingles of ``k`` words are
hashes of word hashes, and the same 64-bit hash gives a shingle's bin (top
bits) and its value. Sorting a document's shingle hashes leaves the least value of every
filled bin at the bin's first place. An empty bin borrows from the first
filled bin of its own seeded probe sequence, as in optimal densification: the
sequence depends on the bin and the attempt, not on the set, so equal sets of
filled bins borrow alike. The low ``BITS`` bits of every bin (hashed with
its number) are stored as hex. Likeness is the share of equal bins, corrected for the chance that
different values agree in their low bits.

Defined cases: null text counts as empty; a text without words has the
fingerprint ``EMPTY``, like 1 to another such text and 0 to any other; fewer
than ``k`` words are one shingle; rows with equal or null doc_id keep a fixed
order by text; an empty table gives no rows.
"""

from __future__ import annotations

import json
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import text_column, width

SHINGLE = 5
BINS = 256               # by the top byte of a hash
BITS = 8                 # kept of each bin: two hex digits
PROBES = (8, 24, 96, 512)  # attempts made at a time; the last resort is the first filled bin
SPACES = r"[\x20\x09-\x0D]+"
EMPTY = "-"


BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _range(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _bin(hash_: Column) -> Column:
    return F.shiftright(hash_, 56)


def _constant(value: list, kind: str) -> Column:
    """A table as one literal that the optimizer folds, instead of a tree node for every entry."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _probe(b: Column, attempt: Column) -> Column:
    """The bin that bin ``b`` asks at an attempt: uniform, the same for every set."""
    return F.pmod(F.xxhash64(b, attempt), F.lit(BINS)).cast("int")


def _near_probes() -> Column:
    """The first attempts of every bin, made by rule (an affine hash of bin and attempt)."""
    made = [[((b * 0x9E3779B1 + t * 0x85EBCA6B + 0x27D4EB2F) * 0xC2B2AE35 >> 17) % BINS for t in range(PROBES[0])]
            for b in range(BINS)]
    return _constant(made, "array<array<int>>")


def with_bins(df: DataFrame, text: str, name: str, k: int = SHINGLE) -> DataFrame:
    """``df`` with column ``name``: the low bits of the ``BINS`` bins of column ``text``
    (null without a word). Steps are projections of their own, each used more
    than once by the next, so that no array is built again for every element."""
    h, s, v = (f"_{name}_{x}" for x in "hsv")
    trimmed = F.btrim(F.col(text), F.lit(BLANKS))
    out = df.withColumn(h, F.when(trimmed != "", F.transform(F.split(trimmed, SPACES), lambda x: F.xxhash64(x))))
    n, at = F.size(h), F.col(h)
    # the largest value of every bin marks it: sorted, each bin has a first entry, and one that is its mark is empty
    mark = (1 << 56) - 1
    marks = _constant([(b << 56 | mark) - (1 << 63) for b in range(BINS)], "array<bigint>")
    out = out.withColumn(s, F.sort_array(F.concat(marks, F.when(n >= k, F.transform(
        F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(at, i + j) for j in range(k)])))
        .otherwise(F.array(F.xxhash64(n, at))))))
    values = F.col(s)
    first = F.filter(values, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(values, i - 1))))
    out = out.withColumn(v, F.when(F.col(h).isNotNull(), F.transform(first, lambda x: F.when(
        x.bitwiseAND(_long(mark)) != _long(mark), x))))
    held = F.col(v)

    def first_filled(probes: Column) -> Column:
        return F.get(F.filter(F.transform(probes, lambda q: F.get(held, q)), lambda x: x.isNotNull()), F.lit(0))

    def borrowed(b: Column) -> Column:
        tries, done = [first_filled(F.get(_near_probes(), b))], PROBES[0]
        for count in PROBES[1:]:
            tries.append(first_filled(F.transform(F.sequence(F.lit(done), F.lit(done + count - 1)),
                                                  lambda attempt: _probe(b, attempt))))
            done += count
        return F.coalesce(*tries, F.get(F.filter(held, lambda x: x.isNotNull()), F.lit(0)))

    # each bin hashes its value once more, so that bins with one borrowed value don't all agree by one chance
    out = out.withColumn(name, F.when(held.isNotNull(), F.transform(
        held, lambda x, b: F.xxhash64(F.coalesce(x, borrowed(b)), b).bitwiseAND(_long((1 << BITS) - 1)).cast("int"))))
    return out.drop(h, s, v)


def packed(bins: str) -> Column:
    """The fingerprint: bins in hex, or ``EMPTY``."""
    digits = _constant([f"{v:0{BITS // 4}x}" for v in range(1 << BITS)], "array<string>")
    text = F.concat_ws("", F.transform(bins, lambda v: F.get(digits, v)))
    return F.when(F.col(bins).isNotNull(), text).otherwise(F.lit(EMPTY))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two bin columns."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    chance = 2.0 ** -BITS
    return (F.when(F.col(a).isNull() & F.col(b).isNull(), F.lit(1.0))
            .when(F.col(a).isNull() | F.col(b).isNull(), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))))


def _slices(docs: DataFrame) -> DataFrame:
    """Texts with ``slice``: ranges of doc_id of about equal rows, the highest ids in the last.

    Cuts are quantiles from one mergeable sketch: as many longs as there are slices.
    Documents without an id come after all others, in slices by text hash.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).withColumn("tie", F.xxhash64("text"))
    n = max(2, width(docs.sparkSession))
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []))
    step = max(1, isqrt(len(cuts)))

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda cut: cut <= F.col("doc_id")))

    if cuts:
        every = _constant(cuts, "array<bigint>")
        coarse = passed(_constant(cuts[step - 1::step], "array<bigint>")) * step
        found = rows.withColumn("_coarse", coarse).withColumn(
            "slice", F.col("_coarse") + passed(F.slice(every, F.col("_coarse") + 1, step))).drop("_coarse")
    else:
        found = rows.withColumn("slice", F.lit(0))
    return found.withColumn("slice", F.when(F.col("doc_id").isNull(), F.shiftright("tie", 56) - 1000)
                            .otherwise(F.col("slice")).cast("long"))


def edited_fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    The next document is the next lower doc_id (ties by text hash, then text;
    null ids last; after the last the first). Texts are shuffled once, by
    id range. Within a range a window finds the next row; a range's last row takes
    the first row of the next range from a table with one row per range.
    """
    rows = _slices(docs).repartition("slice")
    heads = rows.groupBy("slice").agg(F.max(F.struct("doc_id", "tie", "text")).alias("head")).select(
        F.col("slice").alias("_slice"), F.col("head.text").alias("head"))
    after = Window.orderBy(F.col("_slice").desc())
    whole = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = with_bins(heads, "head", "head_bins", k)
    heads = heads.select("_slice", *[F.coalesce(F.lead(x).over(after), F.first(x).over(whole)).alias(x)
                                     for x in ("head", "head_bins")])
    order = Window.partitionBy("slice").orderBy(F.col("doc_id").desc_nulls_last(), F.col("tie").desc(),
                                                F.col("text").desc())
    out = with_bins(rows, "text", "bins", k)
    out = (out.withColumn("_next", F.lead(F.struct("text", "bins")).over(order))
           .join(heads, F.col("slice") == F.col("_slice"), "left")
           .withColumn("next_text", F.when(F.col("_next").isNull(), F.col("head")).otherwise(F.col("_next.text")))
           .withColumn("next_bins", F.when(F.col("_next").isNull(), F.col("head_bins")).otherwise(F.col("_next.bins")))
           .withColumn("n_chars", F.length("text").cast("long"))
           .withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int")))
    out = out.withColumn("edited", F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - F.col("_half")),
        F.substr("next_text", F.lit(1), F.col("_half"))))
    out = with_bins(out.drop("head", "head_bins", "_next", "next_text", "text"), "edited", "edited_bins", k)
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      packed("bins").alias("fingerprint"), packed("edited_bins").alias("edited_fingerprint"),
                      likeness("bins", "edited_bins").alias("near_edited"),
                      likeness("bins", "next_bins").alias("near_next"))
