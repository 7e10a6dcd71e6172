"""Mix sources to target weights by Sainte-Laguë apportionment.

Sources in code point order (null last) weigh 1, 2, 3, repeating, and share
all words by weight; no target exceeds ``MAX_EPOCHS`` times its source, the
excess going to the others by weight. Targets are paid in blocks of ``block``
words: the highest quotients w / (2 k + 1) win the seats, first among sources,
then among the shards of each source. A shard is a hash slice of a source of
about ``shard_words`` words or ``shard_rows`` rows, whichever is less, so no source is ever ordered as
a whole; the hash covers all columns, so rows that share a doc_id (or have none) are spread. In a
shard the documents stand in seeded order; its quota takes whole passes over
the shard and then the first blocks of that order.

Native column expressions throughout. Single-task windows run only over the
source table (one row per source).

Defined cases: null text has size 0 and is never taken; a null source is a
source; a null doc_id is an id like others; repeated rows are mixed as separate documents (equal ones stand in
one shard); very long texts are counted whole; an empty table, or one without any word, takes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import WORD, row_keys, text_column
from tidemark.session import materialize

BLOCK_WORDS = 32
SHARD_WORDS = 1 << 22
SHARD_ROWS = 1 << 14
MAX_EPOCHS = 3
WEIGHT_CYCLE = 3
SEED = "mix-1"


def document_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size in words, the row's keys and its seeded place; texts go no further."""
    key, key2 = row_keys(docs)
    return docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.regexp_count(text_column(), F.lit(WORD)).cast("long").alias("size"), key.alias("key"), key2.alias("key2")
    ).withColumn("place", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("key").cast("string"))))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Size, weight and target of every source (water filling in closed form).

    Sources are taken by ascending limit per weight: those before the first
    that its share does not fill are at their limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    limit = F.lit(max_epochs) * F.col("source_size")
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), F.col("source_rank"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
            .withColumn("source_rank", F.row_number().over(by_name))
            .withColumn("weight", 1 + (F.col("source_rank") - 1) % WEIGHT_CYCLE)
            .withColumn("total", F.sum("source_size").over(everything))
            .withColumn("left_words", F.col("total") - F.coalesce(F.sum(limit).over(before), F.lit(0)))
            .withColumn("left_weight", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("level", F.col("left_words") / F.col("left_weight"))
            .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= limit, F.col("level")))
                        .over(everything))
            .withColumn("target", F.least(limit.cast("double"), F.col("level") * F.col("weight")))
            .select("source", "source_rank", "source_size", "source_rows", "target", "total"))


def sainte_lague(units: DataFrame, group: list[str], unit: list[str], weight: str, seats: str) -> DataFrame:
    """``units`` with ``quota``: the seats of each group shared out by highest quotients.

    Rounding w × seats / W gives the quotas of a divisor close to the right
    one, off by at most half a seat per unit. The seats still to give (or to
    take back) are the next highest (or the lowest awarded) quotients; each
    unit offers as many as its share of them, plus two. Ties go to the unit
    that comes first.
    """
    whole = Window.partitionBy(*group)
    share = F.try_divide(F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(whole))
    based = (units.withColumn("_share", F.coalesce(share, F.lit(0.0)))
             .withColumn("_base", F.floor(F.col("_share") * F.col(seats) + 0.5).cast("long"))
             .withColumn("_short", F.when(F.sum(F.col(weight).cast("double")).over(whole) > 0, F.col(seats)
                                          - F.sum("_base").over(whole)).otherwise(F.lit(0)).cast("long")))
    offers = F.least(F.abs("_short"), F.ceil(2 * F.col("_share") * F.abs("_short")) + 2)
    step = F.explode(F.when(offers > 0, F.sequence(F.lit(1).cast("long"), offers.cast("long"))))
    offered = (based.select(*group, *unit, F.col(weight), "_base", "_short", step.alias("_j"))
               .withColumn("_seat", F.when(F.col("_short") > 0, F.col("_base") + F.col("_j") - 1)
                           .otherwise(F.col("_base") - F.col("_j")))
               .where("_seat >= 0")
               .withColumn("_quotient", F.col(weight) / (2 * F.col("_seat") + 1))
               .withColumn("_signed", F.when(F.col("_short") > 0, -F.col("_quotient")).otherwise(F.col("_quotient"))))
    ranked = offered.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*group).orderBy("_signed", *unit, "_j")))
    change = (ranked.where(F.col("_rank") <= F.abs("_short")).groupBy(*group, *unit)
              .agg(F.sum(F.signum("_short")).cast("long").alias("_change")))
    keys = [*group, *unit]
    renamed = change.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_change")
    on = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys]
    return (based.join(renamed, on, "left")
            .withColumn("quota", F.col("_base") + F.coalesce("_change", F.lit(0)))
            .select(*units.columns, "quota"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, passes, part, taken and row keys of every document.

    ``passes`` whole copies plus the first ``part`` words make up ``taken``.
    """
    sizes = materialize(document_sizes(docs, seed))
    sources = materialize(source_targets(sizes, max_epochs)
                          .withColumn("seats", F.round(F.col("target") / block).cast("long"))
                          .withColumn("all_seats", F.round(F.col("total") / block).cast("long"))
                          .withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words),
                                                              F.ceil(F.col("source_rows") / shard_rows))))
    quotas = sainte_lague(sources, ["all_seats"], ["source_rank"], "target", "all_seats").select(
        F.col("source").alias("_source"), "source_rank", "source_size", "target", "n_shards",
        F.col("quota").alias("source_quota"))
    placed = (sizes.join(quotas, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("shard", F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % F.col("n_shards")))
    shards = sainte_lague(
        placed.groupBy("source_rank", "shard").agg(F.sum("size").alias("shard_size"),
                                                   F.max("source_quota").alias("source_quota")),
        ["source_rank", "source_quota"], ["shard"], "shard_size", "source_quota").select(
        F.col("source_rank").alias("_rank"), F.col("shard").alias("_shard"), "shard_size",
        F.least(F.col("quota") * block, F.col("shard_size") * max_epochs).alias("shard_words"))
    ordered = Window.partitionBy("source_rank", "shard").orderBy("place", "doc_id", "size")
    start = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    return (placed.withColumn("start", F.coalesce(start, F.lit(0)))
            .join(shards, (F.col("source_rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard")))
            .withColumn("passes", F.coalesce(F.floor(F.try_divide("shard_words", "shard_size")), F.lit(0)).cast("long"))
            .withColumn("part", F.greatest(F.lit(0), F.least(
                F.col("size"), F.col("shard_words") - F.col("passes") * F.col("shard_size") - F.col("start"))))
            .select("doc_id", "source", "size", "source_size", "target", "passes", "part", "key", "key2",
                    (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row once per whole pass, plus the words of a partial one.

    A partial copy keeps its first ``part`` words, joined by blanks. Rows are told apart by all of their
    columns; equal rows meet before the shuffle, and together give the copies that each was given.
    A shard has one partial copy at most, so the list of a row's partial copies stays short.
    """
    part = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), F.col("part"))
    plan = (mix(docs, **options).where("taken > 0").groupBy("key", "key2")
            .agg(F.sum(F.col("passes") + (F.col("part") == F.col("size")).cast("long")).cast("int").alias("passes"),
                 F.collect_list(part).alias("parts"))
            .select(F.col("key").alias("_key"), F.col("key2").alias("_key2"), "passes", "parts"))
    key, key2 = row_keys(docs)
    rows = (docs.select(key.alias("key"), key2.alias("key2"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .groupBy("key", "key2").agg(F.first("row").alias("row")))
    whole = F.array_repeat(F.lit(None).cast("long"), F.col("passes"))
    copies = rows.join(plan, (F.col("key") == F.col("_key")) & (F.col("key2") == F.col("_key2"))).select(
        "row", F.explode(F.concat(whole, "parts")).alias("part"))
    field = {c: F.col("row").getField(c) for c in docs.columns}
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(field["text"], F.lit(WORD), F.lit(0)), 1,
                                   F.col("part").cast("int")))
    text = F.when(F.col("part").isNull(), field["text"]).otherwise(cut)
    out = {**field, "text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("part").isNull(), field["n_chars"]).otherwise(F.length(cut)).cast(
            docs.schema["n_chars"].dataType)
    return copies.select(*[column.alias(name) for name, column in out.items()])
