"""Pipeline stages row by row: null and repeated ids, columns of clashing names, and a whole run against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidemark.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("_kept", "_size", "_id", "_n", "row", "key", "part", "class", "_row", "kept", "place")


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9))) for _ in range(n))


def table(spark, rows):
    """(doc_id, text, source) with lang, n_chars and columns named like the operators' own."""
    full = [(d, t, "en", s, None if t is None else len(t), *[-i for i in range(len(CLASH))]) for d, t, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` long" for c in CLASH))


def test_quality_judges_every_row_by_itself(spark):
    good = [prose(60, i) for i in range(70)]
    rows = [(1, good[0], "s"), (1, "too few words", "s"), (None, good[1], "s"), (None, "short", "s"), (None, None, "s"),
            (2, "", "s"), (2, good[2], None), (3, " ".join(["same"] * 50), "s")]
    rows += [(10 + i, t, "s") for i, t in enumerate(good[3:])]
    docs = table(spark, rows)
    out = pipeline.quality_rules(spark, docs, "")
    assert out.columns == docs.columns and out.where("_kept <> 0 or _n <> -3").isEmpty()
    want = [(d, t) for d, t, _ in rows if t in good]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)
    kept = quality.quality(docs).where("kept").select("doc_id").collect()  # the same verdicts as the operator's
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted((d for d, _ in want), key=repr)


def test_quality_with_null_lang_and_source(spark):
    rows = [(i, prose(50, i), "en" if i % 3 else None, None if i % 2 else "s") for i in range(60)]
    df = spark.createDataFrame(rows + [(99, "x", None, None)], "doc_id long, text string, lang string, source string")
    assert {r["doc_id"]: r["kept"] for r in quality.quality(df).collect()} == {**{i: True for i in range(60)}, 99: False}


def test_mix_meets_targets_with_null_ids_and_equal_rows(spark):
    rows = [(None if i % 3 == 0 else i, prose(100, i), "ab"[i % 2]) for i in range(600)]
    rows += [(None, prose(100, 5000), "a")] * 40
    out = pipeline.source_mix(spark, docs := table(spark, rows), "")
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r["source"]] += len(WORD.findall(r["text"]))
    total = 100 * len(rows)
    assert got["a"] + got["b"] == pytest.approx(total, abs=64)
    assert got["a"] == pytest.approx(total / 3, abs=64) and got["b"] == pytest.approx(2 * total / 3, abs=64)
    plan = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    assert {r["source"]: r["n"] for r in plan} == dict(got)
    texts = Counter(r["text"] for r in out.collect())
    assert all(n <= 3 * max(1, sum(x[1] == t for x in rows)) for t, n in texts.items())


def test_rows_of_one_id_are_spread_over_shards(spark):
    docs = table(spark, [(None, prose(20, i), "a") for i in range(400)])
    plan = mixing.mix(docs, shard_rows=50)
    assert plan.agg(F.sum("taken")).first()[0] == pytest.approx(8000, abs=64)
    keys = mixing.document_sizes(docs).select((F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % 8).alias("shard"))
    assert max(r["count"] for r in keys.groupBy("shard").count().collect()) < 100


def test_stages_of_an_empty_table(spark):
    docs = table(spark, [(1, "x", "s")]).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_a_missing_checkpoint_folder_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "checkpoint_dir", lambda _: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        pipeline.run(spark, "/root/testdata/sf0.001")


def test_a_whole_run_against_plain_python(spark, tmp_path):
    base = [prose(80, i) for i in range(30)]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(base)]
    rows += [(100 + i, t + " tail", "a") for i, t in enumerate(base[:10])]     # near copies: go
    rows += [(None, base[20], "b"), (200, base[21], "b"), (200, base[21], "b")]  # copies of kept ones: go
    rows += [(300, "few", "a"), (301, None, "a"), (302, "", None), (303, " ".join(["w"] * 90), "a")]  # rejected
    rows += [(400, prose(60, 900) + " password=hunter2secret " + prose(20, 901), "a"), (None, prose(80, 902), "b")]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {i: t for i, t in enumerate(base)} | {400: rows[-2][1], None: rows[-1][1]}
    out = {}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/{name}")
    failed = {300, 301, 302, 303}
    assert Counter(r["doc_id"] for r in out["quality_rules"].collect()) == Counter(d for d, _, _ in rows if d not in failed)
    assert {r["doc_id"]: r["text"] for r in out["near_duplicates"].collect()} == kept
    masked = {r["doc_id"]: r["text"] for r in out["secret_scan"].collect()}
    assert masked.keys() == kept.keys() and "hunter2" not in masked[400]
    assert {d: t for d, t in masked.items() if d != 400} == {d: t for d, t in kept.items() if d != 400}
    size = Counter()
    for r in out["secret_scan"].collect():
        size[r["source"]] += len(WORD.findall(r["text"]))
    got, total = Counter(), sum(size.values())
    for r in out["source_mix"].collect():
        words = WORD.findall(r["text"])
        got[r["source"]] += len(words)
        assert words == WORD.findall(masked[r["doc_id"]])[:len(words)]
    assert got["a"] == pytest.approx(total / 3, abs=64) and got["b"] == pytest.approx(2 * total / 3, abs=64)
    last = out["sequence_packing"]
    per = {r["sequence_id"]: r for r in last.groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()}
    assert all(r["n"] == r["end"] <= 4096 for r in per.values())
    assert last.where("piece = 0").count() == out["source_mix"].count()
    assert pipeline.run(spark, str(tmp_path)).count() == last.count()
