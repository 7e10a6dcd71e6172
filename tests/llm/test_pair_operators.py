"""Substring deduplication, Jaccard join, fingerprints, toxicity and the pipeline against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, jaccard_join, suffix_dedup, toxicity
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def removed_by_brute_force(rows, length=50):
    first, texts = {}, [(2 ** 63 - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for j in range(len(t) - length + 1):
            first[t[j:j + length]] = min(first.get(t[j:j + length], 2 ** 63), d)
    out = []
    for (d, t), (own, _) in zip(texts, rows):
        gone = bytearray(len(t))
        for j in range(len(t) - length + 1):
            if first[t[j:j + length]] < d:
                gone[j:j + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((-1 if own is None else own, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 500, "bucket_items": 50, "segment": 64},
                                     {"chunk_bytes": 3000, "segment": 100, "seed": 8}])
def test_substring_removal(spark, options):
    random.seed(5)
    p, q = "".join(random.choice("abcde ") for _ in range(400)), "ab" * 200
    rows = [(1, p), (2, p[10:59]), (3, p[10:60]), (4, "xyz" + p[100:220] + "Q" + p[221:300]), (5, q),
            (6, q[1:] + "c" + q), (7, "a" * 300), (8, "b" + "a" * 51), (9, "a" * 49), (10, None), (11, ""),
            (None, p), (None, p), (4, p), (0, p[150:260]), (20, "é" * 100), (21, "x" + "é" * 60)]
    rows += [(30 + i, "".join(random.choice([p[i * 7:i * 7 + 60], "zz" + str(i), q[:70], p[50:103]])
                              for _ in range(12))) for i in range(40)]
    df = spark.createDataFrame([(*r, 1, b"") for r in rows], "doc_id long, text string, chunk int, data binary")
    got = sorted((-1 if r[0] is None else r[0], *r[1:5])
                 for r in suffix_dedup.remove_repeats(df, suffix_dedup.Doubling(**options)).collect())
    assert got == removed_by_brute_force(rows)


def test_substring_removal_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("heavy", [2, 64])
def test_jaccard_components(spark, heavy):
    random.seed(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A B"), (4, "a b c d"), (5, "a b c d"), (6, "b a")]
    for i in range(60):  # near copies of different closeness, and of copies
        w = list(base)
        for _ in range(i % 9):
            w[random.randrange(len(w))] = f"x{random.randrange(30)}"
        rows.append((10 + i, " ".join(w)))
    rows += [(100 + i, " ".join(random.choice("abcdefgh") + str(random.randrange(6)) for _ in range(80))) for i in range(30)]
    sets = {d: shingles(t, 4) for d, t in rows}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, token string")
    out = jaccard_join.jaccard_components(df, jaccard_join.Join(heavy=heavy, block=8)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == {
        d: (len(s), top(d)) for d, s in sets.items()}
    assert jaccard_join.jaccard_components(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    out = {r["node"]: r["component"] for r in components(links).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_fingerprints(spark):
    random.seed(3)
    words = [f"v{i}" for i in range(400)]
    texts = ["", None, "one two", "one two", "é ü ö ä x y z " * 3]
    for i in range(40):
        texts.append(" ".join(random.choice(words) for _ in range(random.choice([3, 30, 300, 1500]))))
        texts.append(" ".join(w if random.random() > 0.02 * (i % 5) else "q" for w in texts[-1].split()))
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, slice string")
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    by_id = sorted(((d, t or "") for d, t in rows), reverse=True)
    miss = []
    for i, (d, t) in enumerate(by_id):
        nxt = by_id[(i + 1) % len(by_id)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((r["near_edited"], edited), (r["near_next"], nxt)):
            a, b = shingles5(t), shingles5(other)
            miss.append(near - (1.0 if not a and not b else len(a & b) / len(a | b)))
    assert np.abs(miss).mean() < 0.03 and np.abs(miss).max() < 0.2
    assert got[2]["fingerprint"] == got[3]["fingerprint"] and got[0]["fingerprint"] == fingerprints.EMPTY
    ids = spark.createDataFrame([(None, "a"), (None, "b"), (7, "c"), (7, "c")], "doc_id long, text string")
    assert fingerprints.edited_fingerprints(ids).count() == 4
    assert fingerprints.edited_fingerprints(ids.limit(0)).count() == 0


def shingles5(text):
    w = WORD.findall(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_string_kernel_against_enumeration():
    from itertools import combinations

    def brute(s, t, p, d):
        def weights(x):
            out = {}
            for at in combinations(range(len(x)), p):
                key = "".join(x[i] for i in at)
                out[key] = out.get(key, 0) + d ** (at[-1] - at[0] + 1)
            return out
        a, b = weights(s), weights(t)
        return sum(v * b.get(k, 0) for k, v in a.items())

    for s, t in (("idiot", "idxiot"), ("aaaa", "aaa"), ("clown", "crowned"), ("abc", "xyz")):
        x, y = toxicity._codes([s], 24)[:, :len(s)], toxicity._codes([t], 24)[:, :len(t)]
        assert toxicity.subsequence_kernel(x, y, 3, 0.6)[0] == pytest.approx(brute(s, t, 3, 0.6), rel=1e-5)


def test_kernel_rows_lose_no_value_above_the_support():
    marks, own = ["idiot", "loser", "moron", "blockhead"], toxicity.Settings()
    words = ["iiot", "lser", "losr", "idit", "idiott", "mor0n", "moxron", "idixxot", "clown", "blockxhead", "io", "", "idiöt"]

    def value(s, t):
        x, y = (toxicity._codes([w], 24)[:, :max(1, (toxicity._codes([w], 24) > 0).sum())] for w in (s, t))
        k = [float(toxicity.subsequence_kernel(a, b, own.p, own.decay)[0]) for a, b in ((x, y), (x, x), (y, y))]
        return k[0] / np.sqrt(max(k[1] * k[2], 1e-12))
    for support in (own.support, 0.05):
        got = {(words[i], marks[k]): float(v) for i, k, v in zip(
            *toxicity.Kernel(marks, toxicity.Settings(support=support)).rows(words), strict=True)}
        want = {(s, t): value(s, t) for s in words for t in marks}
        assert got == pytest.approx({st: v for st, v in want.items() if v >= support}, rel=1e-4)
    assert {("iiot", "idiot"), ("lser", "loser"), ("losr", "loser"), ("idit", "idiot")} <= {
        st for st, v in want.items() if v >= own.support}
    assert len(toxicity.Kernel(["abc"], own).rows(["xyz", ""])[2]) == 0


def test_toxicity_finds_held_out_and_altered_insults(spark):
    random.seed(4)
    plain = ["ther", "ing", "onand", "haen", "stat", "wher", "ble", "tion", "anre", "esou"]
    bad = ["blockhead", "numskull", "dimwitted"]

    def text(insult=None):
        w = ["".join(random.choice(plain) for _ in range(random.randint(1, 3))) for _ in range(40)]
        if insult:
            w[random.randrange(40)] = insult
        return " ".join(w) + "."
    rows = [(i, text(random.choice(bad) if i % 3 == 0 else None)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    extra = [(1000, text("blockxhead")), (1001, "b l o c k h e a d"), (1002, text("num-skull!")), (1003, text()),
             (1004, None), (1005, "")]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, *extra]], "doc_id long, text string, score string")
    model = toxicity.train(df, labels)
    out = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    held = [i for i in range(400) if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == int(i % 3 == 0) for i in held]) > 0.97
    assert [out[i]["predicted"] for i in range(1000, 1006)] == [1, 1, 1, 0, 0, 0]
    none = toxicity.train(df, labels.limit(0))
    assert toxicity.score(df, none).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score(df.limit(0), none).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as c
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count()
        if name in ("quality_rules", "near_duplicates"):
            assert docs.count() <= rows
        rows = docs.count()
    kept = docs.select("doc_id").distinct().count()
    packed = c.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == kept


def test_shingle_sets_of_texts_shorter_than_a_shingle():
    for k in (4, 5):
        for texts in (["a b"], ["a"], [""], ["", "a b", ""], ["a b c"], ["a b", "b a"], ["a b c d e f", "a b"]):
            sets = jaccard_join.shingle_sets([t.encode() for t in texts], k)
            assert [len(s) for s in sets] == [len(shingles(t, k)) for t in texts]


def test_jaccard_components_of_one_short_text(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in jaccard_join.jaccard_components(df).collect()] == [(1, 1, 1, 0)]


@pytest.mark.parametrize("heavy,block", [(2, 8), (64, 1024)])
def test_links_of_every_document_are_counted(spark, heavy, block):
    random.seed(12)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"e{i}"])) for i in range(50)]  # all link with each other
    chain, w = [f"c{i}" for i in range(120)], []
    for i in range(30):  # near neighbours link, distant ones don't
        w = [f"d{i}" if j == 4 * i else x for j, x in enumerate(w or chain)]
        rows.append((100 + i, " ".join(w)))
    rows += [(200, rows[0][1]), (201, "p q r s t"), (202, "p q r s u")]
    sets = {d: frozenset(shingles(t, 4)) for d, t in rows}

    def linked(x, y):
        return x != y and 100 * len(x & y) >= 85 * len(x | y)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.jaccard_components(df, jaccard_join.Join(heavy=heavy, block=block)).collect()
    want = {d: sum(linked(s, t) for t in set(sets.values())) for d, s in sets.items()}
    assert want[0] == 49 and 0 < want[115] < 29
    assert {r["doc_id"]: r["n_links"] for r in out} == want


def test_null_and_repeated_ids_are_decided_by_text(spark):
    import corpus_pipeline as c
    word = [[f"{x}{i}" for i in range(60)] for x in "abcdef"]
    text = [" ".join(w) for w in word]
    near = " ".join(["z", *word[0]])
    rows = [(None, near, "s"), (7, text[0], "s"), (None, text[1], "s"), (None, text[2], "s"), (None, text[2], "s"),
            (None, text[2], "t"), (9, text[3], "s"), (9, text[3], "s"), (9, text[4], "s"), (3, text[5], "s"),
            (None, text[5], "s"), (None, "", "s"), (None, None, "s"), (None, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in c.near_duplicates(spark, df, "").select("doc_id", "text").collect()]
    none = [(None, text[1]), (None, text[2]), (None, ""), (None, ""), (None, None)]
    assert sorted(kept, key=repr) == sorted(
        [(7, text[0]), (9, text[3]), (9, text[4]), (3, text[5]), *none], key=repr)
    out = [tuple(r)[:1] + tuple(r)[2:] for r in jaccard_join.jaccard_components(df).collect()]
    assert sorted(out, key=repr) == sorted(
        [(None, 7, 1), (7, 7, 1), *[(None, None, 0)] * 7, *[(9, 9, 0)] * 3, (3, 3, 0), (None, 3, 0)], key=repr)


def test_near_duplicates_of_the_pipeline_link_at_five_words_and_four_fifths(spark):
    import corpus_pipeline as c
    words = [f"w{i}" for i in range(1000)]
    just, below = list(words), list(words)
    for i in range(22):
        just[20 + 40 * i] = f"x{i}"
    for i in range(23):
        below[20 + 40 * i] = f"y{i}"
    near = [len(shingles(" ".join(words), 5) & s) / len(shingles(" ".join(words), 5) | s)
            for s in (shingles(" ".join(just), 5), shingles(" ".join(below), 5))]
    assert near[0] >= 0.8 > near[1]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(just)), (3, " ".join(below))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in c.near_duplicates(spark, df, "").collect()) == [1, 3]
