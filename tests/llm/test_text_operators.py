"""Quality, secrets, licences, mixing, packing and WARC against brute force and edge cases."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, mixing, packing, quality, secrets, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, bucket string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, sources=None):
    """Rows with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or ""), False, -1, "x")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


TEXTS = ["", None, " \t\n", "one", "a b c d e f g h " * 4, "line one\nline one\n\nline two\nline one",
         "é ü x y " * 9, "# $ | <b> & * %", "w " * 6000, "tail " * 5, "tail " * 5]


def test_quality_statistics_match_brute_force(spark):
    def brute(t):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        n = Counter(wins)
        marked = {i + j for i, x in enumerate(wins) if n[x] > 1 for j in range(8)}
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))

    got = {r["doc_id"]: tuple(r)[1:6] for r in quality.quality(docs(spark, TEXTS)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_quality_judges_against_its_own_group(spark):
    plain = ["word%d other%d thing%d " % (i, i, i) * 1 + " ".join(f"tok{i}x{j}" for j in range(40)) for i in range(80)]
    odd = " ".join(f"|||| #{j}" for j in range(40))
    out = {r["doc_id"]: r["kept"] for r in quality.quality(docs(spark, [*plain, odd, "short"])).collect()}
    assert all(out[i] for i in range(80)) and not out[80] and not out[81]
    assert quality.quality(docs(spark, ["x"]).limit(0)).count() == 0


def test_secret_spans(spark):
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    n, check = __import__("zlib").crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        check = secrets.BASE62.decode()[r] + check
    texts = ["é PassWord: 'abcdef1' x", "token = short", "api_key==abcdefgh", "AKIA" + "Q" * 16, "AKIAQQ",
             "é" + "0123456789abcdef" * 2, "abcdef0" * 3, "ghp_" + body + check, "ghp_" + body + "000000", "", None,
             "secret:a secret:bbbbbbb", "ſecret=abcdefghi", "paſſwd=abcdefghi"]
    out = {r["doc_id"]: r for r in secrets.scan(docs(spark, texts)).collect()}
    spans = {i: out[i]["spans"] for i in out}
    assert spans[0] == "assign:2:20" and spans[1] == "" and spans[2] == "assign:0:17"
    assert spans[3] == "access:0:20" and spans[4] == "" and spans[5] == "hex:1:33" and spans[6] == ""
    assert spans[7] == "github:0:40" and spans[8] == "" and spans[9] == spans[10] == ""
    assert spans[11] == "assign:9:23" and spans[12] == spans[13] == ""
    assert out[9]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_redaction_keeps_rows_and_columns(spark):
    d = docs(spark, ["x password=abcdefgh y", None, "clean", "clean"])
    out = secrets.redact(d)
    assert out.columns == d.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {0: ("x [SECRET] y", 12), 1: (None, 0), 2: ("clean", 5), 3: ("clean", 5)}


def test_licence_digest_of_whole_texts(spark):
    mit = "Copyright (c) 2019 Some One\n\n" + licenses.KNOWN["MIT"].replace("sublicense", "sub-licence").upper()
    texts = [mit, licenses.KNOWN["ISC"] + " and more", None, "", "...", licenses.KNOWN["BSD-3-Clause"]]
    out = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    assert out == {0: "MIT", 1: None, 2: None, 3: None, 4: None, 5: "BSD-3-Clause"}


def test_mixing_targets_and_limits(spark):
    texts = ["w " * (20 + i % 90) for i in range(600)] + [None, ""]
    d = docs(spark, texts, ["a", "a", "b", None, "c", "tiny"])
    out = mixing.mix(d, block=4, shard_words=2000).toPandas()
    assert len(out) == len(texts) and (out.taken <= 3 * out["size"]).all()
    by = out.fillna({"source": "~"}).groupby("source").agg(n=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    weights = {"a": 1, "b": 2, "c": 3, "tiny": 1, "~": 2}
    assert by.target.sum() == pytest.approx(out["size"].sum())
    free = by[by.target < 3 * by.n - 1e-6]
    level = [by.target[s] / weights[s] for s in free.index]
    assert max(level) == pytest.approx(min(level))
    assert ((by.taken - by.target).abs() <= 4 * 8).all()
    again = mixing.mix(d.repartition(7), block=4, shard_words=2000).toPandas()
    assert out.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    mixed = mixing.mixed_documents(d, block=4, shard_words=2000)
    assert mixed.columns == d.columns
    assert mixed.agg(F.sum(F.size(F.split(F.trim("text"), " +")))).first()[0] == out.taken.sum()
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.mix(docs(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_sainte_lague_is_highest_quotients(spark):
    rng = np.random.default_rng(1)
    for seats in (0, 1, 7, 100):
        w = rng.integers(1, 50, 30).tolist()
        df = spark.createDataFrame([(0, seats, i, x) for i, x in enumerate(w)], "g int, seats int, u int, w int")
        got = {r["u"]: r["quota"] for r in mixing.sainte_lague(df, ["g"], ["u"], "w", "seats").collect()}
        won = sorted(((-x / (2 * k + 1), i, k) for i, x in enumerate(w) for k in range(seats)))[:seats]
        want = Counter(i for _, i, _ in won)
        assert sum(got.values()) == seats
        lost = min((w[i] / (2 * got[i] - 1) for i in got if got[i]), default=1e9)
        best = max(w[i] / (2 * got[i] + 1) for i in got)
        assert lost >= best or got == dict(want)


def test_array_encoder_equals_tokenizer():
    from tokenizers import Tokenizer
    path = packing.default_vocabulary()
    whole, enc = Tokenizer.from_file(path), packing.Encoder(path)
    texts = ["", "It's 'tis we'll 's \"'s can't 'story' we're'd 12a3 ª²½", "naïve ÀÉ ß İstanbul Σας", "<|endoftext|> hi",
             "日本語 text", "a b\u0085c\x1cd", "'", "'l 'll 'v don't'", "x" * 3000, "tab\tnew\nline"] + [
                 chr(c) + "a" + chr(c) for c in range(1, 0x260)]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert enc.encode(texts) == want


def test_histogram_packing_is_whole_and_tight():
    rng = np.random.default_rng(2)
    for size, draws in ((64, 3000), (4096, 4000), (7, 100), (5, 0)):
        counts = np.bincount(rng.integers(1, size + 1, draws), minlength=size + 1)
        packed = packing.pack_histogram(counts, size)
        back = np.zeros_like(counts)
        for n, holds in packed:
            assert sum(length * m for length, m in holds) <= size
            for length, m in holds:
                back[length] += n * m
        assert (back == counts).all()
        assert sum(n for n, _ in packed) <= 1.02 * -(-(counts * np.arange(size + 1)).sum() // size) + 2


def test_packing_places_every_piece(spark):
    d = docs(spark, [*TEXTS, "b " * 20000])
    out = packing.pack(d, seq_len=128).toPandas().sort_values(["sequence_id", "offset"])
    assert set(out.doc_id) == set(range(len(TEXTS) + 1)) and (out.length <= 128).all()
    ends = out.offset + out.length
    same = out.sequence_id == out.sequence_id.shift(-1)
    assert (out.offset.shift(-1)[same] == ends[same]).all() and ends.max() <= 128
    assert (out.groupby("sequence_id").offset.min() == 0).all()
    pieces = out.sort_values(["doc_id", "piece"])
    assert (pieces[pieces.piece > 0].start == 128 * pieces[pieces.piece > 0].piece).all()
    assert packing.pack(d.limit(0)).count() == 0


def test_warc_round_trip(spark):
    html = ["é" * 40000, "é" * 40000, None, "", "\r\n\r\n0\r\n", "x" * 32768, "z" * 100000]
    rows = [(i, f"http://h/{i}\nx", h) for i, h in enumerate(html)] + [(None, None, "é" * 40000), (6, "again", html[6])]
    out = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), payloads=True).collect()
    assert len(out) == len(rows)
    for r in out:
        body = (html[r["page_id"]] or "").encode() if r["page_id"] is not None else html[0].encode()
        assert r["payload_bytes"] == len(body)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r["payload"] is None or bytes(r["payload"]) == body
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in out)
    assert kinds == Counter([(0, "revisit", 1), (1, "response", None), (None, "revisit", 1), (2, "revisit", 3),
                             (3, "response", None), (4, "response", None), (5, "response", None),
                             (6, "response", None), (6, "response", None)])
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_segments_and_framing_are_verified():
    block = b"abcdefghij"
    parts = [(1, None, block[:4]), (3, 10, block[8:]), (2, None, block[4:8])]
    assert warc.reassembled(parts) == block
    for bad in (parts[:2], [*parts, parts[2]], [(1, 11, block)]):
        with pytest.raises(ValueError):
            warc.reassembled(bad)
    assert warc.dechunked(warc.chunked(b"x" * 20000, 7)) == b"x" * 20000
    with pytest.raises(ValueError):
        warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")
