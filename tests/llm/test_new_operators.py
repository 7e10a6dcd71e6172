"""Spelling variants, token alignment and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import alignment, decontaminate, variants

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# ------------------------------------------------------------------ spelling variants

def noisy_words_by_brute_force(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def variants_by_brute_force(count):
    out = {}
    for w, n in count.items():
        near = [v for v in count if one_edit(w, v)]
        best = min(near, key=lambda v: (-count[v], v), default=None)
        form = best if best is not None and count[best] >= 10 * n else None
        out[w] = form, n, len(near), count[form] if form else None
    full = {}
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        full[w] = form, root, n, near, form_n
    return full


def word_texts():
    random.seed(4)
    stems = ["separate", "receive", "definitely", "aaaaaaaa", "ababababab", "élèvesçañ", "necessary", "xyzxyzxyz"]
    letters = "abexyzéñ"

    def edited(w):
        i = random.randrange(len(w) + 1)
        return random.choice([w[:i] + random.choice(letters) + w[i:], w[:i] + w[i + 1:],
                              w[:i] + random.choice(letters) + w[i + 1:]])
    texts = []
    for i in range(150):
        ws = [random.choice(stems) for _ in range(40)]
        for _ in range(random.randrange(8)):
            w = random.choice(stems)
            for _ in range(random.randrange(1, 4)):
                w = edited(w)
            ws += [w.title()] * random.choice([1, 2, 15])
        texts.append(random.choice([" ", "-", ", 7"]).join(ws))
    return texts


@pytest.mark.parametrize("settings", [variants.Spelling(), variants.Spelling(hot=5, tile=4, bucket_rows=500),
                                      variants.Spelling(parts=2, tile=8, cells=64)])
def test_spelling_variants(spark, settings):
    rows = list(enumerate(word_texts())) + [(None, "Separates separates"), (None, "Separates separates"), (5, None),
                                            (6, ""), (7, "w" * 5000 + " " + "w" * 5001), (8, "w" * 5000 + " " + "w" * 5001)]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, word string, n int, id int")
    words = variants.noisy_words(df)
    count = noisy_words_by_brute_force(rows)
    assert {r["word"]: r["n"] for r in words.collect()} == count
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in variants.spelling_variants(words, settings).collect()}
    assert got == variants_by_brute_force(count)
    assert sum(x[0] is not None for x in got.values()) > 50 and max(x[3] for x in got.values()) > 20


def test_spelling_variants_of_one_hot_key_stay_bounded(spark):
    words = ["prefix" + a + b + "suffix" for a in "abcdefghijklmn" for b in "abcdefghijklmnop"]
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    settings = variants.Spelling(hot=20)
    keys = variants._bounded_keys(df, settings)
    # at a single place one code point is free in the shorter words, two in those a code point longer
    assert max(r["count"] for r in keys.where("length(word) = base").groupBy("key").count().collect()) <= 20
    assert max(r["count"] for r in keys.groupBy("key").count().collect()) <= 14 * 16
    got = {r["word"]: r["n_near"] for r in variants.near_words(df, settings).collect()}
    assert got == {w: sum(one_edit(w, v) for v in words) for w in words}


def test_spelling_variants_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.spelling_variants(variants.noisy_words(empty)).count() == 0


# ------------------------------------------------------------------ token alignment

def alignment_by_brute_force(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # byte-level alphabet: printable bytes stand for themselves, the others follow from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    out, docs = [], []
    for doc, text in rows:
        groups = []
        if text:
            raw = f" {text}".encode()
            ia, ib = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
            ta = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
            tb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p := b.id_to_piece(i)) else p.replace("▁", " ").encode()
                  for i in ib]
            if b"".join(ta) == raw == b"".join(tb):
                ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
                cuts = sorted(set(ea) & set(eb))
                lo = 0
                for c in cuts:
                    groups.append(([i for i, e in zip(ia, ea) if lo < e <= c], [i for i, e in zip(ib, eb) if lo < e <= c]))
                    lo = c
        docs.append(groups)
    count = Counter(p for groups in docs for p in {(x, y) for xs, ys in groups for x in xs for y in ys})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    for (doc, _), groups in zip(rows, docs):
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((-1 if doc is None else doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out)


def aligned_texts():
    random.seed(2)
    parts = ["hello", "Wörter", " ", "  ", "\n\n", "\t", "naïve", "😀", "中文字", "1234", "don't", "<|endoftext|>", "<s>", "<0x41>",
             "===", "aaaa", "é́", " ", "\x00", "supercalifragilistic", "ción", ".", ",", "'ll"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(1, 60))) for _ in range(120)]
    return texts + ["", None, " ", "  x ", "a▁b", "plain words here"] * 2 + ["word " * 3000, "a" * 30000, "😀" * 3000]


@pytest.mark.parametrize("pairing", [alignment.Pairing(), alignment.Pairing(lane=3, part_bytes=500, merge=2, copies=1, stretches=7)])
def test_alignment(spark, pairing):
    rows = [*enumerate(aligned_texts()), (None, "null id"), (None, "null id"), (3, "again")]
    df = spark.createDataFrame([(*r, "x", 1, b"") for r in rows],
                               "doc_id long, text string, part string, n_a int, pairs binary").repartition(3)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"],
                  *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")))
                 for r in alignment.align(df, pairing).collect())
    assert got == alignment_by_brute_force(rows)


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_groups_are_counted_before_they_are_paired():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50, 300), rng.integers(0, 40, 400)
    cut_a, cut_b = np.array([2, 299, 300]), np.array([1, 390, 400])
    key, times = alignment._pairs(a, b, cut_a, cut_b, 1000)
    want = Counter()
    for (x0, x1), (y0, y1) in zip([(0, 2), (2, 299), (299, 300)], [(0, 1), (1, 390), (390, 400)]):
        want.update(int(x) * 1000 + int(y) for x in a[x0:x1] for y in b[y0:y1])
    assert dict(zip(key.tolist(), times.tolist())) == want and key.tolist() == sorted(want)


class CountedEncoder:
    def __init__(self, encoder):
        self.encoder, self.seen = encoder, 0

    def encode_ordinary(self, text):
        self.seen += len(text)
        return self.encoder.encode_ordinary(text)


def test_stretches_of_a_batch_are_encoded_once(monkeypatch):
    pairing = alignment.Pairing(stretches=11)
    t = alignment.tokenizers(pairing)
    texts = ["the same words again and again"] * 20 + ["again the same words"] * 20
    counted = CountedEncoder(t.a)
    monkeypatch.setattr(t, "a", counted)
    rows = alignment.align_texts(texts, pairing)
    assert counted.seen == len(" the same words again and")
    assert len(set(rows)) == 2 and rows == [rows[0]] * 20 + [rows[20]] * 20


def test_stretches_begin_where_both_tokenizers_cut():
    t = alignment.tokenizers(alignment.Pairing())
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace() or c in (0, 0x7F, 0x180E, 0x200B, 0xFEFF)]
    texts = [f"{x}{c}{y} z{c}" for c in ["é", "中", "😀", "'", *spaces] for x in ("a", "", " ") for y in ("", " ", "  ", f"{c} ")]
    code, begin, stretches, size, closed = alignment._cut(texts)
    assert size.tolist() == [len(x.encode()) for x in stretches] and len(set(stretches)) == len(stretches)
    assert not any(x[-1].isspace() for x in stretches[:closed])
    ids = t.encode(stretches, size, closed)
    parts = [np.split(x, np.cumsum(n)[:-1]) for x, n in ((ids.a, ids.n_a), (ids.b, ids.n_b))]
    assert ids.good.all()
    for text, lo, hi in zip(texts, begin, begin[1:]):
        own = code[lo:hi].tolist()
        assert "".join(stretches[k] for k in own) == f" {text}"
        assert [i for k in own for i in parts[0][k].tolist()] == t.a.encode_ordinary(f" {text}"), repr(text)
        assert [i for k in own for i in parts[1][k].tolist()] == t.b.encode(text), repr(text)


@pytest.mark.parametrize("many", [1, 40, 1 << 21])
@pytest.mark.parametrize("large", [1, 4096])
def test_documents_are_paired_alike_in_any_slices(monkeypatch, many, large):
    texts = [x or "" for x in aligned_texts()[:132]]
    want = alignment.align_texts(texts, alignment.Pairing())
    assert want == [alignment.align_texts([x], alignment.Pairing())[0] for x in texts]
    monkeypatch.setattr(alignment, "MANY", many)
    monkeypatch.setattr(alignment, "LARGE", large)
    assert alignment.align_texts(texts, alignment.Pairing()) == want


def test_a_stretch_that_b_changes_leaves_its_texts_without_tokens(monkeypatch):
    pairing = alignment.Pairing(stretches=12)
    t = alignment.tokenizers(pairing)
    plain = alignment.align_texts(["left alone", "other"], pairing)
    monkeypatch.setattr(t, "b_bytes", [b"X" if x == b"'" else x for x in t.b_bytes])
    assert alignment.align_texts(["left alone", "don't go", "other", "isn't"], pairing) == [
        plain[0], alignment._NONE, plain[1], alignment._NONE]


def test_equal_rows_are_spread_over_parts(spark):
    df = spark.createDataFrame([(None, "the same words")] * 300, "doc_id long, text string").coalesce(1)
    parts = alignment._aligned(df, alignment.Pairing(copies=20), 50).groupBy("part").count().collect()
    assert max(r["count"] for r in parts) <= 40


# ------------------------------------------------------------------ decontamination

def item_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def hits_by_brute_force(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, found = item_words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((-1 if doc is None else doc, len(w), len(hit), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def planted():
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(25)] + ["é1", "ß"]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.choice([1, 2, 4, 9, 10, 11, 30, 60])))) for i in range(30)]
    items += [(40, None), (41, ""), (42, " ?! "), (None, "only a null id marks these twelve words here and now again"),
              (3, "a second text of item three that has more than ten words in all"), (10, items[0][1]), (100, items[1][1])]
    rows = []
    for d in range(150):
        parts = []
        for _ in range(random.randrange(1, 6)):
            text = random.choice(items)[1] or ""
            w = text.split()
            a = random.randrange(len(w) + 1)
            parts.append(random.choice([text.upper(), " ".join(w[a:a + random.choice([9, 10, 15])]), "un seen words",
                                        ", ".join(random.choice(vocabulary) for _ in range(40))]))
        rows.append((d, " - ".join(parts)))
    return rows + [(200, None), (201, ""), (None, items[5][1]), (None, items[5][1]), (7, rows[7][1]),
                   (300, "x" * 1_200_000 + " " + items[8][1] + " " + "y" * 1_200_000)], items


@pytest.mark.parametrize("rules", [decontaminate.Rules(), decontaminate.Rules(block_words=100, piece_words=15),
                                   decontaminate.Rules(window=4)])
def test_decontamination(spark, rules):
    rows, items = planted()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, words string")
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:6])
                 for r in decontaminate.digest(decontaminate.scan(docs, bench, rules)).collect())
    assert got == hits_by_brute_force(rows, items, rules.window)
    assert {x[5] for x in got} == {True, False}


def test_longest_match_and_removal(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    texts = ["Before: ONE two three, four five six seven eight nine ten eleven! After all of this text goes on and on and on for long.",
             "nine words one two three four five six seven eight nine", None, "x " + item + " y",
             "é " + item[4:] + " ü" + " z" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r["longest"] for r in decontaminate.scan(docs, bench).orderBy("doc_id").collect()] == [11, 0, 0, 12, 11]
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert kept == {0: "Before: ! After all of this text goes on and on and on for long.", 1: texts[1], 2: None,
                    4: "é  ü" + " z" * 40}  # document 3 is nearly all item


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r)[:6] for r in decontaminate.digest(decontaminate.scan(docs, none)).collect()] == [(1, 2, 0, 0, empty, False)]
    assert decontaminate.scan(docs.limit(0), none).count() == 0


def test_automaton_tracks_the_longest_match():
    random.seed(6)
    items = [(str(i), [random.randrange(4) for _ in range(random.randrange(1, 25))]) for i in range(12)]
    auto = decontaminate.SuffixAutomaton(items, 5)
    runs = {tuple(s[a:b]) for _, s in items for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = [random.randrange(5) for _ in range(400)]
    _, lengths = auto.stream(text)
    assert lengths == [max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n:i + 1]) in runs)) for i in range(len(text))]
