"""Fertility rules, spelling variants and collocations against brute force; and their odd inputs."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

import public_tokenizers
from llm import bloom, collocations, fertility, variants
from llm.queries import FERTILITY_VOCABULARIES
from llm.tokenize import load_ranks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, kind string, n long, h long, word string, rank int, reduced long, length int, root string"


def docs(spark, rows):
    """(doc_id, text, lang) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(k, t, lang, "x", 1, 1, "x", 1, 1, 1, "x") for k, t, lang in rows], COLUMNS)


@pytest.fixture(scope="module")
def corpus():
    """Null, empty and blank texts, null languages and ids, ties, repeated rows and one very long text."""
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abeéÀst×"), rng.integers(2, 9))) for _ in range(150)]
    vocab += [w[:k] + w[k + 1 :] for w in vocab[:40] for k in (1, len(w) - 1)] + ["Grammar", "grammer", "gramar"]
    text = lambda n: " ".join(vocab[i] + "., ;\n"[rng.integers(0, 5)] * (rng.random() < 0.2) for i in np.minimum(rng.zipf(1.3, n) - 1, len(vocab) - 1))
    rows = [(0, None, "en"), (1, "", None), (2, " \t\n ", "de"), (3, "one", None), (None, text(80), "en"), (None, None, None)]
    rows += [(10 + i, text(int(rng.integers(40, 200))), ["en", "en", "de", None][i % 4]) for i in range(60)]
    rows += [(100, text(9000), "en"), (101, "x" * 30000, "en"), (11, *rows[7][1:]), (102, "и это слово " * 40, None), (103, "same line\nsame line\n\n \nsame line\n" * 9, "en")]
    return rows


def brute_base(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_counts_equal_brute_force(spark, corpus):
    rows = corpus + [(200, "a # b | c\n\n# a # b | c\n a # b | c", "en"), (201, "<<>> $%& \v\f\r x\rx", "en")]
    got = fertility.judge(docs(spark, rows), FERTILITY_VOCABULARIES).collect()
    assert collections.Counter((r.doc_id, *r[1:6]) for r in got) == collections.Counter((k, *brute_base(t)) for k, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert fertility.judge(docs(spark, []), FERTILITY_VOCABULARIES).collect() == []


def test_measures_equal_the_libraries(spark, corpus):
    model = sentencepiece.SentencePieceProcessor(model_file=FERTILITY_VOCABULARIES[0])
    ranks = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(FERTILITY_VOCABULARIES[1]).rank, special_tokens={})
    want = collections.Counter()
    for k, t, _ in corpus:
        w = WORD.findall(t or "")
        row = [k]
        for encode, loose in ((model.encode, model.is_byte), (lambda x: ranks.encode_ordinary(" " + x), lambda i: (b := ranks.decode_single_token_bytes(i))[0] >= 128 and len(b) == 1)):
            ids = [i for x in w for i in encode(x)]
            c = collections.Counter(ids)
            row += [len(ids), sum(map(loose, ids)), round(sum(-v / len(ids) * math.log2(v / len(ids)) for v in c.values()), 6) + 0.0]
        want[tuple(row)] += 1
    got = fertility.measure(docs(spark, corpus), FERTILITY_VOCABULARIES).collect()
    assert collections.Counter((r.doc_id, r.tokens0, r.loose0, round(r.entropy0, 6) + 0.0, r.tokens1, r.loose1, round(r.entropy1, 6) + 0.0) for r in got) == want


def test_kind_is_the_language_or_the_script(spark):
    rows = [(1, "это слово", None), (2, "a word", None), (3, "12 ..", None), (4, "это", "de"), (5, None, None), (6, "漢字 漢", None)]
    got = {r.doc_id: r.kind for r in fertility.measure(docs(spark, rows), FERTILITY_VOCABULARIES[:1]).collect()}
    assert got == {1: "script Cyrillic", 2: "script Latin", 3: "script none", 4: "de", 5: "script none", 6: "script Han"}


def test_bands_equal_brute_force(spark, corpus):
    """Quartiles in bins over different measurements; small kinds take the wider level."""
    enough = 8
    rows = fertility.measure(docs(spark, corpus), FERTILITY_VOCABULARIES[:1]).where("n_words >= 50")
    once = {}
    for r in rows.collect():
        bins = {"chars_per_token0": math.floor(r.word_chars / r.tokens0 * 256), "byte_share0": math.floor(r.loose0 / r.tokens0 * 2048), "entropy0": math.floor(r.entropy0 * 128)}
        once[(r.kind, r.length, *(r[c] for c in fertility._BASE), r.tokens0, r.loose0, *bins.values())] = (r.kind, r.length, bins)
    rows_of = list(once.values())
    seen = 0
    for b in fertility.bands(rows, 1, enough=enough).collect():
        same = [x for x in rows_of if x[:2] == (b.kind, b.length)]
        if len(same) < enough:
            same = [x for x in rows_of if x[0] == b.kind]
        if len(same) < enough:
            same = rows_of
        for m in ("chars_per_token0", "byte_share0", "entropy0"):
            v = sorted(x[2][m] for x in same)
            q = [v[math.ceil(len(v) * k / 4) - 1] for k in (1, 2, 3)]
            floor = fertility.WIDTH[m[:-1]] * fertility.BINS[m[:-1]]
            assert b[f"low_{m}"] == pytest.approx(q[1] - max(3.5 * 1.4826 * (q[1] - q[0]), floor))
            assert b[f"high_{m}"] == pytest.approx(q[1] + 1 + max(3.5 * 1.4826 * (q[2] - q[1]), floor))
        seen += 1
    assert seen == len({x[:2] for x in rows_of})


def test_labels_agree_with_the_verdict(spark):
    """Quality labels, which nothing learns from, of documents that pass the base rules."""
    sf = "/root/testdata/sf0.01"
    got = fertility.op11(spark.read.parquet(f"{sf}/documents.parquet"), FERTILITY_VOCABULARIES).where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.k / r.n for r in got.groupBy("quality").agg({"*": "count"}).withColumnRenamed("count(1)", "n").join(got.where("kept").groupBy("quality").count().withColumnRenamed("count", "k"), "quality", "left").fillna(0).collect()}
    assert share[1] > 0.95 and share.get(0, 0) < 0.15


def brute_words(rows, typos=199, min_length=6, min_count=5):
    c = collections.Counter()
    for k, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if typos and h % typos == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= min_length:
                c[w] += 1
    return {w: n for w, n in c.items() if n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(v, ratio=5):
    near = {w: [x for x in v if one_edit(w, x)] for w in v}
    form = {}
    for w in v:
        b = min(near[w], key=lambda x: (-v[x], x), default=None)
        if b is not None and v[b] >= ratio * v[w]:
            form[w] = b
    out = []
    for w in v:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, v[w], len(near[w]), v[form[w]] if w in form else None))
    return sorted(out)


@pytest.mark.parametrize("typos", [199, 3, None])
def test_words_equal_brute_force(spark, corpus, typos):
    got = {r.word: r.n for r in variants.words(docs(spark, corpus), min_length=2, min_count=2, typos=typos).collect()}
    assert got == brute_words(corpus, typos, 2, 2)


def test_variants_equal_brute_force(spark, corpus):
    assert sorted(map(tuple, variants.op12(docs(spark, corpus)).collect())) == brute_groups(brute_words(corpus))
    assert variants.op12(docs(spark, [])).collect() == []
    assert variants.op12(docs(spark, [(1, None, None), (2, "", "en")])).collect() == []


def test_chains_ties_and_long_words(spark):
    """Chains of forms to the last one, equal counts by code points, replaced, inserted and deleted letters, one word of 3,000."""
    long = "ab" * 1500
    v = {"colour": 5, "colours": 25, "coloures": 125, "colouress": 700, "coloursx": 25, "hat": 5, "cat": 30, "bat": 30, "é": 5, "è": 25, long: 5, long[1:]: 25, "aaaa": 7, "aaaaa": 7, "": 3, "z": 2}
    got = variants.group(spark.createDataFrame(list(v.items()), "word string, n long"))
    assert sorted(map(tuple, got.collect())) == brute_groups(v)


@pytest.mark.parametrize("symbols", [2, 3, 16])
def test_neighbourhood_holds_every_edit_once(symbols, monkeypatch):
    monkeypatch.setattr(variants, "SYMBOLS", symbols)
    monkeypatch.setattr(variants, "_SYMBOL", (np.arange(256) % symbols).astype(np.uint8))
    words = ["", "a", "ab", "aab", "abcabc", "zzzz", "éaà"]
    s, at, sizes = variants._reduced(pa.array(words))
    row, key = variants.neighbourhood(s, at, sizes)
    hash_of = lambda symbols_: int(sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(symbols_)) % (1 << 64))
    for i in range(len(words)):
        r = s[at[i] : at[i] + sizes[i]].tolist()
        want = {tuple(r)} | {tuple(r[:k] + r[k + 1 :]) for k in range(len(r))}
        want |= {tuple(r[:k] + [c] + r[k + 1 :]) for k in range(len(r)) for c in range(symbols)}
        want |= {tuple(r[:k] + [c] + r[k:]) for k in range(len(r) + 1) for c in range(symbols)}
        assert sorted(key[row == i].tolist()) == sorted(map(hash_of, want))
    assert variants._hashes(pa.array(words)).tolist() == [hash_of(s[a : a + n].tolist()) for a, n in zip(at, sizes, strict=True)]


def brute_phrases(rows, least=10, top=2000):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * v >= 50 * a for q, v in cand.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), " ".join(p), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p, -a, x, y, n[lang], -s) for i, (s, a, _, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


SIZES = [collocations.SIZES, collocations.Sizes(dense=1, tiles=2), collocations.Sizes(head=16, dense=1, tiles=1, word_bits=64, pair_bits=64), collocations.Sizes(head=0)]


@pytest.mark.parametrize("sizes", SIZES, ids=["given", "few tiles", "few ranks, full filters", "no ranks"])
def test_collocations_equal_brute_force(spark, corpus, sizes):
    """The same phrases however many units are ranked, tiles counted densely and rows filtered."""
    rows = corpus + [(300 + i, "New  York\tcity is New York, city. a b c d e ! a b c", lang) for i, lang in enumerate(["en", None, "und", "en"] * 4)]
    assert sorted(map(tuple, collocations.best(*collocations.phrases(docs(spark, rows), least=4, sizes=sizes), 70).collect())) == brute_phrases(rows, 4, 70)


def test_collocations_of_the_contract(spark, corpus):
    assert sorted(map(tuple, collocations.op13(docs(spark, corpus)).collect())) == brute_phrases(corpus)
    assert collocations.op13(docs(spark, [])).collect() == []
    assert collocations.op13(docs(spark, [(1, None, "en"), (2, "", None)])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 10**12 + 7, 10**13 + 1, 10**12 + 9  # noqa: E741
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(collocations._score(*(collocations.F.col(c) for c in "alr"))).first()
    assert row[0] == 1000000 * a * a // (l * r)


def test_bloom_filter_holds_all_its_keys(spark):
    keys = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 3000)
    f = bloom.build(spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long"), "k", 1 << 16)
    assert bloom.maybe(f, keys).all()
    assert bloom.maybe(f, keys + 1).mean() < 0.1
    empty = bloom.build(spark.createDataFrame([], "k long"), "k", 1 << 10)
    assert not bloom.maybe(empty, keys).any()
