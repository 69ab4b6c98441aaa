"""Whitening, phrases and word encoding on hand-made tables, against brute force and the tokenizers library."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from larder.llm import bpe_words, phrases, whitening
from larder.llm.bpe_words import SHORT, WordBpe, decode, encode
from larder.llm.phrases import MisraGries, collocations, frequent_runs
from larder.llm.queries import ORACLES, QUERIES, tokenizer_file
from larder.llm.whitening import jacobi_davidson, whiten, whole_entries

DOCS = "doc_id bigint, text string, lang string, phrase string, part int, mass bigint, ids string, decoded int"


def doc_rows():
    rng = np.random.default_rng(5)
    some = [f"w{x}" for x in (rng.zipf(1.4, 9000) % 60)]
    out = [(i, " ".join(some[40 * i : 40 * i + 40]), ["en", "de", None, "und"][i % 4]) for i in range(200)]
    out += [(300 + i, "New York City, in new\tyork City! New  York\nstate", "en") for i in range(12)]
    out += [(400 + i, "a a a a", "en") for i in range(9)]
    out += [(500, None, "en"), (501, "", "fr"), (502, " \t.,;\n", "es"), (503, "É é ÀB àb", None), (None, "no id. no id", "en"), (7, "seven", "en"), (7, "seven", "en")]
    out += [(600, " ".join(some), "en"), (601, "x" * 3000, "en"), (602, "long\x0bwords\x00here " * 30, "en")]
    return [(i, t, lang, "p", 1, 2, "i", 3) for i, t, lang in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3).cache()


def brute_phrases(rows, threshold=10, most=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = {}
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or a < threshold:
            continue
        longer = [b for other, b in f.items() if other[0] == lang and len(other) == 4 and len(w) == 2 and b >= threshold and tuple(w) in (other[1:3], other[2:4])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, k = min((10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, own in out.items() for i, (s, a, p, l, r) in enumerate(sorted(own)[:most], 1)}


@pytest.mark.parametrize("bits,block", [(None, 1_000_000), (0, 50), (7, 700)])
def test_phrases(docs, monkeypatch, bits, block):
    """Also with blocks that end inside texts, slices that end inside pieces, and one partition for all hashes."""
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
    monkeypatch.setattr(phrases, "SLICE", 1 << 20 if bits is None else 64)
    monkeypatch.setattr(phrases, "WAITING", 500)
    got = {tuple(r) for r in collocations(docs, bits=3 if bits == 0 else bits).collect()}
    want = brute_phrases(doc_rows())
    assert len(want) > 100 and got == want


def test_first_phrases_and_other_thresholds(docs):
    got = {tuple(r) for r in collocations(docs, threshold=4, most=5).collect()}
    assert got == brute_phrases(doc_rows(), 4, 5)


def test_no_phrases(spark, docs):
    empty = spark.createDataFrame([], DOCS)
    assert collocations(empty).collect() == [] and frequent_runs(empty).collect() == []
    assert collocations(docs.where("doc_id in (500, 501, 502)")).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_every_frequent_key_survives(seed):
    rng = np.random.default_rng(seed)
    stream = rng.zipf(1.2, 20_000) % 5000
    true = Counter(stream.tolist())
    summary = MisraGries(len(stream) // 10 + 1 if seed else 40)
    for part in np.array_split(stream, 37):
        keys, counts = np.unique(part.astype(np.uint64), return_counts=True)
        summary.add(keys, counts)
        summary.fold()
    assert len(summary.keys) <= summary.capacity and summary.lost <= len(stream) / (summary.capacity + 1)
    least = summary.lost + 1 if not seed else 10
    assert {k for k, c in true.items() if c >= least} <= {*summary.reaching(least).tolist()}


def test_packed_counts():
    counts = np.asarray([1, 255, 256, 3, 70_000])
    assert phrases._unpack(5, phrases._pack(counts)).tolist() == counts.tolist()


@pytest.mark.parametrize("key", ["op12_phrases"])
def test_phrases_equal_sql(spark, sf_dir, key):
    con = connect(sf_dir)
    assert differences(QUERIES[key](spark, sf_dir), ORACLES[key], con) == []
    con.close()


# Word encoding ------------------------------------------------------------------------------------

TEXTS = [
    None, "", " ", "Hello World, it's 2024! don't we'll I'M", "<|endoftext|>a<|startoftext|> b<|endoftext|>́c <|endof text|>",
    "ΣΑΣ Σ ΟΔΟΣ İstanbul ǅ ß ẞ", "é é  x　y\u0085z\xa0q", "a\x1cb \x1f c\x1d\x1e", "日本語テキスト 한국어 עברית 😀👩‍👩‍👧 ½²",
    "x" * 5000, "ab" * 700, "supercalifragilisticexpialidocious" * 40, "!?" * 300 + "''s't", "0123456789" * 9, "\x00\x01 \t\r\n\x0b\x0c", "Å Å ﬁ ﷺ", "<|", "ꟓ Ᲊ Ᲊ \U00010d50",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(tokenizer_file("word_bpe_49k.json"))


def ids_of(bpe, text):
    return np.frombuffer(next(bpe.ids([text])), "<i4").tolist()


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_ids_and_texts_of_the_library(bpe, library, text):
    ids = ids_of(bpe, text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert bpe.texts(np.asarray(ids, np.int32), np.asarray([0, len(ids)]))[0] == library.decode(ids, skip_special_tokens=False)


def test_random_texts(bpe, library):
    rng = np.random.default_rng(3)
    alphabets = ["abcdefgh' .1\n", "etaoin shrdlu", "éàüßñ ̈́aeo", "<|>endoftext ", "".join(map(chr, range(0x20, 0x250))), "".join(map(chr, range(0x370, 0x500)))]
    for i in range(600):
        letters = list(alphabets[i % len(alphabets)])
        text = "".join(rng.choice(letters, int(rng.integers(1, 200))))
        ids = ids_of(bpe, text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_every_character(bpe, library):
    for start in range(0, 0x30000, 64):
        text = " ".join("a" + chr(c) + "B" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert ids_of(bpe, text) == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_heap_and_scan_agree(bpe):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaoinshr"), int(rng.integers(1, SHORT)))).encode() for _ in range(600)]
    assert bpe.encode_words(words) == [bpe.long_word(w) for w in words]


def test_forgotten_pieces(bpe, library, monkeypatch):
    monkeypatch.setattr(bpe_words, "REMEMBERED", 5)
    monkeypatch.setattr(bpe_words, "TOGETHER", 50)
    small = WordBpe(tokenizer_file("word_bpe_49k.json"))
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["the", "Thing,", "x" * 45, "ate.", "é!", "of", "on7"], int(rng.integers(0, 9)))) for _ in range(200)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<i4").tolist() for x in small.ids(texts)] == want


def test_encoded_and_decoded_rows(spark, library):
    rows = [(None if i == 3 else i, t, "x", 1.0, "y", "z", 1) for i, t in enumerate(TEXTS + ["Hello", "Hello"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded double, n_tokens string, doc_text string, part int").repartition(2)
    path = tokenizer_file("word_bpe_49k.json")
    got = decode(encode(df, path), path).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    odd = spark.createDataFrame([(1, None, "k"), (2, [], "k"), (3, [320, -5, 999_999, 320], "k")], "n int, ids array<int>, other string")
    assert sorted((r.n, r.other, r.text) for r in decode(odd, path, out="text").collect()) == [(1, "k", ""), (2, "k", ""), (3, "k", "a</w> a</w>")]
    assert encode(df.where("false"), path).collect() == []


def test_query_gives_digests(spark, sf_dir, library):
    got = {r.doc_id: r for r in QUERIES["op13_word_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), digest)
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# Whitening ----------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, x string, n int, component string, label int"


def vector_rows(n=300, d=12):
    rng = np.random.default_rng(2)
    a = rng.standard_normal((n, d)) * np.linspace(0.05, 1, d)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(a)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    bad = [None, [], [None] * d, rows[0][1][:-1] + [None], rows[0][1][:-1] + [math.nan], rows[0][1][:-1] + [math.inf], [-math.inf] * d, rows[0][1][:-1]]
    return rows + [(900 + i, v) for i, v in enumerate(bad)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "c", 0) for i, v in rows], VECTORS).repartition(3)


def exact_moments(good):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    y = np.asarray([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    return far, y, y.T @ y / n


def test_whitening(spark):
    rows = vector_rows()
    good = [(i, v) for i, v in rows if v and len(v) == 12 and all(c is not None and math.isfinite(c) for c in v)]
    far, y, cov = exact_moments([v for _, v in good])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    got = whiten(frame(spark, rows)).collect()
    assert len(got) == 8 * len(good)
    signs = np.zeros(8)
    by_far = {}
    for r in got:
        by_far.setdefault((r.vec_id is None, r.vec_id or 0, r.deviation), {}).setdefault(r.component, []).append(r)
    assert Counter((i is None, i or 0, f) for (i, _), f in zip(good, far)) == Counter({k: len(v[1]) for k, v in by_far.items()})
    for (i, _), f, row in zip(good, far, y):
        for k in range(8):
            for r in by_far[i is None, i or 0, f][k + 1]:
                want = row @ vectors[:, k] / np.sqrt(values[k])
                if not signs[k] and abs(want) > 0.1:
                    signs[k] = np.sign(want * r.whitened)
                assert r.whitened == pytest.approx(signs[k] * want if signs[k] else r.whitened, abs=1e-9)
                assert r.n == len(good) and r.deviation_wide == f
                assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-12)
                assert r.identity_error < 1e-10


def test_few_dimensions_no_variance_and_wide_deviations(spark):
    flat = whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect()
    assert len(flat) == 8 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 and r.identity_error == 0 for r in flat)
    line = whiten(frame(spark, [(i, [float(i), 0.0, 5.0]) for i in range(4)])).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None) for r in line) == [(i, k, k > 1) for i in range(4) for k in (1, 2, 3)]
    assert len(whiten(frame(spark, [(1, [0.5])])).collect()) == 1
    far = whiten(frame(spark, [(0, [1e30, 0.0]), (1, [0.0, 0.0]), (2, [-1e30, 1.0])])).collect()
    big = 2**53
    assert {r.vec_id: int(r.deviation_wide) for r in far}[0] == (3 * big - 200_000) ** 2 + (300_000 - 301_024) ** 2
    assert all(r.deviation is None for r in far if r.vec_id != 1)


def test_no_vectors(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, None), (2, [math.nan])])).collect() == []
    assert whole_entries(frame(spark, [(1, [0.0009765625, -0.0001])])).first().x == [100_001, 99_999]


@pytest.mark.parametrize("d,spread", [(1, 0), (3, 1), (40, 0), (40, 3), (150, 1)])
def test_eigenpairs(d, spread):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((500, d)) * np.exp(spread * rng.standard_normal(d))
    v = a.T @ a / 500
    values, q, left = jacobi_davidson(lambda w: v @ w, d, 8)
    want = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.abs(q.T @ q - np.eye(len(values))).max() < 1e-13
    assert left.max() <= 1e-12 * want[0]


def test_equal_eigenvalues():
    v = np.diag([5.0, 5, 5, 2, 2, 1, 1, 1, 1, 1, 1, 0.5])
    values, q, _ = jacobi_davidson(lambda w: v @ w, 12, 8)
    assert np.allclose(values, [5, 5, 5, 2, 2, 1, 1, 1], atol=1e-13) and np.allclose(v @ q, q * values, atol=1e-12)


def test_minres():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a, b = a + a.T, rng.standard_normal((30, 4))
    x = whitening.minres(lambda t: a @ t, b, 200, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8


# Cases that went wrong before ---------------------------------------------------------------------------


def test_a_tag_in_prose_is_no_licence():
    from larder.llm.licenses import BASE_PHRASES, NOTICE_PHRASES, Scanner

    scanner = Scanner(dict(BASE_PHRASES), dict(NOTICE_PHRASES))
    for text, labels in [
        (b"this file carries an SPDX-License-Identifier of its own", []),
        (b"SPDX-License-Identifier MIT", ["mit"]),
        (b"SPDX-License-Identifier: Own-1.0", ["own-1"]),
        (b"SPDX-License-Identifier LicenseRef-Mine", ["licenseref-mine"]),
    ]:
        assert scanner.scan(text)[2] == labels, text


def test_places_are_counted_on_from_match_to_match():
    from larder.llm.licenses import Scanner

    rng = np.random.default_rng(6)
    phrases_ = {"a b": "x", "b": "y", "a b c d": "z", "c d a": "w", "d": "v"}
    scanner = Scanner(phrases_, {})
    words = rng.choice(list("abcde"), 2000).tolist()
    got = sorted((p, w) for p, _, _, w in scanner.scan(" ".join(words).encode())[1])
    want = sorted((p, i) for p in phrases_ for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    assert got == want


def test_mixing_beside_a_column_of_the_name_it_wanted(spark, tmp_path):
    rows = [(i, "a b c", "en", "s", 5, "m", "n") for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _mix string, mix string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_mixing"](spark, str(tmp_path)).collect()
    assert sum(r.taken for r in got) == 90 and {r.target for r in got} == {90.0}


def test_one_id_with_two_texts_links_with_both(spark):
    from larder.llm.ngram_join import ngram_classes

    base = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (1, " ".join(other)), (2, " ".join([*base[:-1], "x"])), (3, " ".join([*other[:-1], "y"])), (4, "alone at last with some words")]
    got = {r.doc_id: r.component_id for r in ngram_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_ids_of_many_texts_are_those_of_the_library(monkeypatch):
    from tokenizers import Tokenizer

    from larder.llm import packing

    monkeypatch.setattr(packing, "REMEMBERED", 40)
    path = tokenizer_file()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    ours, rng = packing.WordwiseTokenizer(path), np.random.default_rng(12)
    vocabulary = ["word,", "word", "Another.", "l'eau", "it's", "naïve,", "naïve", "a|", "||", "3rd,", "x\x01,", "\x01,", "", "\n", "end.\nnext", "tab\t", "日本", "İs", "<|endoftext|>", "don't.", "é.", ",", " ", "z" * 60]
    texts = ["", " ", ", ", "a, ", "a,  b"] + [" ".join(rng.choice(vocabulary, int(rng.integers(1, 30)))) for _ in range(400)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for part in np.array_split(np.arange(len(texts)), 9) for x in ours.ids_of([texts[i] for i in part])]
    assert got == want
    assert [np.frombuffer(ours.ids(t), "<u4").tolist() for t in texts] == want


def test_class_numbers_stay_whole(spark):
    """Class numbers pass 2 ** 53 and stand beside nulls; pairs, documents and groups must name the same ones."""
    from larder.llm.ngram_join import Join

    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: 50 + i], "x", *base[51 + i :]])) for i in range(6)]
    join = Join(spark.createDataFrame(rows, "doc_id bigint, text string"))
    known = {r.rep for r in join.reps.collect()}
    pairs = join.first_pairs().collect()
    assert len(known) == 6 and pairs and {x for p in pairs for x in p} <= known
    assert any(abs(x) > 2**53 and x % 512 for x in known)


def near_copies(count, edits, seed=3, size=120):
    rng = np.random.default_rng(seed)
    base, out = [f"w{i}" for i in range(size)], []
    for i in range(count):
        w = list(base)
        for at in rng.choice(size, edits, replace=False):
            w[at] = f"e{rng.integers(10**9)}"
        out.append((i, " ".join(w)))
    return out


def linked_roots(rows):
    sets = [frozenset(tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)) for _, t in rows]
    root = list(range(len(sets)))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if root[i] != root[j] and 100 * len(s & t) >= 75 * len(s | t):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return dict(enumerate(root))


def test_near_copies_hand_on_a_forest_not_their_pairs(spark):
    from larder.llm import ngram_join

    rows = near_copies(200, 1)
    join = ngram_join.Join(spark.createDataFrame(rows, "doc_id bigint, text string"))
    groups = join.found.where("kind = 'group'").select("keys", "classes").mapInPandas(ngram_join._unpacked, "key bigint, rep bigint")
    found = [(r.a, r.b) for r in join.open_pairs(groups.selectExpr("key", "rep", "rep as root")).collect()]
    assert len(found) < 5 * len(rows)
    first = ngram_join.spanning(*np.asarray(found).T)
    assert len(first) == len(rows) - 1
    tree = {frozenset(found[i]) for i in first}
    assert len(tree) == len(rows) - 1


def test_near_copies_beyond_one_block(spark, monkeypatch):
    """Groups about the threshold, as one component in a task and as one in blocks, by members and by documents."""
    from larder.llm import ngram_join

    rows = near_copies(90, 2)
    rows += [(len(rows) + i, t) for i, t in near_copies(20, 1, size=40)]
    df, want = spark.createDataFrame(rows, "doc_id bigint, text string"), linked_roots(rows)
    ours = lambda: {r.doc_id: r.component_id for r in ngram_join.ngram_classes(df).collect()}
    assert ours() == want and 1 < len({*want.values()}) < len(rows)
    in_blocks, calls = ngram_join.Join.settled_in_blocks, []
    monkeypatch.setattr(ngram_join.Join, "settled_in_blocks", lambda *x: calls.append(1) or in_blocks(*x))
    monkeypatch.setattr(ngram_join, "SKETCHED", 4)
    for block, members in ((16, 1 << 20), (2048, 900)):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "MEMBERS", members)
        assert ours() == want
    assert len(calls) == 2


def test_new_chunks_of_many_texts_take_one_call_of_the_library(monkeypatch):
    """Words with a sign, at a line's end or beside white space too; nothing is kept for texts to come."""
    import tokenizers

    from larder.llm import packing

    library, calls = tokenizers.Tokenizer.from_file(tokenizer_file()), []

    class Counted:
        from_file = staticmethod(lambda path: Counted())

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **options)

    library.encode_special_tokens = True
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    ours, rng = packing.WordwiseTokenizer(tokenizer_file()), np.random.default_rng(4)
    letters = list("abcdefgéïß")
    words = ["".join(rng.choice(letters, int(rng.integers(3, 12)))) for _ in range(2000)]
    ends = [" ", ". ", ", ", "\n", ".\n", "  ", " \n ", "\t", "$$$. ", "\xa0 ", "é, ", "\n\n"]
    texts = ["".join(w + str(rng.choice(ends)) for w in words[i : i + 40]) for i in range(0, 2000, 40)] + ["", "\x01 a", "\x02"]
    calls.clear()
    got = [np.frombuffer(x, "<u4").tolist() for x in ours.ids_of(texts)]
    assert len(calls) <= 3 and sum(calls) < 1200
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not ours.start and not ours.rest
    monkeypatch.setattr(packing, "TOGETHER", 100)
    import pyarrow as pa

    parts = [x for part in packing._together(pa.array([None, *texts])) for x in ours.ids_of(part)]
    assert [np.frombuffer(x, "<u4").tolist() for x in parts] == [[], *got]


def test_workers_hold_little_between_and_inside_tasks(spark, monkeypatch):
    """An operator frees what another one kept in the worker; documents' keys are held for some documents at a time, whatever a batch holds."""
    import tracemalloc
    import weakref

    import pyarrow as pa
    from pyspark.sql.classic.dataframe import DataFrame

    from larder.llm import common, ngram_join

    df = spark.createDataFrame([], "doc_id bigint, text string")
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(120)).encode()) for i in range(1600)]
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in part]), pa.array([t for _, t in part])], names=["doc_id", "text"]) for part in (rows[:200], rows)]
    monkeypatch.setattr(ngram_join, "ROWS", 200, raising=False)
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, run, schema: run)
    run = ngram_join.signatures(df, 5, (75, 100), 8, "doc_id", "text")
    monkeypatch.setattr(common.WordHashes, "most", 1000)
    peaks, found = [], []
    for batch in batches:
        tracemalloc.start()
        found.append(sum(out.filter(out["keys"].is_null()).num_rows for out in map(lambda b: pa.Table.from_batches([b]), run(iter([batch])))))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert found == [200, 1600] and peaks[1] < 2 * peaks[0]

    class Costly:
        pass

    common.worker_state("one")["x"] = x = Costly()
    gone = weakref.ref(x)
    del x
    assert len(common.worker_state("one")) == 1
    assert len(common.worker_state("other")) == 0
    assert gone() is None
