"""The registered queries on hand-made tables with nulls, ties, repeated rows and hot groups, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from larder.llm import suffix_dedup
from larder.llm.embedding_dedup import near_vectors
from larder.llm.exact_dedup import DigestIndex, exact_duplicates
from larder.llm.exact_dedup import keep_documents as keep_exact
from larder.llm.licenses import license_report, scan_licenses
from larder.llm.mil_quality import quality_scores
from larder.llm.mixing import mix_documents, with_copies
from larder.llm.ngram_join import keep_documents as keep_near
from larder.llm.ngram_join import ngram_classes
from larder.llm.packing import pack
from larder.llm.queries import tokenizer_file
from larder.llm.suffix_dedup import without_repeats
from larder.llm.suffix_lm import suffix_scores
from larder.llm.token_counts import attach_edits, recount

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, kind string, rep int, mark int"


def words(n, seed, vocabulary=400):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, vocabulary, n)]


def rows():
    base = words(300, 1)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE two"), (6, "a b c d e"), (7, "x"), (7, "x")]
    out += [(10 + i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(0, 120, 7)]
    out += [(200 + i, " ".join(base)) for i in range(30)]
    out += [(230, "  ".join(base)), (231, " ".join(base) + " ")]
    out += [(300 + i, " ".join(words(5 + i, 50 + i))) for i in range(40)]
    out += [(400, " ".join(words(9000, 3))), (401, "la " * 3000), (402, "é" * 5000), (403, "ab" * 400)]
    out += [(500, "Under the MIT License. Apache License, Version 2.0\nSPDX-License-Identifier: (MIT OR GPL-3.0-only)")]
    out += [(None, " ".join(base)), (None, None)]
    return [(i, t, "en", f"s{(i or 0) % 4}" if (i or 0) % 5 else None, 0, "k", "d", 1, 2) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    return (text or "").encode().translate(LOWER).split()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact(docs, empty):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, t))
    got = exact_duplicates(docs).collect()
    assert len(got) == len(rows())
    by_hash = defaultdict(list)
    for r in got:
        by_hash[r.text_sha256].append(r)
    for text, members in groups.items():
        own = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        best = min(members)
        assert len(own) == len(members) and all(r.group_size == len(members) for r in own)
        assert {r.keep_id for r in own} == {None if best[1] else best[2]}
        assert [r.doc_id for r in own if r.kept] == [None if best[1] else best[2]]
    kept = keep_exact(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_duplicates(empty).collect() == [] and keep_exact(empty).collect() == []


def test_digest_index_knows_earlier_loads(spark, docs, tmp_path):
    index = DigestIndex(spark, "larder_test_index", 4)
    try:
        first = index.add(docs.where("doc_id < 300"))
        assert first.where("kept").count() == index.read().count()
        again = index.add(docs)
        assert again.where("kept and doc_id < 300").count() == 0
        assert again.where("doc_id = 230").first().keep_id == 230
        assert index.read().groupBy("digest").count().where("count > 1").count() == 0
        facts = {r.col_name: r.data_type for r in spark.sql("describe extended larder_test_index").collect()}
        assert (facts["Num Buckets"], facts["Bucket Columns"], facts["Sort Columns"]) == ("4", "[`digest`]", "[`digest`]")
    finally:
        index.drop()


def brute_classes():
    sets = {}
    for i, t, *_ in rows():
        w = tokens(t)
        sets[i, t] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    items = [(i, s) for (i, _), s in sets.items() if i is not None and s]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(items):
        for j, t in items[:a]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(sets[i, t]), None if i is None else find(i)) for i, t, *_ in rows())


def test_ngram_classes(docs, empty):
    want = brute_classes()
    assert bag(ngram_classes(docs)) == want
    kept = keep_near(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for (i, _, c), n in want.items() if i is None or i == c)
    assert ngram_classes(empty).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_ngram_chains(spark, seed):
    """Chains of edits, where neighbours link and far ones don't, and many sets around the threshold."""
    rng = np.random.default_rng(seed)
    texts, w = [], words(int(rng.integers(12, 200)), seed)
    for _ in range(60):
        w = list(w)
        for _ in range(int(rng.integers(1, 3))):
            w[int(rng.integers(len(w)))] = f"e{rng.integers(10**6)}"
        texts.append(" ".join(w))
    sets = [frozenset(tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)) for t in texts]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for i, s in enumerate(sets):
            for j, t in enumerate(sets):
                if 100 * len(s & t) >= 75 * len(s | t):
                    root[i] = root[j] = min(root[i], root[j])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in ngram_classes(df).collect()} == dict(enumerate(root))


def test_repeats(docs, empty):
    seen, want = {}, Counter()
    named = sorted({(i, t or "") for i, t, *_ in rows() if i is not None})
    result = {}
    for i, t in named:
        x = t.encode()
        gone = bytearray(len(x))
        for s in range(len(x) - 99):
            if x[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.setdefault(x[s : s + 100], (i, s))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        result[i] = (len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    for i, t, *_ in rows():
        x = (t or "").encode()
        want[(i, *(result[i] if i is not None else (len(x), 0, 0, hashlib.sha256(x).hexdigest())))] += 1
    assert bag(without_repeats(docs)) == want
    assert without_repeats(empty).collect() == []


def removed(spark, texts, **settings):
    """Of (id, text) rows: those of without_repeats, and by brute force, where only a smaller place counts."""
    least = {}
    for i, t in texts:
        for s in range(len(t) - 99):
            least[t[s : s + 100]] = min(least.get(t[s : s + 100], (i, s)), (i, s))
    want = Counter()
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - 99):
            if least[t[s : s + 100]] < (i, s):
                gone[s : s + 100] = b"\1" * 100
        kept = "".join(c for c, g in zip(t, gone) if not g)
        want[i, len(t), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in without_repeats(df, **settings).collect()), want


def test_repeats_of_one_id(spark):
    a, b, c, d = (" ".join(words(90, 900 + i)) for i in range(4))
    # A repeated long row, in one task and over several, and different texts with one id.
    texts = [(1, a)] * 5 + [(2, b + " " + a)] * 3 + [(3, c), (3, d + " " + a), (3, c[:200] + d), (4, d), (4, d)]
    got, want = removed(spark, texts)
    assert got == want


@pytest.mark.parametrize("window", [32, 200, 400])
def test_windows_of_other_lengths(spark, window):
    a, b = (" ".join(words(120, 980 + i)) for i in range(2))
    texts = [(1, a), (2, b[:90] + a + b), (3, b), (4, a[:150] + b[:300]), (5, a[3:] + a)]
    least, want = {}, {}
    for i, t in texts:
        gone = set()
        for s in range(len(t) - window + 1):
            if t[s : s + window] in least:
                gone.update(range(s, s + window))
            least.setdefault(t[s : s + window], (i, s))
        want[i] = len(gone)
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.doc_id: r.n_removed for r in without_repeats(df, window=window).collect()} == want
    with pytest.raises(ValueError, match="window"):
        without_repeats(df, window=window + 1)


def test_repeats_of_a_hot_passage(spark, docs):
    # One passage in many texts whose edges all differ, and a text that repeats itself: groups of over three strings are dealt out.
    passage = " ".join(words(60, 950))
    texts = [(i, " ".join(words(20, 1000 + i)) + passage + " ".join(words(20, 2000 + i))) for i in range(60)]
    texts += [(70, "la " * 200), (71, passage + passage), (71, passage + "x"), (71, passage + "x")]
    got, want = removed(spark, texts, hot=3)
    assert got == want
    assert bag(without_repeats(docs, hot=1)) == bag(without_repeats(docs))


def test_hot_minimizers_are_dealt_out():
    n = 50
    key, whole = np.full(n + 2, 5, np.uint64), np.arange(n + 2, dtype=np.uint64)
    key[n:] = 6
    doc, one = np.arange(n + 2), np.ones(n + 2, np.int64)
    rows = suffix_dedup.pack_rows(suffix_dedup.RUN, np.zeros(n + 2, np.int32), key=key, whole=whole, doc=doc, first=one, size=one)
    out = suffix_dedup._split(48, 10)(suffix_dedup.frame(rows))
    doc, size = suffix_dedup.unpack(out[out["kind"] == suffix_dedup.OPEN], "doc", "size")
    assert sorted(doc) == list(range(n + 2)) and set(doc[size & suffix_dedup.WIDE > 0]) == set(range(n))


def test_mix(docs, empty):
    got = with_copies(docs).select("doc_id", "source", "_mix.*").collect()
    assert len(got) == len(rows())
    size = Counter()
    for r in got:
        size[r.source] += r.size
    weights = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [3, 1, 2] * 9))
    goal, open_ = 1.5 * sum(size.values()), dict(weights)
    target = {}
    while open_:
        level = goal / sum(open_.values())
        full = [s for s in open_ if open_[s] * level > 2 * size[s]]
        if not full:
            target |= {s: w * level for s, w in open_.items()}
            break
        for s in full:
            target[s] = 2.0 * size[s]
            goal -= target[s]
            del open_[s]
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    biggest = {s: max(r.size for r in got if r.source == s) for s in size}
    assert all(abs(taken[s] - target[s]) <= 1.5 * biggest[s] for s in size)
    assert bag(with_copies(docs).select("doc_id", "_mix")) == bag(with_copies(docs.repartition(7)).select("doc_id", "_mix"))
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert with_copies(empty).collect() == []


def test_pack(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    ids = {(i, x): t.encode(x or "", add_special_tokens=False).ids + [1] for i, x, *_ in rows()}
    got = pack(docs, tokenizer_file(), with_ids=True).collect()
    whole = Counter((i, zlib.crc32(np.asarray(v, "<u4").tobytes())) for (i, x), v in ids.items() for j, y, *_ in rows() if (i, x) == (j, y))
    assert sum(r.length for r in got) == sum(len(ids[i, x]) for i, x, *_ in rows())
    pieces = defaultdict(list)
    places = defaultdict(list)
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id, r.doc_tokens].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for at, length in sorted(own):
            assert at == end
            end += length
        assert end <= 2048
    once = [(k, v) for k, v in pieces.items() if k[0] in (6, 400, 402)]
    assert once
    for (i, _), own in once:
        joined = b"".join(bytes(r.ids) for r in sorted(own, key=lambda r: r.start))
        assert whole[i, zlib.crc32(joined)] == 1
    padding = sum(2048 - n for n in (sum(x[1] for x in own) for own in places.values()) if n & (n - 1))
    assert padding <= 4096
    assert pack(empty, tokenizer_file()).collect() == []


def test_licenses(docs, empty):
    got = {(r.doc_id, r.n_words): r for r in license_report(scan_licenses(docs)).collect()}
    r = next(r for r in got.values() if r.doc_id == 500)
    assert (r.n_base, r.first_word, r.last_word) == (2, 0, 4)
    assert r.base_labels == "apache-2,mit" and r.labels == "apache-2,gpl-3,mit" and r.score == 1.0
    for i, t, *_ in rows():
        n = len(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER)))
        assert (i, n) in got
    assert got[1, 0].labels == "" and got[1, 0].first_word is None and got[1, 0].score == 0
    assert license_report(scan_licenses(empty)).collect() == []


def test_license_tags(spark):
    tag = "SPDX-License-Identifier:"
    texts = {
        f"{tag} MIT ... {tag} GPL-3.0-only": ("gpl-3,mit", 0.5),
        f"a {tag} MIT b {tag}\n// MPL-2.0\nand so on": ("mit,mpl-2", 0.7),
        f"{tag}\n(GPL-2.0-only OR\n MIT)\nthe end": ("gpl-2,mit", 1.0),
        f"{tag} GPL-2.0-only\n  OR Apache-2.0\nor else": ("apache-2,gpl-2", 1.0),
        f"é {tag} {tag} (ISC\nfor all": ("isc", 1.0),
        f"SPDX\nLicense Identifier\n\nMIT and CC-BY-NC-4.0 {tag}": ("cc-by-nc,mit", 0.2),
        tag: ("", 0.0),
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_report(scan_licenses(df)).collect()}
    assert got == dict(enumerate(texts.values()))


def test_suffix_scores(docs, empty):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows()}
    count = Counter()
    for i, t, *_ in rows():
        if not held[i]:
            count.update([*tokens(t), b"\n"])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t, *_ in rows():
        w = [*tokens(t), b"\n"]
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[i, held[i], len(w), sum(count[x] > 0 for x in w), n, round(base, 4)] += 1
    got = suffix_scores(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert suffix_scores(empty).collect() == []
    nothing = suffix_scores(docs.where("doc_id is null or crc32(cast(doc_id as string)) % 10 = 0")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing)


def tree_scores(train, texts, depth, scale, gain, prior):
    """Scores of spelled texts by a tree made with plain dicts."""
    seen, follow = Counter(), Counter()
    for t in train:
        t = b"\t" * depth + t
        for i in range(depth, len(t)):
            for d in range(depth + 1):
                seen[t[i - d : i]] += 1
                follow[t[i - d : i], t[i]] += 1
    total = seen[b""]
    least, kept = max(2, scale * math.sqrt(total)), {b""}

    def chance(context, x):
        if not context:
            return (follow[b"", x] + prior / 256) / (total + prior)
        p = chance(context[1:], x)
        return (follow[context, x] + prior * p) / (seen[context] + prior) if context in kept else p

    for d in range(1, depth + 1):
        for c in [c for c in seen if len(c) == d and seen[c] >= least]:
            nexts = [(x, n) for (k, x), n in follow.items() if k == c]
            if sum(n * math.log(n / seen[c] / chance(c[1:], x)) for x, n in nexts) >= gain:
                kept.add(c)
    out = []
    for t in texts:
        t = b"\t" * depth + t
        out.append(sum(math.log10(chance(t[i - depth : i], t[i])) for i in range(depth, len(t))))
    return out, len(kept) - 1


def test_suffix_tree_against_plain_dicts(spark, monkeypatch):
    from larder.llm import suffix_lm as lm

    train = [lm.spelled([w.encode() for w in words(25, 700 + i)]) for i in range(12)] + [lm.spelled([])]
    texts = [lm.spelled([w.encode() for w in words(30, 800 + i)]) for i in range(4)] + [b"\n", "\u00fc\u00df zz\n".encode()]
    for depth, scale, gain in ((3, 0.05, 2.0), (4, 0.2, 6.0)):
        df = spark.createDataFrame([(bytes(t[:-1]),) for t in train], "text binary").repartition(3)
        tree = lm.learn_tree(df, depth, scale, gain, 8.0, 5)
        want, states = tree_scores(train, texts, depth, scale, gain, 8.0)
        monkeypatch.setattr(lm, "SLAB", 57)
        assert tree.scores(texts) == pytest.approx(want)
        assert sum(len(level[0]) for level in tree.levels) == states > 10


def test_the_suffix_tree_grows_with_the_corpus(spark, sf_dir):
    from larder.llm import suffix_lm as lm

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("cast(coalesce(text, '') as binary) as text", "doc_id")
    sizes = [sum(len(x[0]) for x in lm.learn_tree(docs.where(f"doc_id % 5 < {k}").select("text"), 5, lm.SCALE, lm.GAIN, lm.PRIOR, 8).levels) for k in (1, 5)]
    assert sizes[1] > 1.3 * sizes[0]


def test_token_counts(spark, docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    edits = spark.createDataFrame(
        [(4, 1, 0, 3, "ten"), (4, 0, 3, 1, "  "), (400, 0, 20_000, 7, "cut here"), (400, 1, 10**9, 5, " end"), (2, 0, 5, 5, "filled"), (6, 0, 1, None, None)],
        "doc_id bigint, seq int, start bigint, deleted bigint, inserted string",
    )
    text = {i: x or "" for i, x, *_ in rows()}
    after = dict(text)
    after[4] = "ten  two"
    after[400] = text[400][:20_000] + "cut here" + text[400][20_007:] + " end"
    after[2] = "filled"
    got = recount(attach_edits(docs, edits), tokenizer_file()).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is not None:
            assert r.n_tokens == len(t.encode(text[r.doc_id], add_special_tokens=False).ids)
            assert r.n_tokens_after == len(t.encode(after[r.doc_id], add_special_tokens=False).ids) == sum(r.leaf_tokens)
            assert r.n_chars_after == len(after[r.doc_id]) == sum(r.leaf_chars)
    assert next(r for r in got if r.doc_id == 400).n_encoded_chars < 3000
    assert recount(attach_edits(empty, edits), tokenizer_file()).collect() == []


def test_quality(spark, docs):
    good = [(1000 + i, " ".join(words(150, i))) for i in range(160)]
    bad = [(2000 + i, " ".join(words(90, i)) + " " + "buy### now$$$ " * 40) for i in range(80)]
    df = spark.createDataFrame([*good, *bad, (1, None), (None, ""), (1000, good[0][1])], "doc_id bigint, text string")
    labels = spark.createDataFrame([*((i, 1, 0) for i, _ in good), *((i, 0, 0) for i, _ in bad), (1, None, None), (None, None, 1)], "doc_id bigint, quality int, toxic int")
    got = quality_scores(df, labels).collect()
    assert len(got) == 243 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id >= 1000:
            assert r.predicted == (r.doc_id < 2000)
    kept = quality_scores(df, labels, keep=True)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    assert {r.score for r in quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(df.limit(0), labels).collect() == []


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 24))
    near = base[:100] + 0.25 * rng.standard_normal((100, 24))
    cluster = base[0] + 0.3 * rng.standard_normal((150, 24))
    x = np.concatenate([base, near, cluster, np.repeat(base[1:2], 60, 0), 3 * base[2:3]])
    data = [(i, v.tolist(), "z") for i, v in enumerate(x)]
    odd = [(5000, None, "z"), (5001, [], "z"), (5002, [0.0] * 24, "z"), (5003, [float("nan")] * 24, "z"), (5004, [1.0, None] * 12, "z"), (None, base[0].tolist(), "z"), (5005, [1.0, 2.0], "z")]
    df = spark.createDataFrame([*data, *odd, data[7]], "vec_id bigint, embedding array<double>, rep string").repartition(3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    root = np.arange(len(x))
    while True:
        new = np.asarray([root[m].min() for m in linked])
        if (new == root).all():
            break
        root = new
    got = near_vectors(df).collect()
    assert len(got) == len(data) + len(odd) + 1
    links = {r.vec_id: r.n_links for r in got}
    want = linked.sum(axis=1) - 1
    assert all(links[i] <= want[i] for i in range(len(x)))
    assert sum(links[i] for i in range(len(x))) >= 0.95 * want.sum()
    assert np.mean([r.component_id == root[r.vec_id] for r in got if r.vec_id is not None and r.vec_id < 5000]) > 0.95
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if r.vec_id is None or r.vec_id >= 5000)
    assert near_vectors(df.limit(0)).collect() == []


def test_vectors_of_one_id(spark):
    # Id 7 names two unlike vectors, each near another one; -0.0 is 0.0.
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    data = [(7, x), (7, y), (7, y), (3, [1.0, 0.1, -0.0]), (9, [0.1, 1.0, 0.0]), (8, [1.0, -0.0, 0.0])]
    got = sorted(tuple(r) for r in near_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), recall=0.999999).collect())
    assert got == [(3, 2, 3, True), (7, 1, 7, True), (7, 1, 7, True), (7, 2, 3, False), (8, 2, 3, False), (9, 1, 7, False)]
