"""The pipeline against a brute-force version, the components of pairs, the merge of transforms, and the windows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from larder.llm.components import components
from larder.llm.mil_quality import quality_scores
from larder.llm.packing import best_fit, fit
from larder.llm.queries import ORACLES, QUERIES, tokenizer_file
from larder.llm.suffix_dedup import merged_blocks
from larder.llm.windows import minimizer_runs

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(900)]

    def text(n):
        return " ".join(rng.choice(vocabulary, n))

    rows = [(i, text(int(rng.integers(20, 400)))) for i in range(120)]
    bad = [(1000 + i, text(60) + " " + "x### y$$$ " * 60) for i in range(60)]
    copies = [(200 + i, rows[i % 7][1]) for i in range(25)] + [(230 + i, rows[i][1] + "\n\n") for i in range(5)]
    near = [(300 + i, rows[i % 5][1].rsplit(" ", 2)[0] + f" tail{i}") for i in range(20)]
    odd = [(400, None), (401, ""), (402, text(6000)), (119, rows[119][1]), (None, text(50))]
    docs = [(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 7 else None, 1) for i, t in [*rows, *bad, *copies, *near, *odd]]
    labels = [(i, 1, 0) for i, _ in rows] + [(i, 0, 0) for i, _ in bad]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, COLUMNS).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append(docs.collect())
    return out


def test_pipeline_against_brute_force(spark, sf):
    start, good, unique, apart, mixed = stages(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    predicted = {r.doc_id: r.predicted for r in quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert Counter(good) == Counter(r for r in start if predicted[r.doc_id])
    assert all(r.doc_id is None or r.doc_id < 1000 for r in good)
    assert {r.doc_id for r in start if r.doc_id is not None and r.doc_id < 120} <= {r.doc_id for r in good}

    best = {}
    for r in good:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        rank = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)
        best[key] = min(best.get(key, rank), rank)
    assert Counter((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in unique) == Counter(best.values())

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    named = [(r.doc_id, shingles(r.text)) for r in unique if r.doc_id is not None]
    root = {i: i for i, _ in named}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(named):
        for j, t in named[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert Counter(apart) == Counter(r for r in unique if r.doc_id is None or find(r.doc_id) == r.doc_id)

    size = Counter()
    for r in apart:
        size[r.source] += len((r.text or "").split())
    times = Counter(mixed)
    assert set(times) <= set(apart) and max(times.values()) <= 2
    taken = Counter()
    for r, n in times.items():
        taken[r.source] += n * len((r.text or "").split())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 0.2 * sum(size.values())
    assert all(n <= 2 * size[s] for s, n in taken.items())

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    want = Counter()
    for r, n in times.items():
        tokens = len(t.encode(r.text or "", add_special_tokens=False).ids) + 1
        for at in range(0, tokens, 2048):
            want[r.doc_id, at, min(2048, tokens - at), tokens] += n
    packed = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens) for r in packed) == want
    used = defaultdict(list)
    for r in packed:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= 2048


def test_registered(spark):
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in QUERIES if k != "pipeline"}
    assert set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5, 4), (4, 5)]
    pairs += [tuple(map(int, p)) for p in rng.integers(2000, 2200, (90, 2))]
    root = {}
    for p in pairs:
        for x in p:
            root.setdefault(x, x)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in got} == {(i, find(i)) for i in root if find(i) != i}
    assert len(got) == len({r.node for r in got})
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("shard", [60, 400, 10**6])
def test_merged_transforms(seed, shard):
    """Blocks are the groups of equal windows, whatever the shards; texts that repeat themselves too."""
    rng = np.random.default_rng(seed)
    window = 20
    base = [rng.integers(0, 2 + seed * 40, 60).astype(np.uint8) for _ in range(3)]
    strings = [np.concatenate([base[rng.integers(3)][: rng.integers(20, 60)], rng.integers(0, 256, rng.integers(0, 30)).astype(np.uint8)]) for _ in range(25)]
    strings += [np.tile(np.asarray([1, 2, 3], np.uint8), 20), np.zeros(50, np.uint8), base[0], base[0]]
    length = np.asarray([len(s) for s in strings])
    text = np.concatenate(strings)
    place, block = merged_blocks(text, length, window, 4, shard)
    assert sorted(place) == list(range(len(text)))
    ends = np.repeat(np.cumsum(length), length)
    groups = defaultdict(set)
    for p, b in zip(place, block):
        if p + window <= ends[p]:
            groups[b].add(int(p))
    want = defaultdict(set)
    for p in range(len(text)):
        if p + window <= ends[p]:
            want[text[p : p + window].tobytes()].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_minimizer_runs():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 256, 700), np.zeros(500), np.tile([1, 2], 200), rng.integers(0, 3, 300)]).astype(np.uint8)
    v, first, size, whole, again = minimizer_runs(x, 100, 32)
    assert sorted(np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)) == list(range(len(x) - 99))
    assert size.max() <= 69
    of = defaultdict(set)
    for m, a, n, flag in zip(v.tolist(), first.tolist(), size.tolist(), again.tolist()):
        seen = [x[i : i + 100].tobytes() for i in range(a, a + n)]
        assert flag or len(set(seen)) == n
        for s in seen:
            of[s].add(m)
    assert all(len(m) == 1 for m in of.values())
    assert len(minimizer_runs(x[:99], 100, 32)[0]) == 0
    same = minimizer_runs(np.concatenate([x, x]), 100, 32)
    assert set(whole.tolist()) & set(same[3].tolist())


def test_fit_and_best_fit():
    rng = np.random.default_rng(4)
    count = np.zeros(2049, np.int64)
    for n in np.minimum(2048, rng.lognormal(6, 0.9, 20_000).astype(int) + 1):
        count[n] += 1
    used = fit(count, 2048)
    spent = np.zeros(2049, np.int64)
    for c, n in used:
        assert sum(c) == 2048 and n > 0 and len(c) <= 4
        for x in c:
            spent[x] += n
    assert (spent <= count).all()
    assert (spent * np.arange(2049)).sum() > 0.8 * (count * np.arange(2049)).sum()
    rest = np.repeat(np.arange(2049), count - spent)
    where, at = best_fit(rest, 2048)
    ends = Counter()
    for b, o, n in sorted(zip(where.tolist(), at.tolist(), rest.tolist())):
        assert o == ends[b]
        ends[b] += n
    assert max(ends.values()) <= 2048
    assert len(ends) <= math.ceil(rest.sum() / 2048 * 1.03) + 1
