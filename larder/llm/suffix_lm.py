"""Language-model scores by a probabilistic suffix tree.

The tree's symbols are the bytes of a text's tokens: words in lower case, one space between them, one
end sign. That spelling and the token sequence determine each other, so the score is the log
probability of the same tokens that the unigram base score counts. Contexts are the preceding bytes,
up to ``depth`` of them. A context is kept if it is seen often enough (``scale`` times the square root of all
training symbols, so the tree grows with the corpus while the evidence for each state grows too) and if its
next-symbol distribution diverges from that of the longest kept shorter one: count times divergence of at
least ``gain`` nats. Distributions are smoothed towards the shorter context's. Levels are tested one after the other on the
executors, against the levels before; kept contexts alone come to the driver. A symbol is scored in its
longest kept context.

Counts cover all training texts. Tasks count their own (context, next) runs and deal them out by
context; word counts and postings are dealt out by word, so no word's documents meet in one row.

Defined cases: null text counts as empty, which is the end token alone; without training texts every
count is 0 and the tree is uniform; a null id is of fold 0's text (empty) and stays null; repeated rows
are scored and learned as rows of their own; an empty table gives an empty result; texts may have any
length; columns other than id and text don't matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WordHashes, drop_written, fold, materialize, shuffle_width, words_of, worker_state

DEPTH = 5
#: Least sightings of a context, over the square root of all training symbols; least count times divergence (in nats).
SCALE, GAIN = 0.005, 3.0
#: Weight of the shorter context's distribution, in symbols.
PRIOR = 8.0
#: Neither byte occurs in a token: what stands before a text, and its end sign.
START, END = 9, 10
#: Symbols scored at once.
SLAB = 1 << 20


def spelled(words: list[bytes]) -> bytes:
    return b" ".join(words) + bytes([END])


def runs(text: bytes, depth: int) -> np.ndarray:
    """For each byte of a spelled text the byte and the ``depth`` before it, in one number (the byte lowest)."""
    x = np.frombuffer(bytes([START]) * depth + text, np.uint8).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for j in range(depth + 1):
        out = (out << np.uint64(8)) | x[j : j + len(text)]
    return out


def count_runs(docs: DataFrame, depth: int, width: int) -> DataFrame:
    """(run, n) over all spelled texts, as packed rows that hold whole contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, loose, size = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def settle():
            nonlocal held, counts, loose, size
            if loose:
                new, n = np.unique(np.concatenate(loose), return_counts=True)
                every, at = np.unique(np.concatenate([held, new]), return_inverse=True)
                held, counts = every, np.bincount(at, np.concatenate([counts, n]), len(every)).astype(np.int64)
                loose, size = [], 0

        for batch in batches:
            for cell in batch.column(0):
                made = runs(spelled(words_of(cell.as_py() or b"")), depth)
                loose.append(made)
                size += len(made)
                if size > 3_000_000:
                    settle()
        settle()
        bucket = ((held >> np.uint64(8)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(width)
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        held, counts, cut = held[order], counts[order].astype(np.uint32), np.searchsorted(bucket[order], np.arange(width + 1))
        full = [b for b in range(width) if cut[b] < cut[b + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), *(pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()) for x in (held, counts))],
            names=["bucket", "runs", "counts"],
        )

    return docs.mapInArrow(run, "bucket int, runs binary, counts binary")


def _last(run: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of runs."""
    return run & np.uint64((1 << 8 * n) - 1)


def _find(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``x`` stands, and whether it is there."""
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


class Tree:
    """Kept contexts by length: sorted (context, symbol) cells with their counts, and contexts with theirs."""

    def __init__(self, root: np.ndarray, levels: list[tuple[np.ndarray, ...]], prior: float):
        self.root, self.levels, self.prior = root, levels, prior

    def add_level(self, cells: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(cells)
        cells, n = cells[order], n[order]
        contexts, first = np.unique(cells >> np.uint64(8), return_index=True)
        self.levels.append((contexts, np.add.reduceat(n, first) if len(n) else n, cells, n))

    def chances(self, run: np.ndarray, top: int) -> np.ndarray:
        """The probability of each run's last byte after the ``top`` bytes before it; shorter runs are shared."""
        if not top:
            return self.root[run.astype(np.int64)]
        shorter, at = np.unique(_last(run, top), return_inverse=True)
        p = self.chances(shorter, top - 1)[at]
        contexts, seen, cells, n = self.levels[top - 1]
        if len(contexts):
            i, there = _find(contexts, run >> np.uint64(8))
            hit = np.flatnonzero(there)
            j, known = _find(cells, run[hit])
            p[hit] = (np.where(known, n[j], 0) + self.prior * p[hit]) / (seen[i[hit]] + self.prior)
        return p

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The log10 probability of each spelled text, a slab of symbols at a time."""
        depth = len(self.levels)
        flat = np.frombuffer(b"".join(bytes([START]) * depth + t for t in texts), np.uint8)
        end = np.cumsum([len(t) + depth for t in texts])
        begin = np.r_[0, end[:-1]]
        total = np.zeros(len(texts))
        for lo in range(0, len(flat) - depth, SLAB):
            part = flat[lo : lo + SLAB + depth].astype(np.uint64)
            size = len(part) - depth
            run = np.zeros(size, np.uint64)
            for j in range(depth + 1):
                run = (run << np.uint64(8)) | part[j : j + size]
            place = np.arange(lo + depth, lo + depth + size)
            owner = np.searchsorted(end, place, "right")
            own = np.flatnonzero(place - begin[owner] >= depth)  # not what stands before a text
            every, at = np.unique(run[own], return_inverse=True)
            total += np.bincount(owner[own], np.log10(self.chances(every, depth))[at], len(texts))
        return total


def _packed(sorted_cells: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Cells as steps from one to the next, and their counts, both compressed."""
    return zlib.compress(np.diff(sorted_cells, prepend=np.uint64(0)).tobytes()), zlib.compress(n.tobytes())


def _unpacked(cells: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    steps = [np.frombuffer(zlib.decompress(x), np.uint64) for x in cells]
    n = b"".join(map(zlib.decompress, counts))
    return np.concatenate([np.empty(0, np.uint64), *map(np.cumsum, steps)]), np.frombuffer(n, np.int64)


def learn_tree(train: DataFrame, depth: int, scale: float, gain: float, prior: float, width: int) -> Tree:
    """Counts all runs of ``train`` (one binary column) and grows the tree level by level."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        run = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["runs"]])
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["counts"]]).astype(np.int64)
        every, at = np.unique(run, return_inverse=True)
        n = np.bincount(at, n, len(every)).astype(np.int64)
        return pd.DataFrame({"runs": [every.tobytes()], "counts": [n.tobytes()], "total": [int(n.sum())]})

    spark = train.sparkSession
    counted = materialize(count_runs(train, depth, width).groupBy("bucket").applyInPandas(merge, "runs binary, counts binary, total bigint"), "runs")
    total = counted.agg(F.sum("total")).first()[0] or 0
    least = max(2.0, scale * math.sqrt(total))

    def shorten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Counts of shorter contexts by task, and full-depth ones that are frequent (a bucket holds all of those)."""
        for pdf in frames:
            for runs_, counts in zip(pdf["runs"], pdf["counts"]):
                run, n = np.frombuffer(runs_, np.uint64), np.frombuffer(counts, np.int64)
                for d in range(depth + 1):
                    every, at = np.unique(_last(run, d + 1), return_inverse=True)
                    m = np.bincount(at, n, len(every)).astype(np.int64)
                    if d == depth:
                        _, context = np.unique(every >> np.uint64(8), return_inverse=True)
                        often = np.bincount(context, m)[context] >= least if len(m) else np.empty(0, bool)
                        every, m = every[often], m[often]
                    yield pd.DataFrame({"level": d, "context": (every >> np.uint64(8)).astype(np.int64), "symbol": (every & np.uint64(255)).astype(np.int32), "n": m})

    parts = counted.mapInPandas(shorten, "level int, context bigint, symbol int, n bigint")
    cells = parts.groupBy("level", "context", "symbol").agg(F.sum("n").alias("n"))
    # A context has 256 next symbols at most, so it fits one row.
    whole = cells.groupBy("level", "context").agg(F.sum("n").alias("seen"), F.collect_list("symbol").alias("symbols"), F.collect_list("n").alias("counts"))
    frequent = materialize(whole.where((F.col("seen") >= least) | (F.col("level") == 0)), "contexts")
    drop_written(counted)

    root = np.full(256, prior / 256)
    for r in frequent.where("level = 0").collect():
        root[r["symbols"]] += r["counts"]
    tree = Tree(root / (total + prior), [], prior)
    for d in range(1, depth + 1):
        shorter = spark.sparkContext.broadcast((tree.root, tree.levels, prior))

        def diverging(frames: Iterator[pd.DataFrame], d: int = d, shorter=shorter) -> Iterator[pd.DataFrame]:
            """Cells of the contexts that tell more than the longest kept shorter ones."""
            known = Tree(*shorter.value)
            for pdf in frames:
                size = pdf["symbols"].map(len).to_numpy()
                if not len(size):
                    continue
                n = np.concatenate(pdf["counts"].to_numpy()).astype(np.int64)
                run = np.repeat(pdf["context"].to_numpy().astype(np.uint64) << np.uint64(8), size) | np.concatenate(pdf["symbols"].to_numpy()).astype(np.uint64)
                owner = np.repeat(np.arange(len(size)), size)
                told = np.bincount(owner, n * np.log(n / pdf["seen"].to_numpy()[owner] / known.chances(_last(run, d), d - 1)))
                keep = np.flatnonzero(told[owner] >= gain)
                keep = keep[np.argsort(run[keep])]
                cells, counts = _packed(run[keep], n[keep])
                yield pd.DataFrame({"cells": [cells], "counts": [counts]})

        kept = frequent.where(F.col("level") == d).mapInPandas(diverging, "cells binary, counts binary").toArrow()
        tree.add_level(*_unpacked(kept.column("cells").to_pylist(), kept.column("counts").to_pylist()))
        shorter.unpersist()
    drop_written(frequent)
    return tree


def _postings(tree, width: int):
    """A task's documents: their rows, and words with training counts and postings, dealt out by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_state("suffix_lm").setdefault("words", WordHashes())
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                key, number = (task << 32) + number, number + 1
                held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                words = [words_of(x.as_py() or b"") for x in part.column(2)]
                score = Tree(*tree.value).scores([spelled(w) for w in words])
                size = np.asarray([len(w) for w in words], np.int64)
                h = hashes.of([x for w in words for x in w])
                doc = np.repeat(np.arange(len(words), dtype=np.uint16), size)
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
                first = np.flatnonzero(new)
                times = np.diff(np.r_[first, len(h)]).astype(np.uint32)
                h, doc = h[first], doc[first]
                bucket = ((h >> np.uint64(20)) % np.uint64(width)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                h, doc, times, bucket = h[order], doc[order], times[order], bucket[order]
                cut = np.searchsorted(bucket, np.arange(width + 1))
                rows: list[tuple] = [(None, key, part.column(0)[i].as_py(), bool(held[i]), int(size[i]) + 1, float(score[i]), i, None, None, None, None, None) for i in range(len(words))]
                for b in range(width):
                    s = slice(cut[b], cut[b + 1])
                    if cut[b] < cut[b + 1]:
                        own = np.flatnonzero(np.r_[True, h[s][1:] != h[s][:-1]])
                        many = np.diff(np.r_[own, len(h[s])])
                        train = np.add.reduceat(np.where(held[doc[s]], 0, times[s]), own)
                        rows.append((b, key, None, None, None, None, None, h[s][own].tobytes(), train.astype(np.uint32).tobytes(), many.astype(np.uint16).tobytes(), doc[s].tobytes(), np.minimum(times[s], 2**32 - 1).astype(np.uint32).tobytes()))
                columns = list(zip(*rows))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.int32(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=NAMES)

    return run


NAMES = ["bucket", "part", "doc_id", "held_out", "n_tokens", "score", "place", "words", "train", "many", "docs", "times"]
POSTINGS = (
    "bucket int, part bigint, doc_id bigint, held_out boolean, n_tokens bigint, score double, place int,"
    " words binary, train binary, many binary, docs binary, times binary"
)


def _base(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket of words: training counts over all parts, then each part's documents' share of the base score."""
    def arrays(column: str, kind) -> list[np.ndarray]:
        return [np.frombuffer(x, kind) for x in pdf[column]]

    words, many, docs, times = arrays("words", np.uint64), arrays("many", np.uint16), arrays("docs", np.uint16), arrays("times", np.uint32)
    every, at = np.unique(np.concatenate(words), return_inverse=True)
    c = np.bincount(at, np.concatenate(arrays("train", np.uint32)), len(every))
    out, lo = [], 0
    for part, w, m, d, t in zip(pdf["part"], words, many, docs, times):
        own = np.repeat(c[at[lo : lo + len(w)]], m)
        lo += len(w)
        known = np.bincount(d, np.where(own > 0, t, 0)).astype(np.int64)
        base = np.bincount(d, t * np.log10(own + 0.1))
        has = np.flatnonzero(np.bincount(d))
        out.append(pd.DataFrame({"part": part, "place": has.astype(np.int32), "known": known[has], "base": base[has]}))
    stats = pd.DataFrame({"part": [-1], "place": [0], "known": [int((c > 0).sum())], "base": [float(c.sum())]})
    return pd.concat([*out, stats], ignore_index=True)


def suffix_scores(docs: DataFrame, parts: int = 10, depth: int = DEPTH, scale: float = SCALE, gain: float = GAIN, prior: float = PRIOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), (fold(doc_id, parts) == 0).alias("held_out"), F.col(text).cast("binary").alias("text")
    )
    tree = learn_tree(rows.where("not held_out").select("text"), depth, scale, gain, prior, width)
    tree = spark.sparkContext.broadcast((tree.root, tree.levels, tree.prior))
    posted = rows.mapInArrow(_postings(tree, width), POSTINGS)
    # Document rows and word rows leave one scan; where they go apart both read the same written table.
    posted = materialize(posted, "postings")
    own = posted.where("bucket is null").select("part", "place", "doc_id", "held_out", "n_tokens", "score")
    base = posted.where("bucket is not null").select("bucket", "part", "words", "train", "many", "docs", "times")
    base = materialize(base.groupBy("bucket").applyInPandas(_base, "part bigint, place int, known bigint, base double"), "base-scores")
    ends = own.where("not held_out").count()
    stats = base.where("part < 0").agg(F.sum("known"), F.sum("base")).first()
    distinct, total = (stats[0] or 0) + (ends > 0), int(stats[1] or 0) + ends
    rest = math.log10(total + 0.1 * (distinct + 1))
    sums = base.where("part >= 0").groupBy("part", "place").agg(F.sum("known").alias("known"), F.sum("base").alias("base"))
    return own.join(sums, ["part", "place"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.coalesce("known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.coalesce("base", F.lit(0.0)) + math.log10(ends + 0.1) - F.col("n_tokens") * rest).alias("base_score"),
        "score",
    )
