"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded: shares of kinds of bytes,
word shapes and repetition, and hashed words. A layer with tanh turns the encoding into a
representation, a gated attention layer (tanh times sigmoid) weighs the passages, and the weighted
representation gives the document's score. Only documents carry labels; the attention weights are
learned from them. The fit runs on the driver over a bounded sample of labelled documents: the first
``sample`` ones by a hash of the id that have at most ``most_passages`` passages.

Defined cases: null text is empty, and an empty text is one passage without words, which has a score
like any other; unlabelled documents and null labels don't train; without both labels in the sample
every score is the smoothed share of label 1; a null id is of the empty text's fold and stays null;
repeated rows are scored as rows of their own; labels given twice train twice; texts may have any
length; columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LOWER, fold, handing_back, mix64, worker_state

PASSAGE = 64
HASHED = 64
HIDDEN, GATE = 24, 12
SAMPLE, MOST_PASSAGES = 4000, 256
STEPS, RATE, DECAY, SEED = 160, 0.02, 1e-4, 11
#: Scores from here on predict label 1.
CUT = 0.3

_KINDS = ("lower", "upper", "digit", "newline", "space", "stop", "other", "high")
_KIND = np.full(256, 6, np.int8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 7
_KIND[[9, 11, 12, 13, 32]], _KIND[10], _KIND[[44, 46, 58, 59, 33, 63, 39, 34, 45]] = 4, 3, 5
SHAPES = 12
SIZE = len(_KINDS) + SHAPES + HASHED
_FOLD = np.frombuffer(LOWER, np.uint8)
_POWER = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)


def encode(text: bytes, passage: int = PASSAGE) -> np.ndarray:
    """One row for each passage of ``passage`` words; at least one row."""
    x = np.frombuffer(text, np.uint8)
    kind = _KIND[x]
    inside = np.r_[False, (kind != 3) & (kind != 4), False]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    n = len(start)
    if not n:
        return np.zeros((1, SIZE), np.float32)
    bags = -(-n // passage)
    bag = np.arange(n) // passage
    first = np.arange(0, n, passage)
    words = np.diff(np.r_[first, n]).astype(np.float64)
    # Bytes from each passage's first word up to the next passage's.
    at = np.r_[0, start[first[1:]], len(x)]
    span = np.repeat(np.arange(bags), np.diff(at))
    kinds = np.bincount(span * len(_KINDS) + kind, minlength=bags * len(_KINDS)).reshape(bags, -1)
    size = kinds.sum(axis=1, keepdims=True)
    # Word hashes: folded bytes times powers of a prime, summed over the word.
    length = end - start
    place = np.arange(len(x)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(x)]))
    term = (_FOLD[x].astype(np.uint64) + np.uint64(1)) * _POWER[place & 63]
    term[~inside[1:-1]] = 0
    h = mix64(np.add.reduceat(term, start))
    again = np.r_[False, h[1:] == h[:-1]] & (np.arange(n) % passage > 0)
    order = np.lexsort((h, bag))
    sorted_h, sorted_bag = h[order], bag[order]
    new = np.flatnonzero(np.r_[True, (sorted_h[1:] != sorted_h[:-1]) | (sorted_bag[1:] != sorted_bag[:-1])])
    times = np.diff(np.r_[new, n])
    last = kind[end - 1]

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(bag, mask, bags) / words

    lengths = share(length)
    shapes = np.stack(
        [
            lengths,
            np.sqrt(np.maximum(share(length.astype(float) ** 2) - lengths**2, 0)),
            share(again),
            np.bincount(sorted_bag[new], minlength=bags) / words,
            np.maximum.reduceat(times, np.searchsorted(sorted_bag[new], np.arange(bags))) / words,
            share(length == 1),
            share(length <= 3),
            share(length >= 12),
            share(last == 6),
            share((last == 5) & (length > 1)),
            share(kind[start] == 1),
            np.log(words),
        ],
        axis=1,
    )
    hashed = np.bincount(bag * HASHED + (h % np.uint64(HASHED)).astype(np.int64), minlength=bags * HASHED).reshape(bags, -1)
    return np.concatenate([kinds / size, shapes, np.sqrt(hashed / words[:, None])], axis=1).astype(np.float32)


class Attention:
    """The classifier: encoding -> representation, gated attention over passages, logistic output."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts

    def forward(self, unit: np.ndarray, first: np.ndarray):
        p = self.parts
        size = np.diff(np.r_[first, len(unit)])
        h = np.tanh(unit @ p["w"] + p["wb"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
        weight = e / np.repeat(np.add.reduceat(e, first), size)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        out = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["cb"], -30, 30)))
        return out, (size, h, t, g, weight, z)

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward((x - self.parts["mean"]) / self.parts["scale"], first)[0]

    @staticmethod
    def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Attention:
        rng = np.random.default_rng(seed)
        x = x.astype(np.float64)
        parts = {
            "mean": x.mean(axis=0), "scale": x.std(axis=0) + 0.02,
            "w": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), "wb": np.zeros(HIDDEN),
            "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "a": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "cb": np.zeros(1),
        }
        model = Attention(parts)
        y = label.astype(np.float64)
        unit = (x - parts["mean"]) / parts["scale"]
        moment = {k: (np.zeros_like(parts[k]), np.zeros_like(parts[k])) for k in ("w", "wb", "v", "u", "a", "c", "cb")}
        for step in range(1, steps + 1):
            out, (size, h, t, g, weight, z) = model.forward(unit, first)
            d = (out - y) / len(y)
            dz = np.repeat(d, size)[:, None] * parts["c"]
            # Through the weighted sum, the softmax within each document, and the gate.
            pull = (dz * h).sum(axis=1)
            de = weight * (pull - np.repeat(np.add.reduceat(weight * pull, first), size))
            dt, dg = np.outer(de, parts["a"]) * g * (1 - t * t), np.outer(de, parts["a"]) * t * g * (1 - g)
            dh = (weight[:, None] * dz + dt @ parts["v"].T + dg @ parts["u"].T) * (1 - h * h)
            slope = {
                "w": unit.T @ dh, "wb": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
                "c": z.T @ d, "cb": np.asarray([d.sum()]),
            }
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, s in slope.items():
                s = s + DECAY * parts[k] * (k in "wvuac")
                m, v = moment[k]
                m += 0.1 * (s - m)
                v += 0.001 * (s * s - v)
                parts[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        return model


def _bags(docs: DataFrame, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [encode(x.as_py() or b"") for x in batch.column(1)]
            few = [i for i, r in enumerate(rows) if len(r) <= most]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(few, pa.int64())), pa.array([rows[i].tobytes() for i in few], pa.binary())], names=["quality", "bag"]
            )

    return docs.mapInArrow(run, "quality int, bag binary")


def learn(docs: DataFrame, labels: DataFrame, parts: int = 5, sample: int = SAMPLE, most_passages: int = MOST_PASSAGES, doc_id: str = "doc_id", text: str = "text") -> Attention | float:
    """A fitted classifier from labels outside fold 0, or one score for all where a label is missing."""
    order = F.xxhash64("_label_id"), F.col("_label_id"), F.col("quality")
    chosen = (
        labels.select(F.col("doc_id").alias("_label_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isNotNull() & (fold("_label_id", parts) != 0)).orderBy(*order).limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("_label_id"), F.col(text).cast("binary").alias("_text"))
    bags = _bags(rows.join(F.broadcast(chosen), "_label_id").select("quality", "_text"), most_passages).toArrow()
    bags = bags.sort_by([("quality", "ascending"), ("bag", "ascending")])  # the same order whatever the partitions
    y = bags.column("quality").to_numpy() > 0
    if not len(y) or y.all() or not y.any():
        return (float(y.sum()) + 1) / (len(y) + 2)
    rows = [np.frombuffer(b.as_buffer(), np.float32).reshape(-1, SIZE) for b in bags.column("bag")]
    size = np.asarray([len(r) for r in rows])
    return Attention.fit(np.concatenate(rows), np.cumsum(size) - size, y)


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, cut: float = CUT, doc_id: str = "doc_id", text: str = "text", keep: bool = False, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted; or with ``keep`` the rows of ``docs`` that are predicted 1."""
    model = learn(docs, labels, parts, doc_id=doc_id, text=text, **options)
    weights = model.parts if isinstance(model, Attention) else None

    def score(texts: list) -> np.ndarray:
        if weights is None:
            return np.full(len(texts), model)
        made, out = Attention(weights), []
        for lo in range(0, len(texts), 256):
            rows = [encode(x or b"") for x in texts[lo : lo + 256]]
            size = np.asarray([len(r) for r in rows])
            out.append(made.score(np.concatenate(rows), np.cumsum(size) - size))
        return np.concatenate(out) if out else np.empty(0)

    if keep:
        place = docs.columns.index(text)

        def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            worker_state("quality")
            for batch in batches:
                texts = batch.column(place).cast(pa.binary())
                good = [score(texts.slice(lo, 256).to_pylist()) >= cut for lo in range(0, len(texts), 256)]
                yield batch.filter(pa.array(np.concatenate([np.empty(0, bool), *good])))

        return docs.mapInArrow(handing_back(filtered), docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), (fold(doc_id, parts) == 0).alias("held_out"), F.col(text).cast("binary").alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
