"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors at cosine c lie sqrt(2 - 2c) apart. A table hashes a vector to the quantised values
of K Gaussian projections; near vectors share a bucket of one of L tables. K follows the number of
vectors, so that unrelated ones leave a bucket of bounded size; L follows from the recall asked for at
the threshold itself (nearer pairs are found more surely). Every pair in a bucket is checked exactly, in
double precision, and counted in the first table that holds both, so no pair needs to be written out:
a bucket returns counts and a spanning forest. Buckets of any size are cut into blocks, and each pair of
blocks is a group of its own.

Defined cases: vectors that are null, empty or zero or hold null or non-finite components link with
nothing; so does a row without an id. Equal vectors are compared once and counted as often as they
occur. Rows repeated with one id and one vector are one vector; an id with several vectors names several, each with
links, a component and rows of its own. Vectors of different lengths don't link. An empty table gives an empty result.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import drop_written, materialize, shuffle_width
from larder.llm.components import components

WIDTH = 2.0
#: Unrelated vectors that may share a bucket, and rows of one block.
BUCKET, BLOCK = 32, 2048


def collision(distance: float, width: float = WIDTH) -> float:
    """How likely one quantised Gaussian projection agrees for two points so far apart."""
    t = width / distance
    phi = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def tables_for(n: int, cosine: float, recall: float) -> tuple[int, int]:
    """Projections of a table, and tables."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 1) / BUCKET + 1) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))


def hash_keys(x: np.ndarray, k: int, tables: int, seed: int) -> np.ndarray:
    """64-bit bucket keys, one column for each table."""
    rng = np.random.default_rng([seed, x.shape[1], k])
    direction = rng.standard_normal((x.shape[1], tables * k))
    cells = np.floor((x @ direction + rng.uniform(0, WIDTH, tables * k)) / WIDTH).astype(np.int64).view(np.uint64)
    odd = rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = (cells.reshape(len(x), tables, k) * odd).sum(axis=2, dtype=np.uint64) + np.uint64(x.shape[1])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def links_in(x: np.ndarray, keys: np.ndarray, at: int, left: np.ndarray, right: np.ndarray, same: bool, cosine: float):
    """Pairs at or above the cosine that no earlier table holds, as index arrays, a slab at a time."""
    for lo in range(0, len(left), 256):
        rows = left[lo : lo + 256]
        i, j = np.nonzero(x[rows] @ x[right].T >= cosine)
        if same:
            keep = right[j] > rows[i]
            i, j = i[keep], j[keep]
        i, j = rows[i], right[j]
        if at and len(i):
            fresh = ~(keys[i, :at] == keys[j, :at]).any(axis=1)
            i, j = i[fresh], j[fresh]
        if len(i):
            yield i, j


def near_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.98, seed: int = 7, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = F.coalesce(F.col(vec_id).isNotNull() & ~bad & F.exists(v, lambda c: c != 0.0), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.when(good, F.transform(v, lambda c: c + 0.0)).alias("v"))
    distinct = rows.where("v is not null").distinct()
    # A class is a distinct vector; its number holds from the written table on.
    classes = distinct.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    groups = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    own_hash = F.xxhash64("v").alias("own_hash")  # tells the vectors of one id apart
    members = materialize(distinct.join(groups, "v").select("vec_id", own_hash, "rep", "n"), "vector-members")

    k, tables = tables_for(groups.count(), cosine, recall)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sizes = pdf["v"].map(len)
            for size in sorted(set(sizes)):
                part = pdf[sizes == size]
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = hash_keys(x, k, tables, seed)
                yield pd.DataFrame({"rep": part["rep"], "n": part["n"], "x": [r.tobytes() for r in x], "keys": list(keys)})

    points = materialize(groups.mapInPandas(hashed, "rep bigint, n bigint, x binary, keys array<bigint>"), "vector-keys")
    slots = points.select("rep", F.posexplode("keys").alias("at", "key"))
    sizes = slots.groupBy("at", "key").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    shared = slots.join(sizes, ["at", "key"]).select("rep", "at", "key", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    block_pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("own")).alias("lo"), F.greatest(j, F.col("own")).alias("hi")),
    )
    spread = shared.withColumn("own", own).withColumn("pair", F.explode(block_pair))
    width = shuffle_width(vectors.sparkSession) * 4
    spread = spread.withColumn("bucket", F.pmod(F.xxhash64("at", "key", "pair.lo", "pair.hi"), F.lit(width)))
    work = spread.select("bucket", "rep", "at", "key", "own", "pair.lo", "pair.hi").join(points, "rep")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, n = pdf["rep"].to_numpy(), pdf["n"].to_numpy()
        own, keys = pdf["own"].to_numpy(), np.stack(pdf["keys"].to_numpy())
        links, edges = np.zeros(len(pdf), np.int64), []
        for (at, _, lo, hi), where in pdf.groupby(["at", "key", "lo", "hi"], sort=False).indices.items():
            for size in {len(b) for b in pdf["x"].to_numpy()[where]} if len(where) > 1 else ():
                idx = np.asarray([i for i in where if len(pdf["x"].iat[i]) == size])
                x = np.stack([np.frombuffer(pdf["x"].iat[i]) for i in idx])
                here, ks = own[idx], keys[idx]
                left, right = np.flatnonzero(here == lo), np.flatnonzero(here == hi)
                label = np.arange(len(idx))
                for i, j in links_in(x, ks, at, left, right, lo == hi, cosine):
                    np.add.at(links, idx[i], n[idx[j]])
                    np.add.at(links, idx[j], n[idx[i]])
                    while (label[i] != label[j]).any():
                        low = np.minimum(label[i], label[j])
                        np.minimum.at(label, label[i], low)
                        np.minimum.at(label, label[j], low)
                        label = label[label]
                while (label != label[label]).any():
                    label = label[label]
                joined = np.flatnonzero(label != np.arange(len(idx)))
                edges.append((rep[idx[joined]], rep[idx[label[joined]]]))
        hit = np.flatnonzero(links)
        a = np.concatenate([e[0] for e in edges]) if edges else np.empty(0, np.int64)
        b = np.concatenate([e[1] for e in edges]) if edges else np.empty(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([rep[hit], a]), "b": pd.array([None] * len(hit) + b.tolist(), "Int64"), "links": np.concatenate([links[hit], np.zeros(len(a), np.int64)])})

    found = materialize(work.groupBy("bucket").applyInPandas(compare, "a bigint, b bigint, links bigint"), "vector-links")
    drop_written(points)
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null"))
    placed = groups.select("rep", "least").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = (
        members.join(counts, "rep", "left").join(placed.join(least, "root").select("rep", "component_id"), "rep")
        .select("vec_id", "own_hash", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = rows.where("v is not null").select("vec_id", own_hash).join(named, ["vec_id", "own_hash"]).drop("own_hash")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
