"""Jaccard join of word n-gram sets by parity sketches.

A sketch XORs the hashes of a set's members into segments, so one member more or less changes one
segment, and the number of segments that differ bounds the symmetric difference from below. Sets of
similar size share a band with a fixed number of segments. A pair at the threshold differs in at
most D members, so among p segments at least p - D agree; each set therefore writes only the D + 1
segments that hold most members (an order both sides share, so the fullest agreeing segment is
among them), and pairs meet where a segment's key is equal. A second sketch, of single bits, gives
a Hamming distance that rules out most pairs that met by chance; the rest are verified by their sets.

Pairs are compared where they meet and never written as such. First every member of a key's group meets the
group's least document, and pairs that the sketches allow make rough components; then pairs from different rough
components are compared, in blocks of a key, and of those that the sketches allow a block hands on a spanning
forest. The wide components of both hold every link. Each is settled by its sets in one task, which compares all
its pairs that aren't linked yet. A wide component too large for a task is cut into blocks: its forest is verified
first, and every pair of blocks then hands on a spanning forest of links between what is still apart. So what
is written grows with the members of a group, not with its pairs, and no link is lost.

Defined cases: a document with fewer words than n is one shingle, its whole sequence; one without
words has an empty set and links with nothing; equal sets are one class and are compared once; a row
without an id gets its size and no component; rows repeated with one id are one document; an empty
table gives an empty result; columns other than id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WordHashes, drop_written, fresh, handing_back, materialize, mix64, shuffle_width, words_of, worker_state
from larder.llm.components import components

WORDS = 5
#: The similarity as a fraction.
AT_LEAST = (75, 100)
BLOCK = 2048
#: Members of sets that a component settled in one task, or a block of a larger one, may hold.
MEMBERS = 1 << 20
#: Documents of a component from which bit sketches are asked before sets.
SKETCHED = 64
#: Stands for a missing id inside the join.
NO_ID = -(2**63)
#: Entries of groups in one written row.
CHUNK = 100_000
#: Documents whose keys a task holds at once, and sets that it knows to have written.
ROWS, MOST_SEEN = 2048, 100_000


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a document's shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    n = min(k, len(h))
    odd = mix64(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    acc = h[: len(h) - n + 1] * odd[0]
    for j in range(1, n):
        acc += h[j : len(h) - n + 1 + j] * odd[j]
    return np.unique(mix64(acc + np.uint64(n)))


def largest_difference(n: int, m: int, at_least=AT_LEAST) -> int:
    """Of two sets of sizes n and m that reach the similarity."""
    up, down = at_least
    return (down - up) * (n + m) // (down + up)


def bands(n: int, at_least=AT_LEAST) -> list[tuple[int, int, int]]:
    """(band, segments, segments to write) for a set of n members: its own band, and the next one if a partner may be there."""
    up, down = at_least
    own = n.bit_length() - 1
    most = down * n // up
    out = []
    for band in range(own, most.bit_length()):
        top = 2 ** (band + 1) - 1
        d = largest_difference(n, min(top, most), at_least)
        widest = largest_difference(top, top, at_least)
        out.append((band, widest + widest // 4 + 1 + (widest > 0), d + 1))
    return out


def segment_keys(s: np.ndarray, band: int, p: int, take: int) -> np.ndarray:
    """Keys of the ``take`` fullest of p parity segments (by members, then key)."""
    segment = ((s >> np.uint64(33)) % np.uint64(p)).astype(np.uint32)
    order = np.argsort(segment, kind="stable")
    segment = segment[order]
    first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    parity, members = np.bitwise_xor.reduceat(s[order], first), np.diff(np.r_[first, len(s)])
    used = segment[first].astype(np.uint64)
    if len(first) < take:  # some have to be empty ones
        empty = np.setdiff1d(np.arange(p, dtype=np.uint64), used)
        used, parity = np.r_[used, empty], np.r_[parity, np.zeros(len(empty), np.uint64)]
        members = np.r_[members, np.zeros(len(empty), members.dtype)]
    keys = mix64(parity ^ mix64(used + np.uint64(band << 40)))
    if len(keys) > take:
        keys = keys[np.lexsort((keys, -members))[:take]]
    return keys


def bit_sketch(s: np.ndarray) -> bytes:
    """Parities of members over four bits for each member the band may hold."""
    bits = max(64, 4 << (len(s).bit_length() - 1)) if len(s) else 64
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch brought to fewer bits: its halves XORed. As 64-bit words."""
    x = np.frombuffer(sketch, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def may_link(n: np.ndarray, m: np.ndarray, distance: np.ndarray, at_least=AT_LEAST) -> np.ndarray:
    up, down = at_least
    return (down * np.minimum(n, m) >= up * np.maximum(n, m)) & ((down + up) * distance <= (down - up) * (n + m))


def _dealt(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (values % np.uint64(width)).astype(np.uint16 if width < 65536 else np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(width + 1))


def set_hash(s: np.ndarray) -> int:
    """One number for a whole set: documents with equal sets are one class."""
    total = s.sum(dtype=np.uint64) + np.uint64(len(s))
    other = mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix64(np.asarray([total]) ^ mix64(np.asarray([other])))[0].astype(np.int64))


def signatures(docs: DataFrame, k: int, at_least, width: int, doc_id: str, text: str) -> DataFrame:
    """Document rows, and packed rows of segment keys with classes for each bucket of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_state("ngrams").setdefault("words", WordHashes())
        seen: set[int] = set()
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            meta, keys, owner = [], [], []
            if len(seen) > MOST_SEEN:
                seen.clear()
            for doc, cell in zip(ids.tolist(), batch.column(1)):
                s = shingles(words_of(cell.as_py() or b""), k, hashes)
                n, own = len(s), set_hash(s)
                new = n > 0 and doc != NO_ID and own not in seen
                meta.append((doc % width, doc, n, own, bit_sketch(s) if new else None))
                if new:
                    seen.add(own)
                    for band, p, take in bands(n, at_least):
                        keys.append(segment_keys(s, band, p, take))
                        owner.append((own, len(keys[-1])))
            rows = [[m[i] for m in meta] for i in range(5)]
            packed: list[list] = [[], [], []]
            if keys:
                flat = np.concatenate(keys)
                owners = np.repeat(np.asarray([d for d, _ in owner], np.int64), [c for _, c in owner])
                order, cut = _dealt(flat, width)
                flat, owners = flat[order], owners[order]
                for b in range(width):
                    if cut[b] < cut[b + 1]:
                        for x, v in zip(packed, (b, flat[cut[b] : cut[b + 1]].tobytes(), owners[cut[b] : cut[b + 1]].tobytes())):
                            x.append(v)
            blank = [None] * len(packed[0])
            none = [None] * len(meta)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(x + (packed[0] if i == 0 else blank), t) for i, (x, t) in enumerate(zip(rows, types))]
            columns += [pa.array(none + x, pa.binary()) for x in packed[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "id", "n", "class", "sketch", "keys", "classes"])
        worker_state("ngrams").pop("words", None)  # later stages of a job need the memory more than the words

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(handing_back(run), "bucket int, id bigint, n bigint, class bigint, sketch binary, keys binary, classes binary")


FOUND = "kind string, id bigint, n bigint, class bigint, sketch binary, keys binary, classes binary"


def _found(n: int, **columns) -> pa.Table:
    """``n`` rows of FOUND; columns that aren't given are null. Class numbers stay whole: pandas would round them where nulls stand beside."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    wanted = [c.split() for c in FOUND.split(", ")]
    return pa.table({name: pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in wanted})


def _met(here: pa.Table) -> pa.Table:
    """In one bucket: document rows as they are; the members of every key that two classes share, packed; each with its group's least one as a pair."""
    docs, packed = here.filter(here["keys"].is_null()), here.filter(here["keys"].is_valid())
    out = [_found(0), pa.table({c.split()[0]: pa.array(["doc"] * len(docs), pa.string()) if c.startswith("kind") else docs[c.split()[0]] for c in FOUND.split(", ")})]
    if len(packed):
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in packed["keys"].to_pylist()])
        own = np.concatenate([np.frombuffer(x, np.int64) for x in packed["classes"].to_pylist()])
        order = np.lexsort((own, keys))
        keys, own = keys[order], own[order]
        once = np.r_[True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])]  # a class comes once from each batch
        keys, own = keys[once], own[once]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        shared = np.repeat(size > 1, size)
        low = np.repeat(own[first], size)[shared]
        keys, own = keys[shared], own[shared]
        for at in range(0, len(keys), CHUNK):
            out.append(_found(1, kind=["group"], keys=[keys[at : at + CHUNK].tobytes()], classes=[own[at : at + CHUNK].tobytes()]))
        a, b = low[own != low], own[own != low]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        out.append(_found(int(new.sum()), **{"kind": ["pair"] * int(new.sum()), "id": a[new], "class": b[new]}))
    return pa.concat_tables(out)


def _unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for keys, own in zip(pdf["keys"], pdf["classes"]):
            yield pd.DataFrame({"key": np.frombuffer(keys, np.int64), "rep": np.frombuffer(own, np.int64)})


def spanning(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the edges u - v make a spanning forest: every node's edge to its least neighbour, over and over."""
    names, flat = np.unique(np.r_[u, v], return_inverse=True)
    x, y = flat[: len(u)], flat[len(u) :]
    label, left, kept = np.arange(len(names)), np.arange(len(u)), [np.empty(0, np.int64)]
    while True:
        high, low = np.maximum(label[x[left]], label[y[left]]), np.minimum(label[x[left]], label[y[left]])
        apart = high != low
        left, high, low = left[apart], high[apart], low[apart]
        if not len(left):
            return np.concatenate(kept)
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        kept.append(left[first])
        parent = np.arange(len(names))
        parent[high[first]] = low[first]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


class Sets:
    """Sets side by side, their members numbered, for counting what one shares with many."""

    def __init__(self, packed, at_least):
        sets = [np.frombuffer(x, np.uint64) for x in packed]
        self.at_least, self.packed = at_least, sets
        self.size = np.asarray([len(s) for s in sets], np.int64)
        members, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids = np.split(flat, np.cumsum(self.size)[:-1])
        self.mark = np.zeros(len(members), np.uint8)

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        """How many members set i has in common with each of the others."""
        self.mark[self.ids[i]] = 1
        first = np.cumsum(self.size[others]) - self.size[others]
        both = np.add.reduceat(self.mark[np.concatenate([self.ids[j] for j in others])], first, dtype=np.int64)
        self.mark[self.ids[i]] = 0
        return both

    def links(self, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
        """A spanning forest of the links between ``left`` and ``right``; sets of one label count as linked, and labels are brought up to date."""
        (up, down), same, out = self.at_least, left is right, []
        nodes = left if same else np.concatenate([left, right])
        bits = None
        if len(right) > SKETCHED:
            sketches = {j: bit_sketch(self.packed[j]) for j in {*left.tolist(), *right.tolist()}}
            short = min(map(len, sketches.values()))
            bits = {j: folded(x, short) for j, x in sketches.items()}
            columns = np.stack([bits[j] for j in right.tolist()])
        for at, i in enumerate(left.tolist()):
            open_ = np.flatnonzero(label[right] != label[i])
            if same:
                open_ = open_[open_ > at]
            apart = 0 if bits is None else np.bitwise_count(columns[open_] ^ bits[i]).sum(axis=1, dtype=np.int64)
            n, m = self.size[i], self.size[right[open_]]
            others = right[open_[may_link(n, m, apart, self.at_least)]]
            if not len(others):
                continue
            both = self.shared(i, others)
            for j in others[down * both >= up * (n + self.size[others] - both)].tolist():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[nodes[label[nodes] == label[j]]] = label[i]
        return out


class Join:
    """The steps between the written signatures and the components."""

    def __init__(self, docs: DataFrame, k: int = WORDS, at_least=AT_LEAST, doc_id: str = "doc_id", text: str = "text"):
        self.docs, self.k, self.at_least, self.doc_id, self.text = docs, k, at_least, doc_id, text
        self.width = shuffle_width(docs.sparkSession)
        made = signatures(docs, k, at_least, self.width, doc_id, text)
        self.found = materialize(made.groupBy("bucket").applyInArrow(_met, FOUND), "ngram-signatures")
        self.rows = self.found.where("kind = 'doc'").select("id", "n", "class", "sketch")
        #: One row per class: its number, its least document, size and sketch.
        named = self.rows.where(f"n > 0 and id > {NO_ID}").withColumnRenamed("class", "rep")
        self.reps = materialize(named.groupBy("rep", "n").agg(F.min("id").alias("least"), F.max("sketch").alias("sketch")), "ngram-classes")

    def first_pairs(self) -> DataFrame:
        return self.found.where("kind = 'pair'").select(F.col("id").alias("a"), F.col("class").alias("b")).distinct()

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and bit sketches allow a link."""
        at_least = self.at_least

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                apart = [
                    int(np.bitwise_count(folded(x, min(len(x), len(y))) ^ folded(y, min(len(x), len(y)))).sum())
                    for x, y in zip(pdf["sketch_a"], pdf["sketch_b"])
                ]
                yield pdf.loc[may_link(pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy(), np.asarray(apart, np.int64), at_least), ["a", "b"]]

        for side in ("a", "b"):
            own = self.reps.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
            pairs = pairs.join(own, side)
        return pairs.mapInPandas(run, "a bigint, b bigint")

    def sets_of(self, members: DataFrame) -> DataFrame:
        """(rep, root, members): the sets of the classes in ``members`` (rep, root), made again from the texts of their documents.
        Where rows repeat a document, so do its sets."""
        k = self.k

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = worker_state("ngrams").setdefault("words", WordHashes())
            for batch in batches:
                made = [shingles(words_of(x.as_py() or b""), k, hashes) for x in batch.column(2)]
                # An id with several texts stands for the class of each; only the text of this class counts.
                mine = [i for i, (s, rep) in enumerate(zip(made, batch.column(0).to_pylist())) if set_hash(s) == rep]
                of = pa.array(mine, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array([made[i].tobytes() for i in mine], pa.binary())],
                    names=["rep", "root", "members"],
                )
            worker_state("ngrams").pop("words", None)

        wanted = members.join(self.reps.select("rep", "least"), "rep")
        rows = self.docs.select(F.col(self.doc_id).cast("bigint").alias("least"), F.col(self.text).cast("binary").alias("text"))
        return rows.join(wanted, "least").select("rep", "root", "text").mapInArrow(handing_back(sets), "rep bigint, root bigint, members binary")

    def verified(self, pairs: DataFrame, made: DataFrame) -> DataFrame:
        """The pairs whose sets reach the similarity."""
        up, down = self.at_least

        def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                linked = np.zeros(len(pdf), bool)
                for i, (x, y) in enumerate(zip(pdf["members_a"], pdf["members_b"])):
                    s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(s) + len(t) - len(np.union1d(s, t))
                    linked[i] = down * both >= up * (len(s) + len(t) - both)
                yield pdf.loc[linked, ["a", "b"]]

        for side in ("a", "b"):
            pairs = pairs.join(made.select(F.col("rep").alias(side), F.col("members").alias(f"members_{side}")), side)
        return pairs.mapInPandas(check, "a bigint, b bigint")

    def open_pairs(self, entries: DataFrame) -> DataFrame:
        """Of the pairs of different roots that share a key and that sizes and bit sketches allow: a spanning forest of
        the roots, for every bucket of blocks. ``entries``: key, rep, root."""
        at_least, width = self.at_least, self.width * 4
        size = F.count("*").alias("size")
        mixed = entries.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), size).where("low < high")
        mixed = mixed.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        members = entries.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        pair = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: F.struct(F.least(j, F.col("own")).alias("lo"), F.greatest(j, F.col("own")).alias("hi")),
        )
        spread = members.withColumn("pair", F.explode(pair))
        spread = spread.withColumn("bucket", F.pmod(F.xxhash64("key", "pair.lo", "pair.hi"), F.lit(width)))
        work = spread.select("bucket", "key", "rep", "root", "own", "pair.lo", "pair.hi").join(self.reps.drop("least"), "rep")

        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            rep, root, n = (pdf[c].to_numpy() for c in ("rep", "root", "n"))
            own, sketch = pdf["own"].to_numpy(), pdf["sketch"].to_numpy()
            got: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
            for (_, lo, hi), where in pdf.groupby(["key", "lo", "hi"], sort=False).indices.items():
                where = np.asarray(where)
                short = min(len(sketch[i]) for i in where)
                bits = np.stack([folded(sketch[i], short) for i in where])
                left, right = np.flatnonzero(own[where] == lo), np.flatnonzero(own[where] == hi)
                slab = max(1, 4_000_000 // (len(right) * bits.shape[1] + 1))
                for at in range(0, len(left), slab):
                    l, r = where[left[at : at + slab]], where[right]
                    apart = np.bitwise_count(bits[left[at : at + slab], None] ^ bits[None, right]).sum(axis=2, dtype=np.int64)
                    ok = may_link(n[l][:, None], n[r][None], apart, at_least) & (root[l][:, None] != root[r][None])
                    i, j = np.nonzero(ok)
                    i, j = l[i], r[j]
                    if len(i) > len(where):
                        few = spanning(root[i], root[j])
                        i, j = i[few], j[few]
                    got.append((i, j))
            i, j = (np.concatenate(x) for x in zip(*got))
            few = spanning(root[i], root[j])
            i, j = rep[i[few]], rep[j[few]]
            return pd.DataFrame({"a": np.minimum(i, j), "b": np.maximum(i, j)})

        return work.groupBy("bucket").applyInPandas(compare, "a bigint, b bigint").distinct()

    def settled(self, members: DataFrame, buckets: int) -> DataFrame:
        """(node, root) by verified links, of wide components that one task can hold. ``members``: rep, root."""
        at_least = self.at_least

        def settle(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.drop_duplicates("rep").sort_values(["root", "rep"])
            sets, label, rep = Sets(pdf["members"], at_least), np.arange(len(pdf)), pdf["rep"].to_numpy()
            for own in np.split(label.copy(), np.flatnonzero(np.diff(pdf["root"].to_numpy())) + 1):
                sets.links(own, own, label)
            _, first, which = np.unique(label, return_index=True, return_inverse=True)
            root = rep[first][which]
            return pd.DataFrame({"node": rep, "root": root})[root != rep]

        dealt = self.sets_of(members).withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets)))
        return dealt.groupBy("bucket").applyInPandas(settle, "node bigint, root bigint")

    def settled_in_blocks(self, members: DataFrame, forest: DataFrame) -> DataFrame:
        """(node, root) by verified links, of wide components beyond that. ``forest``: pairs a, b that hold them together."""
        at_least = self.at_least
        made = materialize(self.sets_of(members).dropDuplicates(["rep"]), "ngram-sets")
        inside = forest.join(members.select(F.col("rep").alias("a")), "a", "left_semi")
        links = materialize(self.verified(inside, made), "ngram-links")
        exact = components(links).select(F.col("node").alias("rep"), F.col("root").alias("exact"))
        placed = members.join(exact, "rep", "left").select("rep", "root", F.coalesce("exact", "rep").alias("exact"))
        placed = materialize(placed.join(self.reps.select("rep", "n"), "rep"), "ngram-members")
        # The largest part of a component is not compared in itself; blocks are numbered on from its own.
        parts = placed.groupBy("root", "exact").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
        parts = parts.groupBy("root").agg(F.max_by("exact", F.struct("size", "exact")).alias("main"), F.max_by(F.struct("size", "n"), F.struct("size", "exact")).alias("most"), F.sum("size").alias("size"), F.sum("n").alias("n"))

        def blocks(size, n):
            return F.greatest(F.ceil(size / BLOCK), F.ceil(n / MEMBERS)).cast("int")

        parts = parts.where("most.size < size").select(
            "root", "main", blocks(F.col("most.size"), F.col("most.n")).alias("whole"), blocks(F.col("size") - F.col("most.size"), F.col("n") - F.col("most.n")).alias("rest")
        )
        own = placed.join(parts, "root").withColumn("hash", F.xxhash64("rep")).withColumn("is_main", F.expr("exact = main"))
        own = own.withColumn("own", F.expr("cast(if(is_main, pmod(hash, whole), whole + pmod(hash, rest)) as int)"))
        others = F.expr("if(is_main, sequence(whole, whole + rest - 1), sequence(0, whole + rest - 1))")
        spread = own.withColumn("other", F.explode(others)).select("root", "rep", "exact", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            sets, rep, own = Sets(pdf["members"], at_least), pdf["rep"].to_numpy(), pdf["own"].to_numpy()
            label = np.unique(pdf["exact"].to_numpy(), return_inverse=True)[1]
            left, right = np.flatnonzero(own == pdf["lo"].iloc[0]), np.flatnonzero(own == pdf["hi"].iloc[0])
            found = sets.links(left, left if pdf["lo"].iloc[0] == pdf["hi"].iloc[0] else right, label) if len(left) and len(right) else []
            return pd.DataFrame({"a": rep[[i for i, _ in found]], "b": rep[[j for _, j in found]]}) if found else pd.DataFrame({"a": rep[:0], "b": rep[:0]})

        work = spread.join(made.drop("root"), "rep")
        more = materialize(work.groupBy("root", "lo", "hi").applyInPandas(compare, "a bigint, b bigint"), "ngram-more")
        roots = components(links.unionByName(more))
        drop_written(made, links, placed, more)
        return roots

    def classes(self) -> DataFrame:
        """One row per row of the documents: doc_id, n_shingles, component_id."""
        tried = materialize(self.likely(self.first_pairs()), "ngram-likely")
        rough = materialize(components(tried), "ngram-rough")
        entries = self.found.where("kind = 'group'").select("keys", "classes").mapInPandas(_unpacked, "key bigint, rep bigint")
        placed = entries.join(rough.withColumnRenamed("node", "rep"), "rep", "left")
        placed = materialize(placed.select("key", "rep", F.coalesce("root", "rep").alias("root")), "ngram-entries")
        more = materialize(self.open_pairs(placed), "ngram-pairs")
        wide = materialize(components(rough.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "ngram-components")
        members = wide.select(F.col("node").alias("rep"), "root").unionByName(wide.select(F.col("root").alias("rep"), "root").distinct())
        sizes = members.join(self.reps.select("rep", "n"), "rep").groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
        sizes = materialize(sizes.select("root", "n", ((F.col("size") > BLOCK) | (F.col("n") > MEMBERS)).alias("large")), "ngram-wide")
        members = materialize(members.join(sizes.select("root", "large"), "root").select("rep", "root", "large"), "ngram-members")
        n = sizes.groupBy("large").agg(F.sum("n").alias("n"))
        n = {r.large: r.n for r in n.collect()}
        roots = self.settled(members.where("not large").drop("large"), max(self.width * 4, n.get(False, 0) // MEMBERS))
        if True in n:
            roots = roots.unionByName(self.settled_in_blocks(members.where("large").drop("large"), tried.unionByName(more)))
        roots = materialize(roots, "ngram-roots")
        drop_written(tried, rough, placed, more, wide, sizes, members)
        place = self.reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "least", F.coalesce("root", "rep").alias("root"))
        names = place.join(place.groupBy("root").agg(F.min("least").alias("name")), "root").select(F.col("rep").alias("class"), "name")
        out = self.rows.select("id", "n", "class").join(names, "class", "left")
        missing = F.col("id") == NO_ID
        return out.select(
            F.when(~missing, F.col("id")).alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(~missing, F.when(F.col("n") > 0, F.coalesce("name", "id")).otherwise(F.col("id"))).alias("component_id"),
        )


def ngram_classes(docs: DataFrame, k: int = WORDS, at_least=AT_LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return Join(docs, k, at_least, doc_id, text).classes()


def keep_documents(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that are linked to one with a smaller id; all columns as they were."""
    classes = ngram_classes(docs, doc_id=doc_id, **options)
    name = fresh(docs, "gone")
    gone = classes.where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(doc_id) == F.col(name), "left_anti")
