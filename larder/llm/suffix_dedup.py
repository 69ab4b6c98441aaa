"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A byte goes if a window of ``window`` bytes that covers it also starts earlier in the corpus. Windows are
dealt out by minimizer, so equal windows meet wherever they are, and neighbours with one minimizer travel as
one run. Runs that are equal as a whole need no comparison: all but the first go. What is left, first runs
whose minimizer other runs share, is split once more by a second minimizer. Of those strings each bucket
builds transforms shard by shard and merges them by interleave refinement: every round sorts the merged
rows, stably, by the symbol before them, which refines the order by one symbol; rows that no round up to the
window's length tells apart begin with one common string. A row that is alone with its symbols has its place; it
and, round by round, those before it are merged no further. No suffixes of different shards are ever sorted
against each other. Symbols are four bytes, so a window of 100 bytes takes 25 rounds. Where more than ``hot``
different strings share a minimizer, their windows are dealt out one by one by 128 bits of hashes instead, and
all but the least place of each hash go: such a group spreads over all buckets.

Defined cases: null text is empty; texts shorter than the window keep all their bytes; texts may have any
length and repeat themselves; a row without an id keeps its text and doesn't count as an earlier place; rows
repeated with one id are one document, so they don't count against each other and all get its result; other
texts with the same id are versions of it: only a smaller id or an earlier start counts between them, and each
loses its own windows alone; an empty table gives an empty result; columns other than id and text don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import dealt, materialize, mix64, shuffle_width, text_bytes
from larder.llm.windows import minimizer_runs, window_hashes

WINDOW = 100
#: Bytes of the two minimizers, and of one symbol of a transform.
GRAM, SECOND_GRAM, WORD = 32, 16, 4
#: Bytes of strings in one shard of a bucket, and of those merged at once (one key's are never parted).
SHARD, AT_ONCE = 1 << 16, 1 << 18
#: Bytes of texts that are hashed side by side.
SIDE_BY_SIDE = 1 << 15
#: Strings of one minimizer beyond which their windows are compared one by one, and how many of those are held.
HOT, HELD = 1 << 14, 500_000
#: Marks a run whose windows may equal each other, and one of a hot minimizer.
SELF, WIDE = 1 << 20, 1 << 21
#: ``first`` is a start in the lower bits and the number of the text among those of its id above them.
VERSION = 31
START = (1 << VERSION) - 1
PACKED = "kind int, bucket int, key binary, whole binary, doc binary, first binary, size binary, text binary"
_TYPES = {"key": np.uint64, "whole": np.uint64, "doc": np.int64, "first": np.int64, "size": np.int64}
RUN, GONE, OPEN, ALONE = 0, 1, 2, 3


def pack_rows(kind: int, bucket: np.ndarray, **columns: np.ndarray) -> list[dict]:
    """One row for each bucket, its entries as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    columns = {k: v[order] for k, v in columns.items()}
    return [
        {"kind": kind, "bucket": int(bucket[a]), **{k: v[a:b].tobytes() for k, v in columns.items()}}
        for a, b in zip(first, [*first[1:], len(bucket)])
    ]


def unpack(rows: pd.DataFrame, *names: str) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(x, _TYPES[c]) for x in rows[c]]) if len(rows) else np.empty(0, _TYPES[c]) for c in names]


def frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "bucket", *_TYPES, "text"])


def arrow(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
    names = ["kind", "bucket", *_TYPES, "text"]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(names, kinds)], names=names)


def spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of ``n`` numbers from ``start`` on."""
    return np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def doc_bucket(doc: np.ndarray, width: int) -> np.ndarray:
    return (mix64(doc.view(np.uint64)) % np.uint64(width)).astype(np.int32)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Which entries differ from the one before them."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def at_least_place(new: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which entries have the place of the first one of their group; ``new`` marks where groups begin."""
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (doc == doc[lead]) & (first & START == first[lead] & START)


def first_of_equal(key, whole, doc, first):
    """The order by (key, whole, place) without repeats, and in it which entries begin a key, which of equal
    strings come first: several where texts of one id share a place."""
    order = np.lexsort((first, first & START, doc, whole, key))
    order = order[changes(key[order], whole[order], doc[order], first[order])]
    k, w = key[order], whole[order]
    return order, changes(k), at_least_place(changes(k, w), doc[order], first[order])


def together(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """(doc, text, version) rows by the handful: short texts are hashed side by side."""
    ids, versions = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
    size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // SIDE_BY_SIDE
    cut = np.flatnonzero(changes(part)).tolist() if len(part) else []
    for a, b in zip(cut, [*cut[1:], len(part)]):
        yield ids[a:b], batch.column(1).slice(a, b - a).to_pylist(), versions[a:b]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after another, where each starts (and the last one ends), and of each byte its text's number."""
    length = np.asarray([len(t) for t in texts], np.int64)
    start = np.r_[0, np.cumsum(length)]
    return np.frombuffer(b"".join(texts), np.uint8), start, np.repeat(np.arange(len(texts)), length)


def runs(docs: DataFrame, window: int, width: int) -> DataFrame:
    """All runs, dealt out by minimizer; of equal runs in one batch only the first, the others are gone already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[np.ndarray]] = [[], [], [], [], []]
            for docs_, texts, versions in together(batch):
                x, start, within = joined(texts)
                if len(within) >= window:  # windows over an edge belong to no text
                    edge = start[1:, None] - np.arange(1, window)
                    within[edge.ravel()] = -1
                v, first, size, whole, own = minimizer_runs(x, window, GRAM, 1, within[: len(x) - window + 1])
                of = within[first]
                for column, y in zip(made, (v, whole, docs_[of], first - start[of] | versions[of] << VERSION, size | SELF * own)):
                    column.append(y)
            if made[0]:
                key, whole, doc, first, size = map(np.concatenate, made)
                order, _, lead = first_of_equal(key, whole, doc, first)
                head, tail = order[lead], order[~lead]
                rows = pack_rows(RUN, (key[head] % np.uint64(width)).astype(np.int32), key=key[head], whole=whole[head], doc=doc[head], first=first[head], size=size[head])
                rows += pack_rows(GONE, doc_bucket(doc[tail], width), doc=doc[tail], first=first[tail], size=size[tail] & ~SELF)
                yield arrow(rows)

    return docs.mapInArrow(run, PACKED)


def _split(width: int, hot: int):
    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket's runs: which are gone, and which need a comparison."""
        out = pdf[pdf["kind"] == GONE].to_dict("records")
        key, whole, doc, first, size = unpack(pdf[pdf["kind"] == RUN], "key", "whole", "doc", "first", "size")
        order, new_key, lead = first_of_equal(key, whole, doc, first)
        strings = np.bincount(np.cumsum(new_key)[lead]) if len(key) else np.empty(0, np.int64)
        shared = lead & (strings[np.cumsum(new_key)] > 1) if len(key) else lead
        wanted = shared | (lead & (size[order] >= SELF))
        need = order[wanted]
        nth = np.cumsum(new_key)[wanted]
        size[need] |= np.where(np.bincount(nth)[nth] > hot, WIDE, 0) if len(need) else 0
        gone = order[~lead]
        out += pack_rows(GONE, doc_bucket(doc[gone], width), doc=doc[gone], first=first[gone], size=size[gone] & ~SELF)
        out += pack_rows(OPEN, doc_bucket(doc[need], width), key=key[need], doc=doc[need], first=first[need], size=size[need])
        return frame(out)

    return split


def _by_doc(pdf: pd.DataFrame) -> pd.DataFrame:
    """Packed rows of one bucket of documents as one row for each text, entries in order of place."""
    has_key = pdf["key"].notna().all()
    doc, first, size = unpack(pdf, "doc", "first", "size")
    order = np.lexsort((first, doc))
    key = unpack(pdf, "key")[0][order] if has_key else np.empty(0, np.uint64)
    doc, first, size = doc[order], first[order], size[order]
    version, first = first >> VERSION, first & START
    at = np.flatnonzero(changes(doc, version))
    cut = [*zip(at, [*at[1:], len(doc)])]
    return pd.DataFrame({
        "doc": doc[at],
        "version": version[at],
        "key": [key[a:b].tobytes() for a, b in cut],
        "first": [first[a:b].tobytes() for a, b in cut],
        "size": [size[a:b].tobytes() for a, b in cut],
    })


def least_and_later(a, b, doc, first):
    """Of windows, by their hashes: those with the least place of equal ones, and all others."""
    order, _, lead = first_of_equal(a, b, doc, first)
    return order[lead], order[~lead]


def strings(docs: DataFrame, window: int, width: int) -> DataFrame:
    """The bytes of runs that need a comparison, split by a second minimizer and dealt out by both; of runs with a
    hot minimizer single windows, dealt out by hash, of equal ones held together only the first. To four times as
    many buckets as ``width``, which is that of documents."""

    def alone(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        a, b, doc, first = map(np.concatenate, held)
        head, tail = least_and_later(a, b, doc, first)
        rows = pack_rows(ALONE, (a[head] % np.uint64(4 * width)).astype(np.int32), key=a[head], whole=b[head], doc=doc[head], first=first[head])
        rows += pack_rows(GONE, doc_bucket(doc[tail], width), doc=doc[tail], first=first[tail], size=np.ones(len(tail), np.int64))
        return arrow(rows)

    def split(near: list[tuple], made: list[list]) -> None:
        doc, version = (np.asarray([t[i] for t in near], np.int64) for i in (0, 1))
        texts = [t[2] for t in near]
        x, start, _ = joined(texts)
        key, length = (np.concatenate([t[i] for t in near]) for i in (3, 5))
        at = np.concatenate([t[4] + a for t, a in zip(near, start.tolist())])
        within = np.full(max(0, len(x) - window + 1), -1, np.int32)
        plain = length & ~SELF
        within[spread(at, plain)] = np.repeat(np.arange(len(at), dtype=np.int32), plain)
        v, first, size, whole, own = minimizer_runs(x, window, SECOND_GRAM, 2, within)
        parent = within[first]
        own = own | (length[parent] >= SELF)
        of = np.searchsorted(start, first, "right") - 1
        for column, y in zip(made, (mix64(key[parent] + mix64(v)), whole, doc[of], first - start[of] | version[of] << VERSION, size | SELF * own)):
            column.append(y)
        whole_text = b"".join(texts)
        made[5] += [whole_text[a:b] for a, b in zip(first.tolist(), (first + size + window - 1).tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[], [], [], [], [], []]
            held: list[list[np.ndarray]] = [[], [], [], []]
            near: list[tuple] = []
            holds = size_near = 0
            for doc, version, text, *cells in zip(*(batch.column(i).to_pylist() for i in range(6))):
                key, at, length = (np.frombuffer(c, t) for c, t in zip(cells, (np.uint64, np.int64, np.int64)))
                fits = at + (length & SELF - 1) + window - 1 <= len(text)
                wide = fits & (length & WIDE > 0)
                if wide.any():
                    slots = spread(at[wide], length[wide] & SELF - 1)
                    hashes = window_hashes(np.frombuffer(text, np.uint8), window)
                    for lo in range(0, len(slots), HELD):
                        some = slots[lo : lo + HELD]
                        for column, x in zip(held, (hashes[0][some], hashes[1][some], np.full(len(some), doc, np.int64), some | version << VERSION)):
                            column.append(x)
                        holds += len(some)
                        if holds >= HELD:
                            yield alone(held)
                            held, holds = [[], [], [], []], 0
                fits &= ~wide
                near.append((doc, version, text, key[fits], at[fits], length[fits]))
                size_near += len(text)
                if size_near >= SIDE_BY_SIDE:
                    split(near, made)
                    near, size_near = [], 0
            if near:
                split(near, made)
            if holds:
                yield alone(held)
            if made[0]:
                key, whole, doc, first, size = map(np.concatenate, made[:5])
                bucket = (key % np.uint64(4 * width)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                rows = pack_rows(RUN, bucket, key=key, whole=whole, doc=doc, first=first, size=size)
                done = 0
                for r in rows:
                    n = len(r["key"]) // 8
                    r["text"] = b"".join(made[5][i] for i in order[done : done + n])
                    done += n
                yield arrow(rows)

    return docs.mapInArrow(run, PACKED)


def by_symbol(symbol: np.ndarray) -> np.ndarray:
    """The stable order by 32-bit symbols: two radix passes of 16 bits."""
    order = np.argsort(symbol.astype(np.uint16), kind="stable")
    return order[np.argsort((symbol >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]


def shard_rows(word: np.ndarray, base: np.ndarray, word_bytes: int, longest: int) -> np.ndarray:
    """A shard's suffixes in order: by their words, those that end first by place. By doubling; a suffix that is
    alone with its beginning has its place and is sorted no more."""
    n = len(word)
    inner = np.flatnonzero(~base)
    inner = inner[by_symbol(word[inner])]
    ends = n - len(inner)
    order = np.concatenate([np.flatnonzero(base), inner])
    new = np.ones(n, bool)
    new[ends + 1 :] = word[inner[1:]] != word[inner[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = word_bytes
    slots = np.arange(n)
    while step < longest:
        slots = slots[~(new[slots] & np.r_[new, True][slots + 1])]
        if not len(slots):
            break
        rows = order[slots]  # equal in ``step`` bytes, so none of them ends before that
        pair = rank[rows] * n + rank[rows + step]
        turn = np.argsort(pair, kind="stable")
        rows, pair = rows[turn], pair[turn]
        order[slots], new[slots] = rows, changes(pair)
        rank[rows] = np.maximum.accumulate(np.where(new[slots], slots, 0))
        step *= 2
    return order


def shared_blocks(text: np.ndarray, length: np.ndarray, window: int = WINDOW, word_bytes: int = WORD, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``text`` (strings one after another) whose ``window`` bytes stand at other places too, in merged
    order, and a block number for each: equal numbers, equal strings. ``window`` is a multiple of ``word_bytes``."""
    # Each string gets one more word, so that a window at its end is followed by a suffix too.
    n = len(text) + word_bytes * len(length)
    ends = np.cumsum(length + word_bytes)
    start = ends - length - word_bytes
    base, begins = np.zeros(n, bool), np.zeros(n, bool)
    for j in range(word_bytes):
        base[ends - j - 1] = begins[start + j] = True
    padded = np.zeros(n + word_bytes - 1, np.uint8)
    padded[:n][~base] = text
    word = np.zeros(n, np.uint32)
    for j in range(word_bytes):
        word = word << np.uint32(8) | padded[j : j + n]
    # Shards are runs of whole strings; their transforms stand one after another.
    owner = start // shard
    cut = np.r_[start[changes(owner)], n]
    rows = np.concatenate([a + shard_rows(word[a:b], base[a:b], word_bytes, int(length.max()) + 2 * word_bytes) for a, b in zip(cut[:-1], cut[1:])])
    # Of each row the symbol before it, and the row of the suffix that begins there.
    row_at = np.empty(n, np.int64)
    row_at[rows] = np.arange(n)
    has_before = ~begins[rows]
    at = rows - np.where(has_before, word_bytes, 0)
    before, back = word[at], row_at[at]
    merged = np.arange(n)
    block = np.zeros(n, np.int64)
    for _ in range(window // word_bytes):
        live = has_before[merged]
        merged, block = merged[live], block[live]
        if not len(merged):
            break
        symbol = before[merged]
        order = by_symbol(symbol)
        symbol, merged = symbol[order], back[merged[order]]
        new = changes(symbol, block[order])
        # A row alone in its block is settled, and so is, a round later, the one before it: both leave.
        met = ~(new & np.r_[new[1:], True])
        merged, block = merged[met], np.cumsum(new)[met]
    rows = rows[merged]
    return rows - word_bytes * np.searchsorted(ends, rows, "right"), block


def merged_blocks(text: np.ndarray, length: np.ndarray, window: int = WINDOW, word_bytes: int = WORD, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shared_blocks`, and after them all other places, each in a block of its own."""
    at, block = shared_blocks(text, length, window, word_bytes, shard)
    alone = np.ones(len(text), bool)
    alone[at] = False
    alone = np.flatnonzero(alone)
    return np.concatenate([at, alone]), np.concatenate([block, len(text) + 1 + np.arange(len(alone))])


def _repeats(window: int, width: int):
    def repeats(pdf: pd.DataFrame) -> pd.DataFrame:
        """In one bucket of strings and single windows: the windows that also start earlier."""
        out = pdf[pdf["kind"] == GONE].to_dict("records")
        a, b, doc, first = unpack(pdf[pdf["kind"] == ALONE], "key", "whole", "doc", "first")
        _, tail = least_and_later(a, b, doc, first)
        out += pack_rows(GONE, doc_bucket(doc[tail], width), doc=doc[tail], first=first[tail], size=np.ones(len(tail), np.int64))
        pdf = pdf[pdf["kind"] == RUN]
        if pdf.empty:
            return frame(out)
        key, whole, doc, first, size = unpack(pdf, "key", "whole", "doc", "first", "size")
        text = np.frombuffer(b"".join(pdf["text"]), np.uint8)
        length = (size & ~SELF) + window - 1
        start = np.cumsum(length) - length
        order, new_key, lead = first_of_equal(key, whole, doc, first)
        many = np.bincount(np.cumsum(new_key)[lead])[np.cumsum(new_key)] > 1
        gone = order[~lead]
        out += pack_rows(GONE, doc_bucket(doc[gone], width), doc=doc[gone], first=first[gone], size=size[gone] & ~SELF)
        need = order[lead & (many | (size[order] >= SELF))]
        # Equal windows have one key, so strings are merged some keys at a time: what fits a processor's cache.
        begin = changes(key[need])
        part = (np.cumsum(length[need])[begin][np.cumsum(begin) - 1] // AT_ONCE) if len(need) else need
        marked: list[list[np.ndarray]] = [[], [], []]
        for need in np.split(need, np.flatnonzero(changes(part))[1:]) if len(need) else ():
            n = length[need]
            at, block = shared_blocks(text[spread(start[need], n)], n, window)
            ends = np.cumsum(n)
            string = np.searchsorted(ends, at, "right")
            full = at + window <= ends[string]
            at, string, block = at[full], string[full], block[full]
            d, p = doc[need][string], first[need][string] + at - (ends - n)[string]
            order = np.lexsort((p, p & START, d, block))
            later = order[~at_least_place(changes(block[order]), d[order], p[order])]
            d, p = d[later], p[later]
            order = np.lexsort((p, d))
            d, p = d[order], p[order]
            if len(d):
                a = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)])
                for column, y in zip(marked, (d[a], p[a], np.diff(np.r_[a, len(d)]))):
                    column.append(y)
        if marked[0]:
            d, p, n = map(np.concatenate, marked)
            out += pack_rows(GONE, doc_bucket(d, width), doc=d, first=p, size=n)
        return frame(out)

    return repeats


def with_versions(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of each text among the different ones of its id: 0 wherever an id has one text."""
    digest = F.md5(F.coalesce("text", F.lit(b"")))
    several = rows.where("doc is not null").groupBy("doc").agg(F.min(digest).alias("least"), F.max(digest).alias("most")).where("least != most").select("doc")
    if several.isEmpty():
        return rows.withColumn("version", F.lit(0).cast("bigint"))
    texts = rows.join(several, "doc").select("doc", digest.alias("digest")).distinct()
    numbers = texts.select("doc", "digest", (F.row_number().over(Window.partitionBy("doc").orderBy("digest")) - 1).cast("bigint").alias("version"))
    numbers = materialize(numbers, "versions")
    found = rows.withColumn("digest", digest).join(numbers, ["doc", "digest"], "left")
    return found.select("doc", "text", F.coalesce("version", F.lit(0).cast("bigint")).alias("version"))


def repeated_spans(rows: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(doc, version, first, size): packed starts and numbers of the windows of each text that also start earlier."""
    if window % WORD or not GRAM <= window < SELF:
        raise ValueError(f"a window has {GRAM} to {SELF - WORD} bytes, a multiple of {WORD}, not {window}")
    rows = rows.where(F.col("doc").isNotNull() & (F.octet_length("text") >= window))
    width = shuffle_width(rows.sparkSession, text_bytes(rows))
    found = materialize(dealt(runs(rows, window, width), width).groupBy("bucket").applyInPandas(_split(width, hot), PACKED), "runs")
    by_doc = "doc bigint, version bigint, key binary, first binary, size binary"
    wanted = dealt(found.where(f"kind = {OPEN}"), width).groupBy("bucket").applyInPandas(_by_doc, by_doc)
    sent = strings(rows.join(wanted, ["doc", "version"]).select("doc", "version", "text", "key", "first", "size"), window, width)
    more = materialize(dealt(sent, width).groupBy("bucket").applyInPandas(_repeats(window, width), PACKED), "repeats")
    gone = found.where(f"kind = {GONE}").unionByName(more)
    return dealt(gone, width).groupBy("bucket").applyInPandas(_by_doc, by_doc).drop("key")


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for."""
    rows = with_versions(docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("binary").alias("text")))
    spans = repeated_spans(rows, window, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for cell, first, size in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                x = cell or b""
                removed = pieces = 0
                kept = x
                if first is not None:
                    a = np.frombuffer(first, np.int64)
                    b = np.minimum(a + np.frombuffer(size, np.int64) + window - 1, len(x))
                    a = a[b > a]
                    reach = np.maximum.accumulate(b[b > np.frombuffer(first, np.int64)])
                    lead = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]]) if len(a) else []
                    lo, hi = a[lead], reach[np.r_[lead[1:] - 1, len(a) - 1]] if len(a) else a
                    pieces, removed = len(lo), int((hi - lo).sum())
                    edge = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(x)]
                    kept = b"".join(x[p:q] for p, q in zip(edge[::2], edge[1::2]))
                for column, v in zip(out, (len(x), removed, pieces, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    done = rows.join(spans, ["doc", "version"], "left").select(F.col("doc").alias("doc_id"), "text", "first", "size")
    done = done.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return done if with_text else done.drop("kept")
