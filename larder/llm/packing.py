"""Packing documents into windows of tokens.

Documents are tokenized and cut into whole windows and a rest. The histogram of piece lengths (at
most one number per length up to the window) goes to a non-negative least squares fit: its columns
are shallow combinations of lengths that fill a window exactly, its unknowns how often each is
used. Rounded down to what the histogram holds, the combinations say which ranks of which length go
to which sequence; pieces look their place up by rank. What is left over is packed greedily, best
fit by falling length, in buckets that each hold a fair share of all lengths.

Defined cases: null text is empty, and an empty text is one piece that holds the end id alone;
repeated rows are packed as rows of their own; a null id stays null; a text of any length is cut;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.bpe_words import LETTERS, SHORT, MergeTable
from larder.llm.common import drop_written, handing_back, materialize, worker_state

WINDOW = 2048
END_ID = 1
#: Chunks of text that a worker remembers in each of two generations, and the longest of them.
REMEMBERED, LONGEST = 400_000, 48
#: Bytes of texts whose chunks are encoded together.
TOGETHER = 8_000_000
#: Left-over pieces for each bucket of the greedy packer.
BUCKET_PIECES = 20_000
#: Combinations tried for each length, and sweeps of the fit.
PER_LENGTH, SWEEPS = 8, 24


#: Letters below U+0300, with the space before them, are one word to the tokenizer: so many words take their merges side by side.
SIDE_BY_SIDE = 8192
#: Begins a chunk that has no space before it in the text; alone and twice, it stands for a text's begin and a line's end.
MARK = "\x01"
#: A space beside other white space, where no chunk ends.
INNER = "\x02"
_SPACE = f"[{INNER}\t-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Spaces to be kept inside chunks: two side by side, then those after and before other white space.
KEPT = ("  ", INNER * 2), (f"({_SPACE}) ", f"\\1{INNER}"), (f" ({_SPACE})", f"{INNER}\\1")
#: Cut off besides: a line's end between two signs or letters, and a sign after a letter at the end of a chunk.
CUT_OFF = (f"([!-~{LETTERS}])\n([!-~{LETTERS}])", f"\\1 {MARK}{MARK} {MARK}\\2"), (f"([{LETTERS}])([.,|])( |\\z)", f"\\1 {MARK}\\2\\3")


class _Chunks(dict):
    """Chunk of text to its ids as bytes; None for a chunk that can't be cut off where it ends. ``old`` holds the generation before."""

    def __init__(self, encode, lead: str, start: _Chunks | None):
        self.encode, self.lead, self.line_end = encode, lead, encode(["\n"])[0]
        self.start = self if start is None else start
        self.old: dict[str, bytes] = {}

    def keep(self, chunk: str, ids: bytes) -> bytes:
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def parts(self, chunk: str) -> list[tuple[_Chunks, str]] | None:
        """Chunks that make up this one, where it can be taken apart: letters end where a sign begins, lines where they end."""
        if chunk[-1] in ".,|" and chunk[:-1].isalpha():
            return [(self, chunk[:-1]), (self.start, chunk[-1])]
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return [(self, lines[0]), *((self.start, x) for x in lines[1:])]
        return None

    def __missing__(self, chunk: str):
        if chunk in self.old:
            return self.keep(chunk, self.old[chunk])
        if not chunk or chunk[-1].isspace():
            return None
        if parts := self.parts(chunk):
            joint = b"" if chunk[-1] in ".,|" and "\n" not in chunk else self.line_end
            return self.keep(chunk, joint.join([of[x] for of, x in parts]))
        return self.keep(chunk, self.encode([self.lead + chunk])[0])


class WordwiseTokenizer:
    """The ids of a byte-level BPE tokenizer, chunk by chunk.

    Its pre-tokenizer never joins anything across a single space between two characters that aren't
    white space, other than the space to what follows. So texts are cut there, and chunks that were
    seen before are looked up.
    """

    cut = re.compile(r"(?<!\s) (?!\s)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        def encode(texts: list[str]) -> list[bytes]:
            return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        self.encode, self.encode_all = lambda s: encode([s])[0], encode
        with open(path, encoding="utf-8") as f:
            self.merges = MergeTable(json.load(f)["model"])
        self.start = _Chunks(encode, "", None)
        self.rest = _Chunks(encode, " ", self.start)

    def words(self, chunks: pa.Array, chosen: np.ndarray, lead: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks of letters, merged side by side: which ones have come to so many ids, and those. With ``lead`` a space comes before each, else the mark is dropped."""
        begin, raw = np.frombuffer(chunks.buffers()[1], np.int64, len(chunks) + 1), np.frombuffer(chunks.buffers()[2], np.uint8)
        size = np.diff(begin)[chosen]
        for n in np.unique(size).tolist():
            own = chosen[size == n]
            for at in range(0, len(own), SIDE_BY_SIDE):
                block = own[at : at + SIDE_BY_SIDE]
                rows = raw[begin[block][:, None] + np.arange(n)]
                rows = np.c_[np.full(len(rows), 32, np.uint8), rows] if lead else rows[:, 1:]
                yield from ((block[w], ids) for w, ids in self.merges.merged(rows))

    def chunk_ids(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The ids of different chunks, in another order, and each chunk's place there."""
        letters = pc.match_substring_regex(chunks, f"^{MARK}?[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        letters = letters & (pc.binary_length(chunks).to_numpy(zero_copy_only=False) <= SHORT)
        marked = pc.starts_with(chunks, MARK).to_numpy(zero_copy_only=False)
        done = [x for lead in (True, False) for x in self.words(chunks, np.flatnonzero(letters & (marked != lead)), lead)]
        others = np.flatnonzero(~letters)
        texts = [("\n" if c == MARK * 2 else c[1:] if c[:1] == MARK else " " + c).replace(INNER, " ") for c in chunks.take(pa.array(others)).to_pylist()]

        place, order = np.empty(len(chunks), np.int64), np.concatenate([*(w for w, _ in done), others])
        place[order] = np.arange(len(order))
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(np.full(len(ids), 4 * ids.shape[1]) for _, ids in done)]))
        flat = np.concatenate([np.empty(0, "<i4"), *(ids.ravel() for _, ids in done)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
        return pa.concat_arrays([words, pa.array(self.encode_all(texts), pa.large_binary())]), place

    def ids_of(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        """:meth:`ids` of each text. Arrow cuts the texts and numbers their chunks; each different chunk is encoded once and not kept."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "").cast(pa.large_string())
        alone = pc.match_substring_regex(texts, f"[{MARK}{INNER}]")  # our own marks are taken there
        none, mark = pa.scalar("", pa.large_string()), pa.scalar(MARK, pa.large_string())
        cut = pc.if_else(alone, none, texts)
        for pattern, by in KEPT:
            cut = pc.replace_substring_regex(cut, pattern, by)
        cut = pc.binary_join_element_wise(mark, cut, none)
        for pattern, by in CUT_OFF:
            cut = pc.replace_substring_regex(cut, pattern, by)
        cut = pc.split_pattern(cut, " ")
        first = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        chunks = cut.flatten().dictionary_encode()
        del cut
        ids, place = self.chunk_ids(chunks.dictionary)
        found = ids.take(pa.array(place[chunks.indices.to_numpy()]))
        at = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)[first].tolist()
        data = memoryview(found.buffers()[2] or b"")
        for i, whole in enumerate(alone.to_pylist()):
            yield self.encode(texts[i].as_py()) if whole else data[at[i] : at[i + 1]].tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        first, *rest = text.split(" ")
        try:
            head = self.start[first] if first else b""
            return b"".join([head, *map(self.rest.__getitem__, rest)])
        except TypeError:  # white space next to white space somewhere
            first, *rest = self.cut.split(text)
            return b"".join([self.encode(first), *(self.rest[x] or self.encode(" " + x) for x in rest)])


def tokenizer_at(path: str) -> WordwiseTokenizer:
    """One for each worker process and file."""
    kept = worker_state("tokenizers")
    if path not in kept:
        kept[path] = WordwiseTokenizer(path)
    return kept[path]


def _together(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about so many bytes of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(size // TOGETHER)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield texts.slice(a, b - a)


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's pieces: whole windows, then the rest. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = tokenizer_at(path), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for i, ids in enumerate(x for part in _together(batch.column(1)) for x in tokenizer.ids_of(part)):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    for column, x in zip(out, (i, start, len(part) // 4, zlib.crc32(part), n, part if with_ids else None)):
                        column.append(x)
            of = batch.column(0).take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [of, *(pa.array(x, pa.int64()) for x in out[1:5]), pa.array(out[5], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(handing_back(run), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")
    return found if with_ids else found.drop("ids")


def combinations(count: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Shallow combinations of lengths in use that fill the window: one to four lengths."""
    have = np.flatnonzero(count[:window])
    found: set[tuple[int, ...]] = set()
    present = np.zeros(window + 1, bool)
    present[have] = True

    def pairs(total: int, least: int) -> list[tuple[int, int]]:
        """Of the pairs of lengths from ``least`` that make ``total``: the most frequent ones and some spread evenly."""
        b = have[(have >= least) & (2 * have <= total)]
        b = b[present[total - b]]
        if not len(b):
            return []
        often = b[np.argsort(-np.minimum(count[b], count[total - b]), kind="stable")[: PER_LENGTH // 2]]
        even = b[:: max(1, len(b) // (PER_LENGTH // 2))][: PER_LENGTH // 2]
        return [(int(x), int(total - x)) for x in {*often.tolist(), *even.tolist()}]

    for a in have.tolist():
        if present[window - a] and 2 * a <= window:
            found.add((a, window - a))
        if 3 * a <= window:
            found.update((a, *p) for p in pairs(window - a, a))
        if 4 * a <= window:
            for b in {a, (window - a) // 4, (window - a) // 3}:
                if present[b] and b >= a:
                    found.update((a, b, *p) for p in pairs(window - a - b, b)[:3])
    return sorted(found, key=lambda c: (len(c), c))


def fit(count: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats): non-negative least squares by coordinate descent, rounded to what is there."""
    found = combinations(count, window)
    left = count.astype(float).tolist()
    times = [0.0] * len(found)
    weight = [sum(c.count(x) ** 2 for x in {*c}) for c in found]
    for _ in range(SWEEPS):
        for j, c in enumerate(found):
            step = max(-times[j], sum(left[x] for x in c) / weight[j])
            if step:
                times[j] += step
                for x in c:
                    left[x] -= step
    there = count.tolist()
    used = [((window,), there[window])] if there[window] else []
    for spare in (0.0, 1.0):  # first what the fit says, then what rounding down has left
        for j in sorted(range(len(found)), key=lambda j: (-times[j], j)):
            c = found[j]
            n = min(int(times[j] + 1e-9) if not spare else there[c[0]], *(there[x] // c.count(x) for x in c))
            if n > 0:
                used.append((c, n))
                for x in c:
                    there[x] -= n
    return used


def _slots(used: list[tuple[tuple[int, ...], int]], window: int):
    """For each length: from which rank on which sequence and offset follow; ranks beyond are left over."""
    ranks: list[list[tuple[int, int, int]]] = [[] for _ in range(window + 1)]
    taken, first = [0] * (window + 1), 0
    for c, n in used:
        at = 0
        for x in c:
            ranks[x].append((taken[x], first, at))
            taken[x] += n
            at += x
        first += n
    flat = [np.asarray(r, np.int64).reshape(-1, 3) for r in ranks]
    return flat, np.asarray(taken, np.int64), first


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: by falling length, into the fullest bin that still has room."""
    bins_with: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = np.zeros(window + 1, bool)
    where, offset, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        x = int(lengths[i])
        room = x + int(rooms[x:].argmax())
        if rooms[room]:
            b = bins_with[room].pop()
            rooms[room] = bool(bins_with[room])
        else:
            room, b, n = window, n, n + 1
        where[i], offset[i] = b, window - room
        bins_with[room - x].append(b)
        rooms[room - x] = room > x
    return where, offset


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset there.

    ``path`` names a tokenizer file that every executor can open. The pieces' table is written once;
    ranks inside a length come from counts by length and input partition, so no length meets in one task.
    """
    made = pieces(docs, path, window, end_id, with_ids, doc_id, text)
    table = materialize(made.withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    part = F.shiftright("row_no", 33)
    counts = table.groupBy("length", part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "piece-cells")

    count = np.zeros(window + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        count[r.length] = r.n
    slots, taken, first = _slots(fit(count, window), window)
    buckets = max(1, int((count - taken).sum()) // BUCKET_PIECES)

    inside = Window.partitionBy("length", "part").orderBy("row_no")
    ranked = (
        table.withColumn("part", part).join(cells.drop("n").hint("merge"), ["length", "part"])
        .withColumn("rank", F.col("ahead") + F.row_number().over(inside) - 1)
        .drop("part", "ahead", "row_no")
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            seq, at = np.full(len(pdf), -1, np.int64), np.zeros(len(pdf), np.int64)
            length, rank = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            for x in np.unique(length).tolist():
                if len(slots[x]):
                    own = np.flatnonzero((length == x) & (rank < taken[x]))
                    k = np.searchsorted(slots[x][:, 0], rank[own], "right") - 1
                    seq[own] = slots[x][k, 1] + rank[own] - slots[x][k, 0]
                    at[own] = slots[x][k, 2]
            yield pdf.assign(sequence_id=seq, offset=at, rank=(rank - taken[length]))

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        where, at = best_fit(pdf["length"].to_numpy(), window)
        return pdf.assign(sequence_id=first + pdf["bucket"].to_numpy() + buckets * where, offset=at).drop(columns="bucket")

    kinds = ", ".join(f"{n} {t}" for n, t in ranked.dtypes)
    placed = materialize(ranked.mapInPandas(place, kinds + ", sequence_id bigint, offset bigint"), "placed")
    drop_written(table, cells)
    rest = placed.where("sequence_id < 0").withColumn("bucket", (F.col("rank") + F.col("length")) % buckets)
    packed = rest.groupBy("bucket").applyInPandas(greedy, placed.schema)
    return placed.where("sequence_id >= 0").unionByName(packed).drop("rank")
