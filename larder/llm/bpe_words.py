"""Encoding texts by byte-pair merges of words, and decoding ids.

A short word is held as two arrays side by side: the ids of its parts, and the rank at which each part
merges with the next. The least rank is looked for over and over; its boundary is deleted and the ranks of
the neighbours are refreshed. New words of one length are the rows of one pair of matrices and take their
merges in step. A word longer than ``SHORT`` parts would cost the square of its length that way,
so there a heap of ranks over a linked list takes the same merges in the same order.

Which characters a text is made of before (normal form, lower case) and where words end is what the tokenizer's
file says. No word reaches across white space, so texts are cut there and pieces seen before are looked up; a
worker forgets them when it holds too many.

Defined cases: a null or empty text has no ids and decodes to the empty text; texts and words of any length are
encoded whole; the file's special tokens are found in texts as the library finds them; repeated rows are
encoded as rows of their own; a null id stays null; an id outside the vocabulary decodes to nothing; an empty table
gives an empty result; columns other than the two named don't matter.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import worker_state

#: Parts of a word whose ranks are scanned; beyond that they stand in a heap.
SHORT = 64
#: Pieces of text that a worker remembers in each of two generations, the longest of them, and characters of texts worked on together.
REMEMBERED, LONGEST, TOGETHER = 150_000, 40, 1_000_000
NONE = 1 << 30
#: What str.split() takes for white space and the tokenizer doesn't, and what it takes.
NOT_WHITE = re.compile("[\x1c-\x1f]")
WHITE = re.compile("[" + "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]+")
#: Below U+0300 nothing composes, so the normal form changes nothing there and lower case goes letter by letter.
BEYOND = re.compile("[^\x00-\u02ff]")
LETTERS, NUMBERS = ("".join(c for c in map(chr, range(0x300)) if unicodedata.category(c)[0] == kind) for kind in "LN")
#: The file's own pattern for words, on lower-case text below U+0300 without white space.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")
#: A sign after a letter and before a space is a word of its own; cut off, it leaves fewer different pieces.
LONE_SIGN = re.compile("(?<=[a-z])([.,])(?= )")


def byte_names() -> list[str]:
    """The character that stands for each byte: itself where it shows, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Known:
    """What has been encoded before: a young generation and the one before it."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, asked: set[str]) -> list[str]:
        """Those that neither generation has; the old one's are taken over into the young one."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        out, old = [], self.old
        for x in asked.difference(self.young):
            if x in old:
                self.young[x] = old[x]
            else:
                out.append(x)
        return out


class MergeTable:
    """Ranked merges of a byte-pair file, and words merged side by side. ``end`` is what a word's last part ends with."""

    def __init__(self, model: dict, end: str = ""):
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Two ids as one number to rank; rank to new id.
        self.merges = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = np.asarray([vocab[a + b] for a, b in pairs], np.int64)
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.order = np.fromiter(self.merges.values(), np.int64, len(keys))[order]
        self.inner = np.asarray([vocab[c] for c in byte_names()], np.int64)
        self.last = np.asarray([vocab[c + end] for c in byte_names()], np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks at which ids merge with the ids next to them."""
        asked = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.order[at], NONE)

    def merged(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length, given as rows of bytes: which of them have come to so many ids, and those, row by row."""
        ids = self.inner[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        ranks = np.full(ids.shape, NONE, np.int64)  # the last part merges with nothing
        ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        word = np.arange(len(ids))
        while len(ids):
            i = ranks.argmin(axis=1)
            least = ranks[np.arange(len(i)), i]
            done = least == NONE
            if done.any():
                yield word[done], ids[done].astype("<i4")
                ids, ranks, word, i, least = (x[~done] for x in (ids, ranks, word, i, least))
            row, width = np.arange(len(i)), ids.shape[1] - 1
            ids[row, i] = self.made[least]
            stay = np.arange(width) + (np.arange(width) > i[:, None])
            ids, ranks = np.take_along_axis(ids, stay, 1), np.take_along_axis(ranks, stay, 1)
            ranks[row, i] = NONE
            has = i < width - 1
            ranks[row[has], i[has]] = self.ranks(ids[row[has], i[has]], ids[row[has], i[has] + 1])
            has = i > 0
            ranks[row[has], i[has] - 1] = self.ranks(ids[row[has], i[has] - 1], ids[row[has], i[has]])

    def short_words(self, raw: np.ndarray) -> list[bytes]:
        """Ids of words of one length, given as rows of bytes."""
        out = [b""] * len(raw)
        for words, ids in self.merged(raw):
            size, flat = 4 * ids.shape[1], ids.tobytes()
            for j, w in enumerate(words.tolist()):
                out[w] = flat[j * size : (j + 1) * size]
        return out

    def long_word(self, raw: bytes) -> bytes:
        """The same merges, least rank and then leftmost first, from a heap."""
        ids, n, merges = [*self.inner[np.frombuffer(raw, np.uint8)].tolist()], len(raw), self.merges
        ids[-1] = int(self.last[raw[-1]])
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, i, pair) for i in range(n - 1) if (rank := merges.get(pair := ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] < 0 or ids[i] << 32 | ids[j] != pair:
                continue  # one of the two has been merged since
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := merges.get(both := ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (found, a, both))
        return np.asarray([x for x in ids if x >= 0], "<i4").tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        out = [b""] * len(words)
        for length, at in by_length.items():
            own = [words[i] for i in at]
            if length > SHORT:
                made = map(self.long_word, own)
            else:
                made = self.short_words(np.frombuffer(b"".join(own), np.uint8).reshape(-1, length))
            for i, ids in zip(at, made):
                out[i] = ids
        return out


class WordBpe(MergeTable):
    """Ids of texts and texts of ids, by a file of word-end byte-pair merges."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, tokenizer = said["model"], Tokenizer.from_file(path)
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.normalize, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        super().__init__(model, end)
        self.byte_of = {c: b for b, c in enumerate(byte_names())}
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = np.asarray([names.get(i) for i in range(max(names) + 1)], object)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pieces = _Known()

    def parts(self, piece: str) -> list[bytes | int]:
        """The words of a piece, as bytes, and its special tokens, as ids."""
        if "<|" not in piece and not BEYOND.search(piece):
            return [w.encode() for w in WORDS.findall(piece.lower())]
        out: list[bytes | int] = []
        for i, part in enumerate(self.specials.split(piece)):
            if i % 2:
                out.append(self.special[part])
            elif part:
                out += [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.cut(self.normalize(part)) if w]
        return out

    def learn(self, pieces: list[str]) -> None:
        parts = [self.parts(p) for p in pieces]
        new = [*{w for own in parts for w in own if type(w) is bytes}]
        known: dict = dict(zip(new, self.encode_words(new)))
        known.update((i, np.asarray([i], "<i4").tobytes()) for i in self.special.values())
        self.pieces.young.update((p, known[own[0]] if len(own) == 1 else b"".join(map(known.__getitem__, own))) for p, own in zip(pieces, parts))

    def split(self, text: str) -> list[str]:
        """Pieces between white space."""
        if "<|" not in text and not BEYOND.search(text):
            text = LONE_SIGN.sub(r" \1", text.lower())
        return WHITE.split(text) if NOT_WHITE.search(text) else text.split()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) <= TOGETHER):
                size += len(texts[b])
                b += 1
            split = [self.split(t) for t in texts[a:b]]
            asked: set[str] = set()
            for pieces in split:
                asked.update(pieces)
            new = self.pieces.missing(asked)
            self.learn(new)
            young = self.pieces.young
            for pieces in split:
                yield b"".join(map(young.__getitem__, pieces))
            for piece in new:
                if len(piece) > LONGEST:
                    del young[piece]
            a = b

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The tokens of each run of ids between single spaces; ids without a token are left out."""
        good = (ids >= 0) & (ids < len(self.names))
        tokens = self.names[np.where(good, ids, 0)]
        if not good.all():
            tokens[~good] = None
        tokens = tokens.tolist()
        cuts = ends.tolist()
        whole = None not in tokens
        return [" ".join(tokens[a:b] if whole else [t for t in tokens[a:b] if t is not None]) for a, b in zip(cuts, cuts[1:])]


def word_bpe_at(path: str) -> WordBpe:
    """One for each worker process and file."""
    kept = worker_state("word_bpe")
    if path not in kept:
        kept[path] = WordBpe(path)
    return kept[path]


def _encoded(bpe: WordBpe, texts: list[str | None], most: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows in runs of about so many ids: where a run begins and ends, its ids, and where each row's begin there."""
    a, made, n = 0, [], 0
    for i, ids in enumerate(bpe.ids([t or "" for t in texts]), 1):
        made.append(ids)
        n += len(ids) // 4
        if n >= most or i == len(texts):
            yield a, i, np.frombuffer(b"".join(made), "<i4"), np.cumsum([0, *(len(x) // 4 for x in made)], dtype=np.int64)
            a, made, n = i, [], 0


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of every whole text; with ``decoded``, also their text, made in the same pass.

    ``path`` names a file that every executor can open. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe_at(path)
        for batch in batches:
            for a, b, ids, ends in _encoded(bpe, batch.column(1).to_pylist()):
                out = {"doc_id": batch.column(0).slice(a, b - a), "ids": _lists(ids, ends)}
                if decoded:
                    out["decoded"] = pa.array(bpe.texts(ids, ends), pa.string())
                yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>" + (", decoded string" if decoded else ""))


def _runs(ends: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Rows in runs of so many ids, one row at least."""
    a, rows = 0, len(ends) - 1
    while a < rows:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        yield a, min(b, rows)
        a = b


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in column ``out``; null ids decode to the empty text. No shuffle."""
    kept = [c for c in encoded.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe_at(path)
        for batch in batches:
            lists = batch.column(kept.index(ids))
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            for a, b in _runs(ends):
                texts = bpe.texts(flat[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(texts, pa.string())], names=[*kept, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*kept).schema)
    return encoded.select(*kept).mapInArrow(run, f"{kinds}, `{out}` string")
