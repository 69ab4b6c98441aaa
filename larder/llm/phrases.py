"""Phrases of two and three words whose words stand together more often than apart.

First pass: every task hashes all runs of one to three words and deals its counts out to hash partitions. Each
partition folds the counts that come in into one Misra-Gries summary: with more than ``capacity`` entries, the next
largest count is taken off all of them. The capacity exceeds the partition's mass divided by the threshold, so what
is taken off in total stays below the threshold and every run that reaches it survives. A run whose count and what was
taken off together miss the threshold can't reach it and goes. Second pass: the runs whose hash begins like
that of a survivor are counted exactly, by their words. So hashes that meet cost counting, never a wrong count.

The rest is joins of those counts, at most a tenth (one by the threshold) of all runs: both parts of every cut, the
longer phrases that hold a shorter one, and the first so many of every language.

Defined cases: a null or empty text has no words, and a language with no words has no row; a null language is
``und``; repeated rows and rows without an id count like any other; a text of any length is read whole, in slices;
equal scores rank by count, then by the phrase's bytes; an empty table gives an empty result; columns other than
the two named don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import drop_written, materialize, mix64

#: Words of a block, and bytes of a text that are split at once.
BLOCK_WORDS, SLICE = 400_000, 1 << 20
#: Bits of a hash that tell runs of one partition apart, and the mass a partition is meant to hold.
REST_BITS, PARTITION_MASS = 40, 8_000_000
#: Entries that wait before they are folded into a summary.
WAITING = 500_000
#: Bits of the map of survivors: a proven bound of 16 MB on what is broadcast.
MOST_MAP_BITS = 27
BREAK = b"\xff"  # no byte of UTF-8
#: A-Z in lower case, what ends a piece as a break, tabs as spaces.
_FOLD = bytes(0xFF if c in b".,;:!?\n\x0b\f\r" else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256))
_ID_BITS = 21


class _Ids(dict):
    """Numbers for the words of one language, from 1, drawn from a list that all languages of a block share."""

    def __init__(self, lang: str, names: list):
        self.lang, self.names = lang, names
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append((self.lang, word))
        return n


class Block:
    """Numbers of consecutive words, 0 where a piece ends. Runs that end within the first ``carried`` words were counted before."""

    def __init__(self, words: list[np.ndarray], names: list, carried: int):
        import xxhash

        self.ids, self.names = np.concatenate(words) if words else np.zeros(0, np.int64), names
        seeds: dict[str, int] = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in {n[0] for n in names if n}}
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(n[1], seeds[n[0]]) if n else 0 for n in names), np.uint64, len(names))
        one, word = hashes[self.ids], self.ids > 0
        two = mix64(mix64(one[:-1]) + one[1:] * np.uint64(0x9E3779B97F4A7C15))
        three = mix64(two[:-1] + one[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
        pairs = word[:-1] & word[1:]
        #: For one to three words: where such runs end, and their hashes.
        self.runs = []
        for n, (h, there) in enumerate(((mix64(one), word), (two, pairs), (three, pairs[:-1] & word[2:])), 1):
            ends = np.flatnonzero(there) + n - 1
            ends = ends[ends >= carried]
            self.runs.append((ends, h[ends - n + 1]))

    def counts_by_lang(self, carried: int) -> dict[str, int]:
        seen: dict[str, int] = {}
        at, n = np.unique(self.ids[carried:], return_counts=True)
        for i, m in zip(at.tolist(), n.tolist()):
            if i:
                seen[self.names[i][0]] = seen.get(self.names[i][0], 0) + m
        return seen


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, int]]:
    """Blocks of the (lang, text) rows of a task, and how many words each repeats from the one before."""
    words: list[np.ndarray] = []
    names: list = [None]
    ids: dict[str, _Ids] = {}
    held = carried = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, cell in zip(batch.column(0).to_pylist(), texts):
            text = (cell.as_py() or b"").translate(_FOLD)
            at = 0
            while at < len(text):
                end = at + SLICE
                if end < len(text):  # cut where no word stands
                    space, brk = text.rfind(b" ", at, end), text.rfind(BREAK, at, end)
                    end = max(space, brk) + 1
                    if end <= at:  # a word longer than a slice
                        after = [x for x in (text.find(b" ", at), text.find(BREAK, at)) if x >= 0]
                        end = min(after) + 1 if after else len(text)
                own = ids.get(lang)
                if own is None:
                    own = ids[lang] = _Ids(lang, names)
                found = text[at:end].replace(BREAK, b" \xff ").split()
                words.append(np.fromiter(map(own.__getitem__, found), np.int64, len(found)))
                held += len(found)
                at = end
                if held >= BLOCK_WORDS:
                    yield Block(words, names, carried), carried
                    last = np.concatenate(words)[-2:].tolist() if at < len(text) else []
                    again = [names[i][1] if i else BREAK for i in last]
                    names, ids = [None], {}
                    own = ids[lang] = _Ids(lang, names)
                    words, held, carried = [np.asarray([own[w] for w in again], np.int64)], len(again), len(again)
            words.append(np.zeros(1, np.int64))
            held += 1
    if held > carried:
        yield Block(words, names, carried), carried


def _rows(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def summaries(rows: DataFrame, bits: int) -> DataFrame:
    """Counts by hash of every block, dealt out to 2 ** bits partitions; a partition's masses come before its counts."""
    shift = np.uint64(64 - bits - REST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _blocks(batches):
            keys = np.concatenate([h for _, h in block.runs]) >> shift
            keys.sort()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            counts = np.diff(np.append(starts, len(keys)))
            keys = keys[starts]
            part = (keys >> np.uint64(REST_BITS)).astype(np.int64)
            at = np.searchsorted(part, np.arange((1 << bits) + 1))
            rest = keys.view(np.uint8).reshape(-1, 8)[:, : REST_BITS // 8]
            out: list[list] = [[], [], [], [], []]
            for p in range(1 << bits):
                a, b = int(at[p]), int(at[p + 1])
                if b > a:
                    own = counts[a:b]
                    for row in ((p, 0, int(own.sum()), None, None), (p, 1, 0, rest[a:b].tobytes(), _pack(own))):
                        for column, x in zip(out, row):
                            column.append(x)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["part", "kind", "mass", "hashes", "counts"])

    return rows.mapInArrow(run, "part int, kind int, mass bigint, hashes binary, counts binary")


def _pack(counts: np.ndarray) -> bytes:
    """A byte for each count; 0 says that it follows at the end in four bytes."""
    big = counts > 255
    return np.where(big, 0, counts).astype(np.uint8).tobytes() + counts[big].astype("<u4").tobytes()


def _unpack(n: int, packed: bytes) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 0] = np.frombuffer(packed, "<u4", offset=n)
    return counts


class MisraGries:
    """Counts by key; more than ``capacity`` of them lose the next largest count. ``lost`` is what was taken off any key at most."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting >= max(WAITING, self.capacity):
            self.fold()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if len(keys) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.lost += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys that may have reached the threshold."""
        self.fold()
        return self.keys[self.counts + self.lost >= threshold]


def survivors(dealt: DataFrame, threshold: int) -> DataFrame:
    """(part, n, hashes): what may have reached the threshold, by partition. Reads one partition's rows after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def done() -> Iterator[pa.RecordBatch]:
            if summary is not None:
                keys = summary.reaching(threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([keys.astype("<u8").tobytes()], pa.binary())], names=["part", "n", "hashes"]
                )

        for batch in batches:
            for p, kind, m, hashes, counts in zip(*(batch.column(i) for i in range(5))):
                p = p.as_py()
                if p != part:
                    yield from done()
                    part, mass, summary = p, 0, None
                if not kind.as_py():
                    mass += m.as_py()
                    continue
                if summary is None:  # all masses of the partition have been read
                    summary = MisraGries(mass // threshold + 1)
                raw = np.frombuffer(hashes.as_py(), np.uint8).reshape(-1, REST_BITS // 8)
                keys = np.zeros((len(raw), 8), np.uint8)
                keys[:, : REST_BITS // 8] = raw
                summary.add(keys.view("<u8").ravel(), _unpack(len(raw), counts.as_py()))
        yield from done()

    return dealt.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, "part int, n bigint, hashes binary")


def survivor_map(found: DataFrame, bits: int) -> np.ndarray:
    """A bit for each beginning of a hash: whether a survivor's hash begins so. At most 2 ** ``MOST_MAP_BITS`` bits."""
    n = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    size = max(bits + 3, min(MOST_MAP_BITS, int(64 * n).bit_length()))
    own = size - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for cell in batch.column(1):
                there = np.zeros(1 << own, np.uint8)
                there[np.frombuffer(cell.as_py(), "<u8") >> np.uint64(REST_BITS - own)] = 1
                made.append(np.packbits(there, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["part", "map"])

    whole = np.zeros(1 << (size - 3), np.uint8)
    step = 1 << (own - 3)
    for r in found.select("part", "hashes").mapInArrow(run, "part int, map binary").toLocalIterator():
        whole[r.part * step : (r.part + 1) * step] = np.frombuffer(r.map, np.uint8)
    return whole


def exact_counts(rows: DataFrame, there: np.ndarray) -> DataFrame:
    """(lang, phrase, words, f): exact counts by block of all runs that the map lets through; a null phrase has all words of the language."""
    sent = rows.sparkSession.sparkContext.broadcast(there)
    size = (len(there) * 8).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, shift = sent.value, np.uint64(64 - size)
        for block, carried in _blocks(batches):
            all_words = block.counts_by_lang(carried)
            langs, phrases, lengths, counts = [*all_words], [None] * len(all_words), [0] * len(all_words), [*all_words.values()]
            names, ids = block.names, block.ids
            for n, (ends, hashes) in enumerate(block.runs, 1):
                place = hashes >> shift
                ends = ends[(there[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                key = ids[ends - n + 1]
                for j in range(n - 2, -1, -1):
                    key = key << _ID_BITS | ids[ends - j]
                found, f = np.unique(key, return_counts=True)
                first = found >> (_ID_BITS * (n - 1))
                columns = [(found >> (_ID_BITS * j)) & ((1 << _ID_BITS) - 1) for j in range(n - 1, -1, -1)]
                phrases += [b" ".join([names[i][1] for i in run]) for run in zip(*(c.tolist() for c in columns))]
                langs += [names[i][0] for i in first.tolist()]
                lengths += [n] * len(found)
                counts += f.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(lengths, pa.int32()), pa.array(counts, pa.int64())],
                names=["lang", "phrase", "words", "f"],
            )

    return rows.mapInArrow(run, "lang string, phrase string, words int, f bigint")


def partition_bits(rows: DataFrame, mass: int = PARTITION_MASS) -> int:
    """So many bits that a hash partition holds about ``mass`` runs; a word is taken to be five bytes."""
    n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    return max(6, min(16, (3 * n // 5 // mass).bit_length()))


def frequent_runs(docs: DataFrame, threshold: int = 10, bits: int | None = None, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, phrase, words, f): all runs of one to three words with f >= threshold, exactly; words 0 and a null phrase: all words."""
    rows = _rows(docs, lang, text)
    bits = partition_bits(rows) if bits is None else bits
    found = materialize(survivors(summaries(rows, bits), threshold), "phrase-survivors")
    there = survivor_map(found, bits)
    drop_written(found)
    counted = exact_counts(rows, there).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return counted.where((F.col("words") == 0) | (F.col("f") >= threshold))


def collocations(docs: DataFrame, threshold: int = 10, most: int = 2000, share: int = 50, bits: int | None = None, lang: str = "lang", text: str = "text") -> DataFrame:
    """The first ``most`` phrases of every language by score, with their rank.

    Phrases inside a longer one that has at least ``share`` percent of their count are left out.
    """
    runs = materialize(frequent_runs(docs, threshold, bits, lang, text), "phrase-counts")
    words = F.split("phrase", " ", -1)
    phrases = runs.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), words.alias("w"))
    total = runs.where("words = 0").select("lang", F.col("f").alias("n"))
    part = runs.where("words > 0").select("lang", "phrase", "f")

    longer = phrases.where("words = 3").select(
        "lang", "a", F.explode(F.array(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]))).alias("phrase")
    )
    inside = longer.groupBy("lang", "phrase").agg(F.max("a").alias("in_longer"))
    free = phrases.join(inside, ["lang", "phrase"], "left").where(f"in_longer is null or 100 * in_longer < {share} * a")

    def cut(k: int):
        return F.struct(
            F.lit(k).alias("k"),
            F.concat_ws(" ", F.slice("w", 1, k)).alias("first"),
            F.concat_ws(" ", F.slice("w", F.lit(k + 1), F.col("words") - k)).alias("rest"),
        )

    cuts = free.select("lang", "phrase", "a", F.explode(F.when(F.col("words") == 3, F.array(cut(1), cut(2))).otherwise(F.array(cut(1)))).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.*")
    left = part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # Products of three counts pass 64 bits; decimals of 38 digits hold them, and div is exact.
    wide = "cast({} as decimal(38, 0))"
    score = f"{wide.format('1000000')} * {wide.format('a')} * {wide.format('a')} div ({wide.format('l')} * {wide.format('r')})"
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", F.expr(score))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("m"))
    best = lowest.select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    first = best.withColumn("rank", place).where(F.col("rank") <= most)
    return first.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
