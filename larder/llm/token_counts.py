"""Token counts that follow edits.

A document's text is cut into leaves of a few dozen pre-token chunks, at places where the tokenizer
never joins what stands on either side. A segment tree over the leaves keeps sums of characters and
tokens. An edit finds its place by descending the character sums, re-encodes the leaves it touches and
one more on either side, whose outer edges the edit can't change, and puts the new sums on the paths to the
root. So an edit costs what it touches plus the tree's height, not the document.

Edits of a document are an array of (start, deleted, inserted), in characters, applied in order, each to the
text the ones before have left. Defined cases: a null or empty text has no tokens, and edits may fill it; a
null edit array is none, and a null insertion is empty; a start or length beyond the text is cut to it;
repeated rows are counted as rows of their own; a null id stays null; texts may have any length; an empty
table gives an empty result; columns other than id, text and edits don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import fresh
from larder.llm.packing import WordwiseTokenizer, tokenizer_at

#: Chunks of a new leaf.
CHUNKS = 32
EDITS = "array<struct<start: bigint, deleted: bigint, inserted: string>>"


class TokenTree:
    """Leaves of one text, and the sums over them. ``encoded`` counts the characters that edits had encoded."""

    def __init__(self, tokenizer: WordwiseTokenizer, text: str):
        self.tokenizer, self.encoded = tokenizer, 0
        self.build(text)

    def build(self, text: str) -> None:
        cuts = [m.start() for m in self.tokenizer.cut.finditer(text)][CHUNKS - 1 :: CHUNKS]
        self.leaves = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(leaf), len(self.tokenizer.ids(leaf)) // 4
        for i in range(self.size - 1, 0, -1):
            self.add_up(i)

    def add_up(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def __len__(self) -> int:
        return self.chars[1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and where in it; past the end, the last leaf."""
        if at >= self.chars[1]:
            last = len(self.leaves) - 1
            return last, len(self.leaves[last])
        i = 1
        while i < self.size:
            i *= 2
            if at >= self.chars[i]:
                at -= self.chars[i]
                i += 1
        return i - self.size, at

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        start = min(max(0, start), len(self))
        deleted = min(max(0, deleted), len(self) - start)
        if not deleted and not inserted:
            return
        lo, at = self.find(start)
        hi = self.find(start + deleted)[0]
        # One leaf with text more on either side: its far edge, and the two characters there, stay as they are.
        first, last = lo, hi
        while first > 0:
            first -= 1
            if self.leaves[first]:
                break
        while last + 1 < len(self.leaves):
            last += 1
            if self.leaves[last]:
                break
        at += sum(len(x) for x in self.leaves[first:lo])
        old = "".join(self.leaves[first : last + 1])
        new = old[:at] + inserted + old[at + deleted :]
        self.encoded += len(new)
        self.put(first, last, new)

    def put(self, first: int, last: int, text: str) -> None:
        """Deal a text out to leaves ``first`` to ``last``, cut where chunks end."""
        slots = last - first + 1
        cuts = [m.start() for m in self.tokenizer.cut.finditer(text)]
        if len(cuts) + 1 > 8 * CHUNKS * slots:  # far more text than the leaves are meant for
            whole = self.leaves[:first] + [text] + self.leaves[last + 1 :]
            self.build("".join(whole))
            return
        step = -(-(len(cuts) + 1) // slots)
        chosen = cuts[step - 1 :: step][: slots - 1]
        parts = [text[a:b] for a, b in zip([0, *chosen], [*chosen, len(text)])]
        parts += [""] * (slots - len(parts))
        touched = set()
        for i, part in zip(range(first, last + 1), parts):
            self.leaves[i] = part
            self.chars[self.size + i], self.tokens[self.size + i] = len(part), len(self.tokenizer.ids(part)) // 4
            touched.add((self.size + i) // 2)
        while touched and touched != {0}:
            for i in touched:
                self.add_up(i)
            touched = {i // 2 for i in touched}


def attach_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with an array column ``edits`` from a table (doc_id, seq, start, deleted, inserted)."""
    one = F.struct("seq", "start", "deleted", "inserted")
    of, docs = fresh(docs, "of"), docs.drop("edits")
    each = edits.groupBy(F.col(doc_id).alias(of)).agg(F.sort_array(F.collect_list(one)).alias("edits"))
    each = each.withColumn("edits", F.transform("edits", lambda e: F.struct(e.start.alias("start"), e.deleted.alias("deleted"), e.inserted.alias("inserted"))))
    return docs.join(each, F.col(doc_id) == F.col(of), "left").drop(of)


def recount(docs: DataFrame, path: str, edits: str = "edits", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts before and after the edits, and the leaves as they are then (characters and tokens of each). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], [], []]
            for cell, todo in zip(batch.column(1), batch.column(2)):
                tree = TokenTree(tokenizer, cell.as_py() or "")
                before, leaves = tree.count, len(tree.leaves)
                todo = todo.as_py() or []
                for e in todo:
                    if e:
                        tree.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "")
                n = len(tree.leaves)
                leaf = slice(tree.size, tree.size + n)
                for column, x in zip(out, (before, tree.count, len(todo), len(tree), tree.encoded, leaves, tree.chars[leaf], tree.tokens[leaf])):
                    column.append(x)
            kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds))],
                names=["doc_id", "n_tokens", "n_tokens_after", "n_edits", "n_chars_after", "n_encoded_chars", "n_leaves", "leaf_chars", "leaf_tokens"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.col(edits).cast(EDITS).alias("edits"))
    return rows.mapInArrow(
        run,
        "doc_id bigint, n_tokens bigint, n_tokens_after bigint, n_edits bigint, n_chars_after bigint, n_encoded_chars bigint,"
        " n_leaves bigint, leaf_chars array<int>, leaf_tokens array<int>",
    )


# What the redaction of personal data looks for, and puts in its place.
PERSONAL = (
    (re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<email>"),
    (re.compile(r"\+?\d[\d ()-]{7,}\d"), "<number>"),
)


def redactions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, edits): the edits that put a mark in place of every e-mail address and long number."""
    def edits_of(text: str) -> list[dict]:
        found = sorted((m.start(), m.end(), mark) for pattern, mark in PERSONAL for m in pattern.finditer(text))
        out, shift, done = [], 0, 0
        for a, b, mark in found:
            if a >= done:
                out.append({"start": a + shift, "deleted": b - a, "inserted": mark})
                shift += len(mark) - (b - a)
                done = b
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("deleted", pa.int64()), ("inserted", pa.string())]))
        for batch in batches:
            found = [edits_of(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], names=["doc_id", "text", "edits"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, text string, edits {EDITS}")
