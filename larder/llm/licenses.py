"""License scans: Aho-Corasick over words, shunting-yard over licence expressions.

A text is cut into words (ASCII letters in lower case, digits, anything beyond ASCII). One automaton
holds all phrases as runs of words and finds every place of every phrase in one pass. Where it finds
the words of an identifier tag, the expression that follows in the text is read by a shunting-yard
parser: ``or`` takes the freer side, ``and`` the stricter one, ``with`` binds an exception to its licence.
An expression may begin on a later line than its tag. It ends before the next tag, where a word doesn't fit,
or at the end of a line if it is complete there and the next one doesn't go on with an operator (in upper
case, or before a known licence).

Defined cases: null text counts as empty and has no words, no labels and score 0; a repeated row is
scanned again; a null id stays null; texts may have any length. A malformed expression is read as
far as it makes sense (an open bracket closes where the expression ends). The score is the freedom of
everything found, the strictest statement deciding: 0 means no licence at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases the contract names, and its labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Public notice phrases, and how freely a licence lets a text be used.
NOTICE_PHRASES = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "creative commons attribution sharealike": "cc-by-sa",
    "all rights reserved": "proprietary",
}
FREEDOM = {
    "public-domain": 1.0, "unlicense": 1.0, "cc0-1": 1.0, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache-2": 1.0,
    "cc-by": 0.9, "mpl-2": 0.7, "cc-by-sa": 0.6, "lgpl": 0.6, "gpl-2": 0.5, "gpl-3": 0.5, "agpl-3": 0.4,
    "cc-by-nc": 0.2, "proprietary": 0.05,
}
#: For licences that the table doesn't know.
UNKNOWN = 0.5
TAG = "spdx license identifier"

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_PLACE = re.compile(rb"[^ ]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """The label of a licence identifier: lower case, no -only/-or-later, no minor version."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower().rstrip(".:-"))
    if (m := re.fullmatch(r"(cc-by(?:-nc|-sa|-nd)*)-[0-9.]+", name)):
        return "cc-by-nc" if "-nc" in m[1] else m[1]
    if name.startswith("bsd-"):
        return "bsd"
    if name.startswith("lgpl"):
        return "lgpl"
    return re.sub(r"(-[0-9]+)(\.[0-9]+)+$", r"\1", name)


def evaluate(expression: str) -> tuple[float | None, set[str]]:
    """Freedom and labels of a licence expression; (None, empty) where it holds no licence."""
    values: list[tuple[float, set[str]]] = []
    pending: list[str] = []

    def apply() -> None:
        op = pending.pop()
        right, left = values.pop(), values.pop()
        if op == "with":
            values.append(left)
        else:
            values.append(((max if op == "or" else min)(left[0], right[0]), left[1] | right[1]))

    def goes_on(operator: re.Match) -> bool:
        after = _TOKEN.search(expression, operator.end())
        return operator[0].lower() in _RANK and bool(operator[0].isupper() or after and label_of(after[0]) in FREEDOM)

    operand_next, end = True, 0
    for found in _TOKEN.finditer(expression):
        if not operand_next and "(" not in pending and "\n" in expression[end : found.start()] and not goes_on(found):
            break
        token, end = found[0].lower(), found.end()
        if token == "(":
            if not operand_next:
                break
            pending.append(token)
        elif token == ")":
            if operand_next or "(" not in pending:
                break
            while pending[-1] != "(":
                apply()
            pending.pop()
        elif token in _RANK:
            if operand_next:
                break
            while pending and pending[-1] != "(" and _RANK[pending[-1]] >= _RANK[token]:
                apply()
            pending.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            name = label_of(token)
            values.append((FREEDOM.get(name, UNKNOWN), {name}))
            operand_next = False
    if operand_next:  # an operator or bracket that nothing follows
        while pending and values and (pending[-1] == "(" or len(values) < 1 + sum(x != "(" for x in pending)):
            pending.pop()
    while pending:
        if pending[-1] == "(":
            pending.pop()
        else:
            apply()
    return values[0] if values else (None, set())


class Scanner:
    """The automaton, and what it makes of one text."""

    def __init__(self, base: Mapping[str, str], more: Mapping[str, str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in {*base, *more, TAG}:
            found = (phrase, base.get(phrase), more.get(phrase), len(phrase) + 2)
            self.automaton.add_word(f" {phrase} ", found)
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        """n_words, places as (phrase, label, base, word), labels, freedom."""
        plain = text.translate(_FOLD)
        words = plain.split()
        folded = b" " + b" ".join(words) + b" "
        places, levels, labels, tags, word, read = [], [], set(), [], -1, 0
        for end, (phrase, base, more, size) in self.automaton.iter(folded.decode("latin-1")):
            # Words before the match, counted on (or back, by a phrase's length at most) from the match before.
            start = end - size + 2
            word += folded.count(b" ", read, start) - folded.count(b" ", start, read)
            read = start
            if phrase == TAG:
                tags.append(word)
            if base or more:
                labels.add(base or more)
                levels.append(FREEDOM.get(base or more, UNKNOWN))
                places.append((phrase, base or more, base is not None, word))
        if tags:
            spans = [m.span() for m in _PLACE.finditer(plain)]
            first, last = [spans[w][0] for w in tags], [spans[w + TAG.count(" ")][1] for w in tags]
            for lo, hi in zip(last, [*first[1:], len(text)]):
                said = text[lo:hi].decode("utf-8", "replace")
                level, names = evaluate(said)
                # Without its colon a tag is prose, unless licences follow that are known or declared.
                declared = said.lstrip().startswith(":") or all(n in FREEDOM or n.startswith("licenseref-") for n in names)
                if level is not None and declared:
                    levels.append(level)
                    labels |= names
        return len(words), places, sorted(labels), min(levels, default=0.0)


SCHEMA = (
    "doc_id bigint, n_words bigint, places array<struct<phrase: string, label: string, base: boolean, word: bigint>>,"
    " labels array<string>, score double"
)


def scan_licenses(
    docs: DataFrame,
    base: Mapping[str, str] = BASE_PHRASES,
    more: Mapping[str, str] = NOTICE_PHRASES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: words, every place of a phrase, labels, freedom. No shuffle."""
    base, more = dict(base), dict(more)
    place = pa.struct([("phrase", pa.string()), ("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, more)
        for batch in batches:
            n, places, labels, scores = [], [], [], []
            for cell in batch.column(1):
                words, found, names, score = scanner.scan(cell.as_py() or b"")
                n.append(words)
                places.append([dict(zip(("phrase", "label", "base", "word"), p)) for p in found])
                labels.append(names)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(places, pa.list_(place)), pa.array(labels, pa.list_(pa.string())), pa.array(scores, pa.float64())],
                names=["doc_id", "n_words", "places", "labels", "score"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def license_report(scanned: DataFrame) -> DataFrame:
    """The contract's columns of ``scan_licenses``."""
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p.word)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda p: p.label))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
