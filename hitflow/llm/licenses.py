"""Licence scans: identifier tags and notice phrases by Aho-Corasick, expressions by a shunting-yard parser.

A text is reduced to its words (runs of letters a-z, digits and characters beyond ASCII, with A-Z lowered) joined by
blanks, and one automaton finds all phrases at word borders. Behind an identifier tag the raw text is parsed as
an expression of licence ids with ``or``, ``and`` and ``with`` and parentheses.

Labels: those of all phrases found, and the ids of all valid expressions. Score: how sure the best evidence is; 1 for a
valid expression, 0.9 for a notice that grants something, 0.6 for the bare name of a licence, 0 for nothing.

Defined cases: a null or empty text has no words, no places and score 0; a malformed expression counts as no
evidence; an expression of any length is read to its end or that of its line; repeated and overlapping phrases count at
each place. Rows keep their doc_id, null or repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Base phrases and their labels: fixed values.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Phrases of the method itself: label and score.
NOTICES = {
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl-3", 0.9),
    "mozilla public license": ("mpl-2", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "creative commons attribution sharealike": ("cc-by-sa", 0.9),
    "licensed under cc by sa": ("cc-by-sa", 0.9),
    "licensed under cc by nc": ("cc-by-nc", 0.9),
    "all rights reserved": ("all-rights-reserved", 0.6),
    "public domain": ("public-domain", 0.6),
    "mit license": ("mit", 0.6),
    "apache license": ("apache", 0.6),
    "bsd license": ("bsd", 0.6),
}
TAGS = ("spdx license identifier", "license expression")
BASE_SCORE = 0.9

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes that are no part of a word become blanks.
_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in _LOWER)
_TAG = re.compile(r"spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier|license[^0-9a-z\x80-\xff]+expression")
_LEAD = re.compile(r"[ \t:=\"']*")
# An expression ends with its line.
_TOKEN = re.compile(r"[ \t\r\f\v]*(\(|\)|[a-z0-9][a-z0-9.+:-]*)")
_RANK = {"or": 1, "and": 2, "with": 3}


def parse(source: str, at: int = 0) -> tuple | str | None:
    """The tree of the licence expression at ``at`` as nested (operator, left, right) over ids; None if malformed.

    Takes time in proportion to the expression, however long. Reading stops before the first thing that cannot go on with the expression. ``with`` binds tightest and
    joins a licence with an exception, then ``and``, then ``or``, all from the left.
    """
    output: list = []
    pending: list[str] = []
    wants_operand, depth = True, 0

    def apply() -> bool:
        operator = pending.pop()
        if len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        if operator == "with" and not (isinstance(left, str) and isinstance(right, str)):
            return False
        output.append((operator, left, right))
        return True

    while match := _TOKEN.match(source, at):
        token = match[1]
        if wants_operand:
            if token == "(":
                pending.append(token)
                depth += 1
            elif token == ")" or token in _RANK:
                return None
            else:
                output.append(token.rstrip(".:"))
                wants_operand = False
        elif token == ")" and depth:
            while pending[-1] != "(":
                if not apply():
                    return None
            pending.pop()
            depth -= 1
        elif token in _RANK:
            while pending and pending[-1] != "(" and _RANK[pending[-1]] >= _RANK[token]:
                if not apply():
                    return None
            pending.append(token)
            wants_operand = True
        else:
            break
        at = match.end()
    if wants_operand or depth:
        return None
    while pending:
        if not apply():
            return None
    return output[0]


def choices(tree) -> list[frozenset[str]]:
    """Evaluates an expression: the minimal sets of licences, any of which satisfies it."""
    if isinstance(tree, str):
        return [frozenset([tree])]
    operator, left, right = tree
    if operator == "with":
        return [frozenset([f"{left}-with-{right}"])]
    if operator == "or":
        sets = choices(left) + choices(right)
    else:
        sets = [a | b for a in choices(left) for b in choices(right)]
    sets = list(dict.fromkeys(sets))
    return [s for s in sets if not any(other < s for other in sets)]


def _ordered(tree) -> list:
    """The nodes of a tree, each behind its parts; without recursion, as trees are as deep as expressions are long."""
    nodes, waiting = [], [tree]
    while waiting:
        node = waiting.pop()
        nodes.append(node)
        if not isinstance(node, str) and node[0] != "with":
            waiting += node[1:]
    return nodes[::-1]


def _name(leaf) -> str:
    return leaf if isinstance(leaf, str) else f"{leaf[1]}-with-{leaf[2]}"


def licences(tree) -> list[str]:
    """All licences of an expression, one with its exception counting as one, in order."""
    return sorted({_name(node) for node in _ordered(tree) if isinstance(node, str) or node[0] == "with"})


def satisfied(tree, accepted: set[str]) -> bool:
    """Evaluates an expression: whether the accepted licences are enough for it."""
    values: list[bool] = []
    for node in _ordered(tree):
        if isinstance(node, str) or node[0] == "with":
            values.append(_name(node) in accepted)
        else:
            one, other = values.pop(), values.pop()
            values.append(one or other if node[0] == "or" else one and other)
    return values[0]


def written(tree) -> str:
    """An expression as text, with parentheses where an ``or`` stands below an ``and``."""
    texts: list[tuple[list[str], str]] = []
    for node in _ordered(tree):
        if isinstance(node, str) or node[0] == "with":
            texts.append(([_name(node)], "with"))
            continue
        (right, right_kind), (left, left_kind) = texts.pop(), texts.pop()
        if node[0] == "and":
            left = ["(", *left, ")"] if left_kind == "or" else left
            right = ["(", *right, ")"] if right_kind == "or" else right
        # The left side carries all before it, so appending keeps the time linear.
        left += [f" {node[0]} ", *right]
        texts.append((left, node[0]))
    return "".join(texts[0][0])


@dataclass
class Found:
    """What a scan finds in one text."""

    n_words: int = 0
    places: list[tuple[int, int, str]] = field(default_factory=list)  # first word, words, base label
    labels: set[str] = field(default_factory=set)
    expressions: list[str] = field(default_factory=list)
    score: float = 0.0


class Scanner:
    def __init__(self) -> None:
        self.machine = ahocorasick.Automaton()
        kinds: dict[str, list] = {}
        for phrase, label in BASE.items():
            kinds.setdefault(phrase, []).append(("base", label, BASE_SCORE))
        for phrase, (label, score) in NOTICES.items():
            kinds.setdefault(phrase, []).append(("notice", label, score))
        for phrase in TAGS:
            kinds.setdefault(phrase, []).append(("tag", "", 0.0))
        for phrase, meanings in kinds.items():
            self.machine.add_word(f" {phrase} ", (phrase.count(" ") + 1, len(phrase) + 2, meanings))
        self.machine.make_automaton()

    def scan(self, text: str | None) -> Found:
        found = Found()
        if not text:
            return found
        raw = text.encode("utf-8")
        tokens = raw.translate(_WORDS).split()
        found.n_words = len(tokens)
        # One character for each byte, so the automaton reads bytes.
        line = " " + b" ".join(tokens).decode("latin-1") + " "
        blanks = None
        tagged = False
        for end, (size, length, meanings) in self.machine.iter(line):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
            first = int(np.searchsorted(blanks, end - length + 1))
            for kind, label, score in meanings:
                if kind == "tag":
                    tagged = True
                    continue
                if kind == "base":
                    found.places.append((first, size, label))
                found.labels.add(label)
                found.score = max(found.score, score)
        if tagged:
            self._read_expressions(raw.translate(_LOWER).decode("latin-1"), found)
        return found

    def _read_expressions(self, raw: str, found: Found) -> None:
        """Expressions behind all tags of a text given as one character for each byte."""
        for match in _TAG.finditer(raw):
            tree = parse(raw, _LEAD.match(raw, match.end()).end())
            if tree is not None:
                found.expressions.append(written(tree))
                found.labels.update(licences(tree))
                found.score = 1.0


SCANNED = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, expressions array<string>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text); one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = scanner.scan(text.as_py())
                starts = [place[0] for place in found.places]
                rows.append((
                    found.n_words, len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({place[2] for place in found.places})), ",".join(sorted(found.labels)),
                    found.score, found.expressions,
                ))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCANNED)
