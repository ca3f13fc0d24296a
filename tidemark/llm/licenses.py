"""Licence statements: identifier tags and notice phrases found by one automaton, and
licence expressions evaluated by a shunting-yard parser.

Text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Phrases
are matched on the words in one pass of an Aho-Corasick automaton, so a phrase is found
across any punctuation and line break. ``SPDX-License-Identifier:`` tags are found by an
automaton on the text itself; the expression after the tag, up to the end of the line or
the next tag, is parsed whole, and every licence in it becomes a label.

The score says how freely a text may be used by what it says of itself: AND takes the
strictest part, OR the freest, WITH an exception moves a licence half-way to 1; several
statements hold together. 0.5 if nothing is said.

Defined results: NULL and empty texts have no words, empty labels and score 0.5. A
malformed expression gives the licences it names and the strictest of them. Repeated
statements count each as a place and once as a label. Rows are kept as they are; columns
with the result's names are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ready

#: Words -> label.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notice phrases beyond the base: words -> label.
NOTICES = {
    "mit license": "mit",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "licensed under": "licensed",
    "permission is hereby granted free of charge": "mit",
}
#: How freely a licence lets a text be used; a label takes that of its longest prefix here.
FREEDOM = {
    "cc0": 1.0,
    "public-domain": 1.0,
    "unlicense": 1.0,
    "mit": 0.95,
    "bsd": 0.95,
    "isc": 0.95,
    "apache": 0.9,
    "cc-by": 0.85,
    "cc-by-sa": 0.6,
    "mpl": 0.6,
    "epl": 0.6,
    "lgpl": 0.5,
    "gpl": 0.3,
    "agpl": 0.2,
    "cc-by-nc": 0.2,
    "cc-by-nd": 0.2,
    "reserved": 0.0,
}
UNSAID = 0.5
TAG = "spdx-license-identifier:"

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")


def freedom(label: str) -> float:
    known = [k for k in FREEDOM if label == k or label.startswith(f"{k}-")]
    return FREEDOM[max(known, key=len)] if known else UNSAID


def evaluate(expression: str) -> tuple[list[str], float]:
    """The licences an expression names, and its freedom."""
    output: list[float] = []
    operators: list[str] = []
    names: list[str] = []
    is_exception = False

    def reduce() -> None:
        operator = operators.pop()
        right = output.pop() if output else UNSAID
        left = output.pop() if output else right
        if operator == "with":
            output.append((1 + left) / 2)
        else:
            output.append(min(left, right) if operator == "and" else max(left, right))

    for token in _TOKEN.findall(expression):
        word = token.lower()
        if word in _PRECEDENCE:
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[word]:
                reduce()
            operators.append(word)
            is_exception = word == "with"
        elif word == "(":
            operators.append(word)
        elif word == ")":
            while operators and operators[-1] != "(":
                reduce()
            if not operators:
                return names, min(map(freedom, names), default=UNSAID)
            operators.pop()
        else:
            output.append(1.0 if is_exception else freedom(word.rstrip("+")))
            if not is_exception:
                names.append(word)
            is_exception = False
    while operators:
        if operators[-1] == "(":
            return names, min(map(freedom, names), default=UNSAID)
        reduce()
    if len(output) != 1:
        return names, min(map(freedom, names), default=UNSAID)
    return names, output[0]


# Bytes to words: delimiters become spaces, A-Z lower case, bytes of other characters stay.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _automaton(patterns: dict[str, object]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        automaton.add_word(pattern, (pattern, value))
    automaton.make_automaton()
    return automaton


_PHRASES = _automaton({f" {p} ": (p in BASE, label) for p, label in {**NOTICES, **BASE}.items()})
_TAGS = _automaton({TAG: None})


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    raw = (text or "").encode()
    words = raw.translate(_WORDS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    seen = counted = 0
    for end, (pattern, (is_base, label)) in _PHRASES.iter(line):
        labels.add(label)
        if is_base:
            base.add(label)
            start = end - len(pattern) + 1
            # words before the match; ends ascend, so mostly count on from the last one
            if start >= seen:
                counted += line.count(" ", seen, start)
                seen = start
                places.append(counted)
            else:
                places.append(line.count(" ", 0, start))
    values = [freedom(x) for x in labels if x != "licensed"]
    lowered = raw.lower().decode("latin-1")
    if TAG in lowered:
        starts = [end + 1 for end, _ in _TAGS.iter(lowered)]
        # no expression runs over the next tag, so each byte is read once
        for start, after in zip(starts, [*(s - len(TAG) for s in starts[1:]), len(lowered)], strict=True):
            stop = lowered.find("\n", start, after)
            names, value = evaluate(_expression(lowered, start, after if stop < 0 else stop))
            labels.update(names)
            values.append(value)
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        min(values, default=UNSAID),
    )


def _expression(text: str, start: int, stop: int) -> str:
    """The start of ``text[start:stop]`` that reads as an expression: operands joined by
    operators."""
    end, depth, need = start, 0, True
    for match in _TOKEN.finditer(text, start, stop):
        if text[end : match.start()].strip(" \t"):
            break
        token = match[0]
        if token == "(":
            if not need:
                break
            depth += 1
        elif token == ")":
            if depth == 0:
                break
            depth -= 1
        elif token in _PRECEDENCE:
            need = True
        elif need:
            need = False
        else:
            break
        end = match.end()
    return text[start:end]


_FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())


def license_scan(documents: DataFrame) -> DataFrame:
    """``documents(text, ...)`` with the columns of ``scan`` in place of the text."""
    names = set(_FIELDS.names)
    rest = [f for f in documents.schema.fields if f.name not in names and f.name != "text"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column("text")]
            columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), *columns],
                names=[*(f.name for f in rest), *_FIELDS.names],
            )

    return (
        ready(documents)
        .select(*(F.col(f.name) for f in rest), F.col("text"))
        .mapInArrow(scanned, T.StructType([*rest, *_FIELDS.fields]))
    )
