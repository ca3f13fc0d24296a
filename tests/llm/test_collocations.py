"""Collocations against counting every phrase, the sort against a dictionary, and edge rows."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import collocations

SCHEMA = "lang string, text string, phrase string, a string, size string, n string"


def plain_counts(rows, longest):
    counts, words = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            found = re.findall(r"[^\x20\x09]+", piece)
            words["und" if lang is None else lang] += len(found)
            for i in range(len(found)):
                for size in range(1, min(longest, len(found) - i) + 1):
                    counts["und" if lang is None else lang, tuple(found[i : i + size])] += 1
    return counts, words


def plain_collocations(rows, longest, least, covered=50, top=2000):
    counts, words = plain_counts(rows, longest)
    candidates = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    around = collections.Counter()
    for (lang, phrase), f in candidates.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                key = lang, phrase[i : i + size]
                around[key] = max(around[key], f)
    scored = collections.defaultdict(list)
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in around and 100 * around[lang, phrase] >= covered * a:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        scored[lang].append((-score, -a, " ".join(phrase).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, words[lang], -score)
        for lang, found in scored.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1)
    )


def reported(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "p", "a", None, "n") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in collocations.collocations(frame, **options).collect())


def random_rows(seed, docs, words, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "the", "The", "漢字", "a" * 90]
    rows = []
    for _ in range(docs):
        text = []
        for _ in range(rng.randint(0, length)):
            text.append(rng.choice(vocabulary[: 1 + int(len(vocabulary) * rng.random() ** 3)]) if rng.random() < 0.7 else "of the")
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", "x y"]), "".join(text)))
    return rows


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_matches_counting(spark, longest):
    rows = random_rows(3, 120, 40, 200)
    expected = plain_collocations(rows, longest, 4, top=50)
    assert len(expected) > 60
    assert reported(spark, rows, longest=longest, least=4, top=50) == expected


def test_rounds_and_hot_pairs(spark, monkeypatch):
    """Small chunks, many routes in several rounds, and pairs that are hot in some chunks."""
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 400)
    monkeypatch.setattr(collocations, "HOT_KEYS", 5)
    monkeypatch.setattr(collocations, "HOT_SHARE", 0.01)
    monkeypatch.setattr(collocations, "FAN_OUT", 2)
    rows = random_rows(4, 120, 60, 200)
    for longest in (3, 4):
        assert reported(spark, rows, longest=longest, least=3) == plain_collocations(rows, longest, 3)


def test_hot_pairs_are_marked():
    words = collocations.Words()
    text = " ".join(f"of the w{i}" for i in range(50)).encode() + b" ".join(b" x%d y%d z" % (i, i) for i in range(50))
    words.add(np.frombuffer(text, np.uint8), np.array([0, len(text)]), [b"en"])
    keys = words.keys(3).summed()
    split = keys.without_hot_pairs(0.01, 10)
    names = [n.decode().split()[1] for n in split.names]
    marked = [names[i - 1] for i in split.table[:2, split.kinds == collocations.PAIR].ravel()]
    assert marked == ["of", "the"] and split.counts[split.kinds == collocations.PAIR].tolist() == [50]
    assert (split.kinds == collocations.BENEATH).sum() == 50
    assert len(set(split.routes(64)[split.kinds == collocations.BENEATH])) > 20
    assert len(set(split.routes(64)[split.kinds == collocations.PAIR])) == 1


@pytest.mark.parametrize("least", [1, 3, 10])
def test_quicksort_counts_prefixes(least):
    rng = np.random.default_rng(2)
    table = rng.integers(1, 9, (4, 3000)).astype(np.int32)
    for depth in range(1, 4):  # a key ends with zeros
        table[depth:, rng.random(3000) < 0.1] = 0
    counts = rng.integers(1, 4, 3000)
    expected = collections.Counter()
    for key, count in zip(table.T.tolist(), counts.tolist()):
        for size in range(1, 5):
            if key[size - 1]:
                expected[tuple(key[:size])] += count
    found = {
        tuple(table[:size, i].tolist()): times
        for size, first, weights in collocations.quicksorted(table, counts, least)
        for i, times in zip(first.tolist(), weights.tolist())
    }
    assert found == {key: f for key, f in expected.items() if f >= least}
    assert not list(collocations.quicksorted(table[:, :0], counts[:0], 1))


def test_parcels_round_trip():
    words = collocations.Words()
    texts = ["one two three. One two", "ünï one two", "", "x" * 500]
    raw = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    words.add(np.frombuffer(raw, np.uint8), offsets, [b"en", b"fr", b"en", b"a b"])
    keys = words.keys(3).summed()
    parts = [collocations._unpacked(names, data) for _, names, data in keys.parcels(keys.routes(5))]
    again = collocations._merged(parts)

    def listed(k):
        rows = zip(k.table.T.tolist(), k.counts.tolist(), k.kinds.tolist())
        return sorted(([k.names[i - 1] if i else b"" for i in key], c, kind) for key, c, kind in rows)

    assert listed(again) == listed(keys)


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(collocations, "_hashed", lambda raw, starts, stops: np.zeros(len(starts), np.uint64))
    words = collocations.Words()
    words.add(np.frombuffer(b"one two one two", np.uint8), np.array([0, 15]), [b"en"])
    assert sorted(words.number) == [b"en one", b"en two"]
    assert sorted(words.keys(2).summed().counts.tolist()) == [1, 2, 2, 2]


def test_edge_rows(spark):
    long = "p q " * 150_000 + "!" + "no end " * 200_000  # a piece longer than what is cut at once
    rows = [("en", None), ("en", ""), ("en", " \t\n .,"), (None, "a b"), ("und", "A B"), ("", "a b"), ("fr", long)]
    rows += [("en", "same row again; same row again")] * 5
    assert reported(spark, rows, least=2) == plain_collocations(rows, 3, 2)
    assert reported(spark, [], least=2) == []


def test_ties_and_exact_scores(spark):
    """Equal scores fall to the count and then to bytes; products pass 64 bits."""
    rows = [("en", "b a, z y, É é") for _ in range(12)] + [("en", "c d") for _ in range(20)]
    found = reported(spark, rows)
    assert [(r[1], r[2], r[7]) for r in found] == [(1, "c d", 1000000), (2, "b a", 1000000), (3, "z y", 1000000), (4, "É é", 1000000)]
    big = 4_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "x", 1, big + 1), ("en", "y", 1, big), ("en", "x y", 2, big)], "lang string, phrase string, size int, f long"
    )
    (row,) = collocations._scored(counts.where("size = 2"), counts).collect()
    assert row.score == 1000000 * big * big // ((big + 1) * big) == 999999
