"""SimHash components against all pairs, the split and finer buckets, and edge rows."""

from __future__ import annotations

import os
import random
import re

import duckdb
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def all_pairs(prints, radius=4):
    """The smallest linked name of each of ``(name, fingerprint)``."""
    above = {f: f for _, f in prints}

    def find(f):
        while above[f] != f:
            f = above[f]
        return f

    kinds = sorted(above)
    for i, x in enumerate(kinds):
        for y in kinds[:i]:
            if (x ^ y).bit_count() <= radius:
                above[find(x)] = find(y)
    least = {}
    for name, f in prints:
        least[find(f)] = min(name, least.get(find(f), name))
    return sorted((name, f"{f:016x}", least[find(f)]) for name, f in prints)


def test_query_matches_all_pairs(spark):
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    found = sorted(tuple(r) for r in QUERIES["op13_simhash_neardup"](spark, SF_DIR).collect())
    assert found == all_pairs([(d, plain_fingerprint(t)) for d, t in documents])
    assert any(d != c for d, _, c in found)


def linked_names(spark, prints):
    """``linked`` on fingerprints that are their own names."""
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in set(prints)]
    rows = simhash.linked(spark.createDataFrame(signed, "fp long")).collect()
    groups = {}
    for node, root in rows:
        groups.setdefault(root, set()).add(node % (1 << 64))
    return sorted(sorted(g) for g in groups.values())


def pair_groups(prints):
    groups = {}
    for f, _, c in all_pairs([(f, f) for f in set(prints)]):
        groups.setdefault(c, []).append(f)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def near(base, flips, rng):
    return base ^ sum(1 << bit for bit in rng.sample(range(64), flips))


def test_every_distance_counts_alike(spark):
    """Pairs at 4 bits link, at 5 not, wherever the bits are."""
    rng = random.Random(5)
    bases = [rng.getrandbits(64) for _ in range(300)]
    prints = bases + [near(b, 4 if i % 2 else 5, rng) for i, b in enumerate(bases)]
    found = linked_names(spark, prints)
    assert found == pair_groups(prints) and len(found) >= 150


def test_crowded_buckets(spark, monkeypatch):
    """A group of close fingerprints, one of fingerprints just too far apart, and chains,
    with buckets larger than what is compared in order, split and dealt anew."""
    monkeypatch.setattr(simhash, "NEAR", 2)
    monkeypatch.setattr(simhash, "SAMPLE", 2)
    monkeypatch.setattr(simhash, "PART_ROWS", 20)
    rng = random.Random(7)
    base, other = rng.getrandbits(64), rng.getrandbits(64)
    prints = [near(base, rng.randint(0, 3), rng) for _ in range(150)]
    prints += [near(other, rng.randint(5, 9), rng) for _ in range(250)]
    for _ in range(20):
        chain = [rng.getrandbits(64)]
        for _ in range(8):
            chain.append(near(chain[-1], 4, rng))
        prints += chain
    expected = pair_groups(prints)
    assert linked_names(spark, prints) == expected
    monkeypatch.setattr(simhash, "LEAST_PAIRS", 0)
    monkeypatch.setattr(simhash, "PAIRS_EACH", 0)
    monkeypatch.setattr(simhash, "FEW_BITS", 45)
    assert linked_names(spark, prints) == expected


def test_masks_cover_every_pair():
    rng = random.Random(1)
    for blocks in (1, 2, 3):
        masks = simhash.finer_masks(0, blocks)
        used = rng.choice(masks)
        finer = simhash.finer_masks(used, 2)
        assert all(m & used == used for m in finer)
        for _ in range(500):
            free = [b for b in range(64) if not used >> b & 1]
            flips = near(0, 4, rng)
            assert any(flips & m == 0 for m in masks)
            flips = sum(1 << b for b in rng.sample(free, 4))
            assert any(flips & m == 0 for m in finer)


@pytest.mark.parametrize("slice_bytes", [1, 7, 1 << 20])
def test_fingerprints_of_slices(monkeypatch, slice_bytes):
    monkeypatch.setattr(simhash, "SLICE_BYTES", slice_bytes)
    for text in ("", " \n", "One", "a b c", "a B c d", "x" * 90, "é ß 漢字 Ä\x0bend\x0c\x1c\x85 z", "w1 w2 w3 w4 w5 " * 40):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


SCHEMA = "doc_id long, text string, fp string, root string, component_id string, key string"
LONG = " ".join(f"w{i % 700}x{i}" for i in range(200_000))
ROWS = [(9, None), (8, ""), (7, " \n\t"), (6, "Two words"), (5, "two WORDS"), (4, LONG), (3, LONG + " tail"),
        (2, "again and again the same"), (2, "again and again the same"), (2, "Two words"), (None, "no id")]


def test_edge_rows(spark):
    rows = spark.createDataFrame([(*r, "f", None, "c", "k") for r in ROWS], SCHEMA)
    found = sorted(tuple(r) for r in simhash.similar_components(rows).collect())
    assert found == all_pairs([(d, plain_fingerprint(t)) for d, t in ROWS if d is not None])
    assert {c for d, _, c in found if d in (7, 8, 9)} == {7} and {c for d, _, c in found if d in (5, 6)} == {2}
    assert simhash.similar_components(rows.limit(0)).count() == 0
