"""The Merkle manifest against trees hashed one run at a time, and its edge rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tidemark.llm import common, merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree string, at long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(hashes):
    """The root, and for each hash its siblings to the left and right, level by level."""
    ways, members = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        runs = [range(i, min(i + 3, len(hashes))) for i in range(0, len(hashes), 3)]
        for run in runs:
            for place in run:
                for m in members[place]:
                    ways[m].append(([hashes[k] for k in run if k < place], [hashes[k] for k in run if k > place]))
        members = [[m for k in run for m in members[k]] for run in runs]
        hashes = [digest(*(hashes[k] for k in run)) for run in runs]
    return hashes[0], ways


def expected(rows):
    sources = {}
    for doc_id, source, lang, n_chars, text in rows:
        chosen = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        other = text.replace("\n", "") if chosen and text is not None else text
        leaf, changed = (digest(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, other))
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, changed))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [grown([leaf for _, _, leaf, _, _ in sorted(sources[s], key=lambda r: r[:3])]) for s in names]
    root, over = grown([top for top, _ in trees])
    found = []
    for name, (subroot, ways), rest in zip(names, trees, over):
        for (_, _, leaf, doc_id, changed), way in zip(sorted(sources[name], key=lambda r: r[:3]), ways):
            folded = changed
            for left, right in way + rest:
                folded = digest(*left, folded, *right)
            proof = digest(*(h for left, right in way + rest for h in left + right))
            found.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def reported(spark, rows):
    frame = spark.createDataFrame([(*r, "x", None, 7) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.tamper_report(frame).collect()), key=repr)


EDGES = [
    (1, "a", "en", 3, "one\ntwo"),
    (2, "a", None, None, None),
    (3, "a", "en", 0, ""),
    (3, "a", "en", 0, ""),
    (3, "a", "en", 0, "another text of this id"),
    (None, "a", "en", 1, "no id\n"),
    (4, None, "en", 1, "no source"),
    (5, "", "en", 1, "\n\n\n"),
    (6, "é", "en", 1, "ünïcödé 漢字\n"),
    (-7, "z", "-", 9, "1:x" * 100_000),
]


def test_edge_rows(spark):
    assert reported(spark, EDGES) == expected(EDGES)
    assert reported(spark, EDGES[6:7]) == expected(EDGES[6:7])  # one row: its leaf is the root
    assert reported(spark, []) == []


@pytest.mark.parametrize("broadcast", [True, False])
def test_deep_trees(spark, monkeypatch, broadcast):
    """A source of over two blocks of leaves, one of an even block, and many of one row."""
    if not broadcast:
        monkeypatch.setattr(merkle, "MOST_BROADCAST", 0)
        joined = common.join_one_each
        monkeypatch.setattr(merkle, "join_one_each", lambda rows, one, key: joined(rows, one, key, most=0))
    rows = [(i * 37 % 1600, "hot", "en", i, f"text {i}\n") for i in range(1600)]
    rows += [(i, "even", "en", i, f"text {i}") for i in range(3**6)]
    rows += [(i, f"s{i}", "en", i, "a\nb") for i in range(30)] + [(5, "hot", "en", 1, "again")] * 40
    assert reported(spark, rows) == expected(rows)


def test_any_change_is_noticed(spark):
    """Proofs hold for the rows as they were and for no others."""
    frame = spark.createDataFrame([(*r, "x", None, 7) for r in EDGES], SCHEMA)
    rows = merkle.manifest(frame, tampered={"lang": merkle.F.lit("xx")})
    again = merkle.folded(merkle.F.col("changed"), merkle.F.col("proof"), merkle.F.col("moves"))
    same = merkle.folded(merkle.F.col("leaf"), merkle.F.col("proof"), merkle.F.col("moves"))
    assert rows.where(again == merkle.F.col("root")).count() == 0
    assert rows.where(same == merkle.F.col("root")).count() == len(EDGES)
