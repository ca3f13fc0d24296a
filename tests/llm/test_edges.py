"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import collections
import os
import random
import time

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    components,
    decontaminate,
    licenses,
    mixing,
    neighbours,
    ngram_join,
    quality,
    secrets,
    settrie,
    token_counts,
    warc,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = " ".join(f"w{i % 700}x{i}" for i in range(30_000))
ITEM = "one two three four five six seven eight nine ten eleven twelve"
# score, size, found_hex, n_words: names the operators use themselves
SCHEMA = "doc_id long, text string, source string, score string, size string, n_words string, block string"
ROWS = [
    (1, None, None, "s", "z", "n", "b"),
    (2, "", "a", "s", "z", "n", "b"),
    (3, " \n\t ", "a", "s", "z", "n", "b"),
    (4, "Two words", "a", "s", "z", "n", "b"),
    (5, "two WORDS", "b", "s", "z", "n", "b"),
    (6, LONG, "b", None, None, None, None),
    (7, LONG + " tail", "b", "s", "z", "n", "b"),
    (8, f"Before. {ITEM.upper()}! after it token = \"0123456789abcdef0123\" end", "c", "s", "z", "n", "b"),
    (8, f"Before. {ITEM.upper()}! after it token = \"0123456789abcdef0123\" end", "c", "s", "z", "n", "b"),
    (None, "no id here at all but words", "c", "s", "z", "n", "b"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (None, ITEM)], "item_id long, text string")


def test_components_of_edge_rows(rows, none):
    found = sorted(tuple(r) for r in ngram_join.similar_components(rows).collect())
    n = 30_000 - 4
    assert [f[0] for f in found] == [1, 2, 3, 4, 5, 6, 7, 8, 8]
    assert [f[1] for f in found[:7]] == [0, 0, 0, 1, 1, n, n + 1]
    assert [f[2] for f in found] == [1, 2, 3, 4, 4, 6, 6, 8, 8]
    assert ngram_join.similar_components(none).count() == 0


def test_representatives_keep_other_columns(rows):
    kept = ngram_join.representatives(rows)
    assert kept.columns == rows.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == [1, 2, 3, 4, 6, 8, 8, None]


def test_leaks_of_edge_rows(rows, none, items):
    found = decontaminate.leaks(rows, items).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in found] == [(8, 1, 1.0)]
    kept = decontaminate.clean(rows, items)
    assert kept.columns == rows.columns and kept.count() == 8
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(rows, items.limit(0)).count() == 0


def test_edited_leak_is_verified(spark, items):
    words = [f"x{i}" for i in range(20)] + ITEM.split() + [f"y{i}" for i in range(20)]
    words[31] = "changed"  # the last word of the item: 7 of 9 shingles shared
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = decontaminate.leaks(docs, items).collect()
    assert row.similarity == pytest.approx(7 / 9)


def test_leaks_of_repeated_items(spark):
    """A repeated row of an item, two texts under one id, and one text under two ids."""
    other = " ".join(f"o{i}" for i in range(12))
    third = " ".join(f"t{i}" for i in range(15))
    rows = [(1, ITEM), (1, ITEM.upper()), (1, ITEM), (2, other), (2, third), (2, third), (3, other)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    docs = [(1, f"x {ITEM} y"), (2, f"x {other} y"), (3, f"x {third} y"), (4, "x y z " * 9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.similarity, r.n_windows) for r in decontaminate.leaks(frame, benchmark).collect())
    assert found == [(1, 1, 1.0, 1), (2, 2, 1.0, 1), (2, 3, 1.0, 1), (3, 2, 1.0, 1)]
    assert [r.doc_id for r in decontaminate.clean(frame, benchmark).collect()] == [4]


def test_no_leak_at_the_threshold_is_missed(spark):
    """One changed word takes 5 of an item's 35 shingles: similarity 30 / 40 in its place,
    more in a window beside it where the change is near an end."""
    items, docs = [], []
    for i in range(300):
        words = [f"i{i}w{j}" for j in range(39)]
        items.append((i, " ".join(words)))
        words[4 + i % 31] = "changed"
        docs.append((i, " ".join(["before", "it", *words, "after", "it"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    expected = {}
    for i in range(300):
        expected |= plain_leaks([docs[i]], [items[i]])
    assert len(expected) == 300 and min(expected.values()) == 0.75
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(expected)


def bag(ws):
    return collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))


def plain_leaks(docs, items):
    """By trying every window of every document."""
    found = {}
    for doc_id, text in docs:
        ws = text.split()
        for item_id, item_text in items:
            item = item_text.split()
            own, best = bag(item), 0.0
            for start in range(5 - len(item), max(1, len(ws) - 4)):
                window = bag(ws[max(start, 0) : start + len(item)])
                if window:
                    best = max(best, sum((window & own).values()) / sum((window | own).values()))
            if best >= 0.75:
                found[doc_id, item_id] = best
    return found


def test_unaligned_leaks(spark):
    """Leaks with words put in, and with the item's beginning or end cut off by the text's."""
    p, a, b, s = ([f"{c}{i}" for i in range(n)] for c, n in (("p", 4), ("a", 40), ("b", 40), ("s", 4)))
    other = [f"o{i}" for i in range(44)]
    items = [(1, " ".join(p + a + b + s)), (2, " ".join(other))]
    docs = [
        (1, " ".join(["x"] * 30 + a + [f"x{i}" for i in range(8)] + b + ["y"] * 30)),
        (2, " ".join(["z"] * 20 + other[8:])),
        (3, " ".join(other[:36] + ["z"] * 20)),
        (4, " ".join(["z"] * 20 + other[14:] + ["z"] * 20)),
    ]
    expected = plain_leaks(docs, items)
    assert set(expected) == {(1, 1), (2, 2), (3, 2)}
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    rows = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    assert rows == pytest.approx(expected)


def test_random_edits_against_every_window(spark):
    """Items with repeated phrases, copied with words changed, put in, dropped and moved."""
    chance = random.Random(3)
    items, docs = [], []
    for i in range(25):
        phrase = [f"i{i}w{chance.randrange(12)}" for _ in range(chance.randint(8, 30))]
        item = phrase + (phrase if i % 3 == 0 else [f"i{i}t{j}" for j in range(20)])
        items.append((i, " ".join(item)))
        for k in range(6):
            copy = list(item)
            for _ in range(chance.randint(0, 3)):
                at = chance.randrange(len(copy))
                copy[at : at + chance.randint(0, 2)] = [f"e{chance.randrange(10**9)}"] * chance.randint(0, 2)
            before, after = (["b"] * chance.choice([0, 0, 9]) for _ in range(2))
            docs.append((10 * i + k, " ".join(before + copy + after)))
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == set(plain_leaks(docs, items))


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    """The block join against all pairs of fingerprints."""
    rows = [(f"w{i}", 40, f"t{i % 30}x{j if (i * j) % 7 else 0}", 1) for i in range(90) for j in range(30)]
    windows = spark.createDataFrame(
        [(n, s, int.from_bytes(n.encode() + h.encode(), "little") * 0x9E3779B97F4A7C15 % (1 << 63), t) for n, s, h, t in rows],
        "content string, size int, h long, times long",
    )
    items = windows.withColumnRenamed("content", "item")
    prints = {r.content: r.fp for r in decontaminate._fingerprints(windows, "content").collect()}
    expected = {(x, y) for x in prints for y in prints if ((prints[x] ^ prints[y]) & (1 << 64) - 1).bit_count() <= 15}
    found = {tuple(r) for r in decontaminate._candidates(windows, items).collect()}
    assert found == expected and len(found) > 90


def test_mix_of_rows_without_ids_and_repeated_rows(spark):
    """The words taken are within a document of the target, and the SQL cuts alike."""
    rows = [(None, f"a{i} b c d e f g", "nulls") for i in range(700)]
    rows += [(7, "the same row again and again", "same")] * 500 + [(i, "w " * (i % 40), "plain") for i in range(600)]
    rows += [(5, f"text {i} of one id", "one id") for i in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_sizes(documents)
    for r in found.groupBy("target").agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).collect():
        assert abs(r.taken - r.target) <= r.size
    assert found.where("taken > 2 * size").count() == 0
    assert mixing.mix(documents).groupBy("source").agg(F.sum("taken")).orderBy("source").collect() == (
        mixing.mix(documents.repartition(3)).groupBy("source").agg(F.sum("taken")).orderBy("source").collect()
    )
    duck = duckdb.connect()
    duck.register("documents", documents.toArrow())
    columns = "doc_id, size, source_size, target, taken"
    ours = sorted(map(repr, (tuple(r) for r in found.select(*columns.split(", ")).collect())))
    assert ours == sorted(map(repr, duck.execute(f"SELECT {columns} FROM ({mixing.SQL})").fetchall()))


def test_mix_by_a_given_quality(spark):
    rows = [(i, f"d{i} one two three four", "s", 0.9 if i % 2 else 0.1) for i in range(400)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, q double"), F.col("q"))
    taken = {r.q: r.n for r in out.groupBy("q").agg(F.sum("taken").alias("n")).collect()}
    assert taken[0.9] > 1.3 * taken[0.1]


def test_secrets_of_a_text_of_many(spark):
    """Time and result for 20,000 candidates in one text, and for one candidate of a megabyte."""
    chance = random.Random(4)
    many = " ".join("".join(chance.choice("0123456789abcdef") for _ in range(20)) for _ in range(20_000))
    one = "".join(chance.choice("0123456789abcdefXYZ") for _ in range(1_000_000))
    rows = spark.createDataFrame([(1, many), (2, one)], "doc_id long, text string")
    began = time.monotonic()
    found = {r.doc_id: r for r in secrets.secret_scan(rows).collect()}
    masked = {r.doc_id: r.text for r in secrets.redact(rows).collect()}
    assert time.monotonic() - began < 60
    assert found[1].n_hex == 20_000 and found[1].spans.endswith(f"hex:{21 * 19_999}:{21 * 20_000 - 1},markov:{21 * 19_999}:{21 * 20_000 - 1}")
    assert masked[1] == " ".join([secrets.MASK] * 20_000)
    assert "markov:0:1000000" in found[2].spans and masked[2] == secrets.MASK


def test_leak_of_a_long_item(spark):
    text = " ".join(f"long{i}" for i in range(70_000))
    benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a b {text} c"), (2, "a b c d e f")], "doc_id long, text string")
    found = decontaminate.leaks(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in found] == [(1, 1, 1.0)]


def test_secrets_of_edge_rows(rows, none):
    found = {(r.doc_id, r.spans) for r in secrets.secret_scan(rows).collect()}
    assert (1, "") in found and (2, "") in found
    text = ROWS[7][1]
    start, digits = text.index("token"), text.index("0123")
    assert any(f"assign:{start}:{digits + 20},hex:{digits}:{digits + 20}" in s for d, s in found if d == 8)
    masked = secrets.redact(rows)
    assert masked.columns == rows.columns and masked.count() == len(ROWS)
    assert masked.where("text LIKE '%[SECRET]%' AND text NOT LIKE '%0123456789abcdef%'").count() == 2
    assert secrets.secret_scan(none).count() == 0


def test_markov_tells_random_from_ordinary(spark):
    """Trained on most documents, tested on long words of the others and on fresh digests."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = secrets.train(documents.where("doc_id % 5 <> 0"))
    words = documents.where("doc_id % 5 = 0").select(
        F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{12,}"), F.lit(0))).alias("token")
    )
    digests = spark.range(500).select(F.base64(F.unhex(F.sha2(F.concat(F.lit("new"), "id"), 224))).alias("token"))
    is_random = secrets.log_ratio(F.col("token"), model) > secrets.LEAST_RATIO
    assert words.agg(F.avg(is_random.cast("int"))).first()[0] < 0.01
    assert digests.agg(F.avg(is_random.cast("int"))).first()[0] > 0.95


def test_licences_of_edge_rows(rows, none):
    out = licenses.license_scan(rows)
    assert "score" in out.columns and out.columns.count("n_words") == 1
    assert out.where("doc_id = 1").first()["n_words"] == 0
    assert out.count() == len(ROWS) and licenses.license_scan(none).count() == 0


def test_licence_expressions():
    assert licenses.evaluate("MIT") == (["mit"], 0.95)
    assert licenses.evaluate("MIT OR GPL-3.0")[1] == 0.95
    assert licenses.evaluate("MIT AND GPL-3.0")[1] == 0.3
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0")[1] == pytest.approx(0.65)
    assert licenses.evaluate("(MIT OR Apache-2.0) AND GPL-3.0 OR CC0-1.0")[1] == 1.0
    assert licenses.evaluate("(MIT AND") == (["mit"], 0.95)
    text = "x\nSPDX-License-Identifier: (MIT OR GPL-2.0-only)\nall rights reserved all rights reserved"
    found = licenses.scan(text)
    assert found[1:4] == (2, 10, 13) and found[5] == "gpl-2.0-only,mit,reserved" and found[6] == 0.0


def test_long_licence_expressions_are_read_whole():
    names = [f"mit-{i:04d}" for i in range(1000)]
    text = f"spdx-license-identifier: {' AND '.join(names)} AND GPL-3.0\nAND AGPL-3.0 is another line"
    found = licenses.scan(text)
    assert found[5].split(",") == ["gpl-3.0", *names] and found[6] == 0.3
    wide = licenses.scan("SPDX-License-Identifier:" + " " * 3000 + "GPL-3.0")
    assert wide[5] == "gpl-3.0" and wide[6] == 0.3
    both = licenses.scan("SPDX-License-Identifier: MIT OR SPDX-License-Identifier: GPL-3.0")
    assert both[5] == "gpl-3.0,mit" and both[6] == 0.3
    many = licenses.scan("SPDX-License-Identifier: MIT OR " * 30_000)
    assert many[5] == "mit" and many[6] == 0.95


def test_quality_of_edge_rows(spark, rows, none):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.with_quality(rows, labels)
    found = out.collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert all(r.score == 0.5 for r in quality.with_quality(rows, labels.limit(0)).collect())
    assert quality.with_quality(none, labels).count() == 0


def test_marginals_match_all_paths():
    generator = np.random.default_rng(3)
    good, change = generator.normal(size=(2, 4)), generator.normal(size=(2, 2))
    found, changes = quality.marginals(good, np.array([4, 3]), change)
    total = np.zeros((2, 2))
    for chain, n in enumerate((4, 3)):
        paths = [tuple(int(b) for b in np.binary_repr(i, n)) for i in range(2**n)]
        weights = np.array(
            [
                np.exp(
                    sum(good[chain, t] * s for t, s in enumerate(p))
                    + sum(change[a, b] for a, b in zip(p, p[1:], strict=False))
                )
                for p in paths
            ]
        )
        weights /= weights.sum()
        for t in range(n):
            assert found[chain, t] == pytest.approx(sum(w for w, p in zip(weights, paths, strict=True) if p[t]))
        for w, p in zip(weights, paths, strict=True):
            for a, b in zip(p, p[1:], strict=False):
                total[a, b] += w
    assert changes == pytest.approx(total)


def test_tokens_of_edge_rows(rows, none):
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(rows).collect()}
    assert found[1] == found[2] == found[3] == 0 and found[4] > 0
    assert token_counts.token_counts(none).count() == 0


def test_mix_of_edge_rows(rows, none):
    out = mixing.mix(rows)
    found = out.collect()
    assert len(found) == len(ROWS) and out.columns.count("size") == 1
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    assert [r.taken for r in found if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert sorted(map(repr, mixing.mixed_sizes(rows).collect())) == sorted(map(repr, mixing.mixed_sizes(rows).collect()))
    assert mixing.mix(none).count() == 0


@given(st.text(alphabet="<|\\im_startend>\nok ", max_size=40), st.text(alphabet="a\n\\<|", max_size=5))
def test_any_turn_reads_back(text, role):
    rendered = chat.render_turn(role, text)
    assert [t[:2] for t in chat.parse(rendered * 2)] == [(role, text)] * 2


def test_chat_of_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    turns = [(1, 0, "user", None, "x"), (1, 0, None, "b", "x"), (None, None, "assistant", chat.CONFLICT, "x")]
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(turns, schema))).collect()}
    assert found[1].n_turns == 2 and found[1].loss_chars == 0
    assert found[None].loss_chars == len(chat.CONFLICT)
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).count() == 0


def test_archives_of_edge_rows(spark):
    big = "é" * 600
    pages = [(1, "u", big), (2, "u\r\nv", big), (2, "u", big), (3, None, None), (None, "u", big), (4, "u", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = warc.round_trip(frame).collect()
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to or 0) for r in found)
    assert kinds == [
        (0, "revisit", 2),
        (1, "revisit", 2),
        (2, "response", 0),
        (2, "response", 0),
        (3, "response", 0),
        (4, "response", 0),
    ]
    assert {r.payload_bytes for r in found if r.page_id in (1, 2)} == {1200}
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_damaged_records_are_refused():
    good = warc.record(1, "u", b"abc", None)
    assert warc.parse_record(good)[1:] == (3, b"abc")
    for bad in (good[:-1], good.replace(b"abc", b"abd"), good.replace(b"WARC-Date", b"WARC-Dato"), good + b"x"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_neighbours_of_edge_rows(spark):
    vectors = [
        (0, [1.0, 0.0]),
        (1, [1.0, 0.0]),
        (2, [1.0, 0.0]),
        (3, [0.0, 0.0]),
        (4, None),
        (5, [float("nan"), 1.0]),
        (6, [None, 1.0]),
        (7, [1.0]),
        (8, [0.5, 0.5]),
        (None, [1.0, 1.0]),
    ]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = neighbours.nearest(frame, frame.where("vec_id = 0"), 20).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(1, 1, 1.0), (2, 2, 1.0), (3, 8, 0.5)]
    assert neighbours.nearest(frame.limit(0), frame.limit(0), 20).count() == 0


@pytest.mark.parametrize("seeds", [4096, 25])
def test_neighbours_of_repeated_ids(spark, monkeypatch, seeds):
    """Ids with equal and with unlike vectors, all of them seeds and most of them not."""
    monkeypatch.setattr(neighbours, "SEEDS", seeds)
    monkeypatch.setattr(neighbours, "PROBED", 1.0)
    generator = np.random.default_rng(17)
    rows = [(i, generator.normal(size=4).round(3).tolist()) for i in range(1, 60)]
    equal = [(100 + i, [4.0 + i, 1.0, 0.0, 0.0]) for i in range(5) for _ in range(3)]
    unlike = [(200 + i, [3.0 - j, float(i), 0.0, 0.0]) for i in range(5) for j in range(3)]
    query = (0, [1.0, 0.25, 0.0, 0.0])
    frame = spark.createDataFrame([query, *rows, *equal, *unlike], "vec_id long, embedding array<float>")
    found = neighbours.nearest(frame, frame.where("vec_id = 0"), 24).orderBy("rank").collect()
    candidates = [*rows, *equal, *unlike]
    scores = [(float(np.dot(np.float32(v).astype(float), query[1])), i) for i, v in candidates]
    best = sorted(scores, key=lambda s: (-s[0], s[1]))[:24]
    assert [r.rank for r in found] == list(range(1, 25))
    assert [r.score for r in found] == pytest.approx([s for s, _ in best])
    assert sorted(r.vec_id for r in found) == sorted(i for _, i in best)


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(500, 500)], "a long, b long"))
    found = components.connected_components(edges).collect()
    assert {r.root for r in found} == {0} and len(found) == 201


def test_trie_finds_what_pairs_find():
    generator = np.random.default_rng(5)
    base = generator.permutation(60)[:40]
    sets = []
    for _ in range(60):
        keep = base[generator.random(40) > generator.random() * 0.3]
        sets.append(np.unique(np.concatenate([keep, generator.integers(0, 60, 3)])))
    sizes = np.array([len(s) for s in sets])
    trie = settrie.SetTrie(list(range(60)), sets, sizes, 60)
    for k, tokens in enumerate(sets):
        expected = set()
        for m, other in enumerate(sets):
            shared = len(np.intersect1d(tokens, other))
            if 100 * shared >= 75 * (len(tokens) + len(other) - shared):
                expected.add(m)
        assert set(trie.probe(tokens, len(tokens))) == expected


def test_hot_copies_and_near_copies(spark):
    """A third of all rows are near copies of one text, another part exact copies."""
    words = LONG.split()[:200]
    near = [(i, " ".join(words[: i % 190] + [f"edit{i}"] + words[i % 190 + 1 :])) for i in range(900)]
    same = [(1000 + i, " ".join(reversed(words))) for i in range(300)]
    other = [(2000 + i, " ".join(f"u{i}x{j}" for j in range(40))) for i in range(300)]
    frame = spark.createDataFrame(near + same + other, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similar_components(frame).collect()}
    assert {found[d] for d, _ in near} == {0} and {found[d] for d, _ in same} == {1000}
    assert all(found[d] == d for d, _ in other)


def test_shingles_hot_in_one_chunk_only(spark, monkeypatch):
    """150 groups of near copies, each in a chunk of its own, and a passage all rows have:
    only its six shingles come to the driver."""
    sent, dealt = [], ngram_join._dealt
    monkeypatch.setattr(ngram_join, "_dealt", lambda hot, *rest: sent.append(len(hot)) or dealt(hot, *rest))
    words = "transform(sequence(1, 60), j -> concat('g', id div 20, 'w', j))"
    passage = " ".join(f"c{j}" for j in range(10))
    frame = spark.range(0, 3000, 1, 150).selectExpr(
        "id AS doc_id", f"concat_ws(' ', '{passage}', array_join({words}, ' '), concat('last', id)) AS text"
    )
    found = {r.doc_id: r.component_id for r in ngram_join.similar_components(frame).collect()}
    assert found == {d: d - d % 20 for d in range(3000)}
    assert set(sent) == {6}
