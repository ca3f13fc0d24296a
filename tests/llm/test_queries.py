"""The registered queries against SQL and against brute force on the given tables."""

from __future__ import annotations

import collections
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import token_counts
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sets_of(documents):
    found = {}
    for doc_id, text in documents:
        words = WORD.findall(lower(text))
        n = min(5, len(words))
        found[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    return found


def linked_components(sets):
    """Smallest linked doc_id of each, by comparing all pairs."""
    above = {d: d for d in sets}

    def find(d):
        while above[d] != d:
            d = above[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 75 * (len(x) + len(y) - shared):
                    p, q = find(a), find(b)
                    above[max(p, q)] = min(p, q)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    listed = ", ".join(columns)
    assert ours == sorted(map(repr, duck.execute(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall()))


def test_components_match_all_pairs(spark, documents):
    sets = sets_of(documents)
    expected = {d: (len(sets[d]), c) for d, c in linked_components(sets).items()}
    rows = QUERIES["op2_ngram_jaccard"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


def test_leaks_match_all_windows(spark, duck, documents):
    def words(text):
        return re.sub(r"[\W_]+", " ", text.lower()).split()

    def bag(ws):
        return collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))

    items = {i: words(t) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()}
    expected = set()
    for doc_id, text in documents:
        ws = words(text)
        grams = set(bag(ws))
        for item_id, item in items.items():
            own = bag(item)
            if len(item) >= 5 and grams & set(own):
                for start in range(max(1, len(ws) - 4)):
                    window = bag(ws[start : start + len(item)])
                    shared = sum((window & own).values())
                    if shared >= 0.75 * sum((window | own).values()):
                        expected.add((doc_id, item_id))
    rows = QUERIES["op1_decontamination"](spark, SF_DIR).collect()
    assert expected and {(r.doc_id, r.item_id) for r in rows} == expected


def test_base_secrets_match_patterns(spark, documents):
    rules = {
        "assign": re.compile(
            r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        "access": re.compile(r"AKIA[A-Z0-9]+"),
        "hex": re.compile(r"[0-9a-f]+"),
    }
    least = {"assign": 12, "access": 18, "hex": 16}
    rows = {r.doc_id: r for r in QUERIES["op7_secret_scan"](spark, SF_DIR).collect()}
    for doc_id, text in documents:
        spans = []
        for place, (kind, rule) in enumerate(rules.items()):
            for m in rule.finditer(text):
                if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                    spans.append((m.start(), place, m.end(), kind))
        listed = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        row = rows[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) | {""}
        assert row.n_hex == sum(k == "hex" for *_, k in spans)


def test_base_licences_match_word_search(spark, documents):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    rows = {r.doc_id: r for r in QUERIES["op5_license_scan"](spark, SF_DIR).collect()}
    seen = 0
    for doc_id, text in documents:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places, labels = [], set()
        for phrase, label in phrases.items():
            parts = phrase.split()
            for i in range(len(words) - len(parts) + 1):
                if words[i : i + len(parts)] == parts:
                    places.append(i)
                    labels.add(label)
        row = rows[doc_id]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted(labels))
        assert labels <= set(row.labels.split(",")) | {""} and 0 <= row.score <= 1
        seen += len(places)
    assert seen


def test_token_counts_match_each_word_alone(spark, documents):
    scores = token_counts.unigram_scores()
    rows = {r.doc_id: r for r in QUERIES["op9_token_counts"](spark, SF_DIR).collect()}
    longest = max(map(len, scores))

    def pieces(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            width = len(word[end - 1].encode())
            ways = [(best[end - 1][0] + width * scores[""], -(-best[end - 1][1] + width))]
            for start in range(max(0, end - longest), end):
                if word[start:end] in scores:
                    ways.append((best[start][0] + scores[word[start:end]], best[start][1] - 1))
            best.append(max(ways))
        return -best[-1][1]

    for doc_id, text in documents[:40]:
        words = WORD.findall(text)
        assert rows[doc_id].n_words == len(words)
        assert rows[doc_id].n_tokens == sum(pieces("▁" + w) for w in words)


def test_neighbours_recall(spark, duck):
    vectors = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall()
    ids = np.array([v[0] for v in vectors])
    x = np.array([v[1] for v in vectors], dtype=np.float32).astype(float)
    found = collections.defaultdict(list)
    for r in QUERIES["op6_nearest"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        ours = found[int(ids[i])]
        assert len(ours) == 20 and sorted(ours, key=lambda v: (-v[1], v[0])) == ours
        hits += len(best & {v for v, _ in ours})
        total += 20
    assert hits >= 0.9 * total


def test_quality_on_held_out_documents(spark, duck):
    truth = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op8_quality"](spark, SF_DIR).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.85
    good = [r.predicted for r in held if truth[r.doc_id] == 1]
    assert np.mean(good) >= 0.95


def test_pipeline_stages(spark, duck, documents):
    """Each stage against the operators' rules, on what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns[: len(columns)] == columns
        if name != "mixing":
            assert docs.columns == columns
        docs = docs.cache()
        kept[name] = {r.doc_id: r for r in docs.collect()}
    predicted = {r.doc_id: r.predicted for r in QUERIES["op8_quality"](spark, SF_DIR).collect()}
    assert set(kept["quality"]) == {d for d, p in predicted.items() if p}
    components = linked_components(sets_of([(d, r.text) for d, r in kept["quality"].items()]))
    assert set(kept["near_duplicates"]) == set(components.values())
    leaking = {r.doc_id for r in QUERIES["op1_decontamination"](spark, SF_DIR).collect()}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaking
    assert set(kept["secrets"]) == set(kept["decontamination"])
    for doc_id, row in kept["secrets"].items():
        before = kept["decontamination"][doc_id].text
        assert not re.search("[0-9a-f]{16}", row.text) and row.n_chars == len(row.text)
        assert row.text == before or "[SECRET]" in row.text
    sizes = {d: len(WORD.findall(r.text)) for d, r in kept["secrets"].items()}
    assert all(0 < r.taken <= 2 * sizes[d] for d, r in kept["mixing"].items())
