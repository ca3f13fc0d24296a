"""Phrase collocations: phrases that occur more often than their parts make likely.

A suffix pointer is a place in a piece of text; its key is the words from there on, up to
the longest phrase. Sorting the pointers brings the occurrences of every phrase together.

1. A task cuts its texts into words, numbers the distinct ones, and sums equal keys.
2. Keys are routed to tasks by their two leading words. A pair of words that begins a large
   part of a task's distinct keys is hot there: its keys are routed by all their words, and
   its count goes to the pair's own route, with a mark. In rounds of ``FAN_OUT`` routes,
   so the parts a task sends stay large however many routes there are.
3. A route's pointers are sorted by multikey three-way quicksort: a partition is split by a
   pivot into those whose next word is smaller, equal or larger, and only the equal part
   goes on to the word after. Its size is the count of the phrase so far. A partition of
   fewer occurrences than a phrase needs is abandoned. All partitions of a route are
   split at once, in array operations. Sizes below a marked pair are parts of the whole,
   summed afterwards.
4. Phrases of enough occurrences are scored by joins with the counts of their parts, which
   have no fewer. Products are decimals of 38 digits: exact while 10**6 * a * a is below
   10**38, for counts up to 10**16.

Only bytes A-Z are lowered; the end of a text is the end of a piece. Words are numbered by
64-bit hashes whose texts are compared, so no two words are taken for one.

Defined results: NULL, empty and blank texts have no words; NULL lang is ``und``. A repeated
row counts again, and rows need no id. A lang without candidates has no rows; an empty table
gives none. Ties in score and count fall to the phrase's UTF-8 bytes. Other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, join_one_each, kept, ready
from tidemark.llm.shingles import mix

LONGEST = 3
LEAST = 10
#: A phrase goes if a longer candidate around it has so many percent of its occurrences.
COVERED = 50
TOP = 2000
NO_LANG = "und"
#: Words of a chunk, and bytes of text cut at once.
CHUNK_WORDS, SLICE_BYTES = 4_000_000, 1 << 20
#: Input bytes a route, and routes of one round.
ROUTE_BYTES, FAN_OUT = 8 << 20, 256
#: A pair of words that begins more than this share of a chunk's keys is hot there.
HOT_SHARE, HOT_KEYS = 1 / 512, 1000
#: Groups in which each lang's rows are limited before they are ranked.
RANK_GROUPS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), np.frombuffer(b"\x20\x09", np.uint8))
_STOP = np.isin(np.arange(256), np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: What a key stands for: an occurrence of each of its leading phrases; the same, beneath a
#: pair that is counted elsewhere; a marked pair; a word.
PLAIN, BENEATH, PAIR, WORD = range(4)

_PARCEL = "route long, names binary, data binary"
_COUNT = "lang string, phrase string, size int, f long, whole boolean"


def _hashed(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    steps = np.cumprod(np.full(int(sizes.max()), _STEP, dtype=np.uint64))
    letters = raw[np.repeat(starts, sizes) + at].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(mix(letters * steps[at]), first) + sizes.astype(np.uint64))


class Words:
    """Numbers for the distinct (lang, word) of a chunk, and the pieces they occur in."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.held = 0
        self._piece = 0

    def add(self, raw: np.ndarray, offsets: np.ndarray, langs: list[bytes]) -> None:
        """Texts ``raw[offsets[i]:offsets[i + 1]]`` in ``langs[i]``."""
        raw = _LOWER[raw]
        stop, edge = _STOP[raw], np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        solid = ~(stop | _BLANK[raw])
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        ends[:-1] &= ~solid[1:] | edge[1:-1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if not len(starts):
            return
        breaks = np.cumsum(stop | edge[:-1])
        text_of = np.searchsorted(offsets, starts, side="right") - 1
        hashes = _hashed(raw, starts, stops)
        codes = {lang: code for code, lang in enumerate(sorted(set(langs)))}
        lang_of = np.array([codes[lang] for lang in langs])[text_of]
        _, first, inverse = np.unique(
            mix(hashes ^ (lang_of.astype(np.uint64) << np.uint64(32))), return_index=True, return_inverse=True
        )
        text = raw.tobytes()
        if not self._alike(raw, starts, stops, lang_of, first[inverse]):
            first = inverse = np.arange(len(starts))  # two words of one hash: each by itself
        names = [langs[text_of[i]] + b" " + text[starts[i] : stops[i]] for i in first.tolist()]
        known = self.number
        found = np.array([known.setdefault(name, len(known)) for name in names], dtype=np.int32)
        self.ids.append(found[inverse])
        self.pieces.append(self._piece + breaks[starts])
        self._piece += int(breaks[-1]) + 1
        self.held += len(starts)

    @staticmethod
    def _alike(raw, starts, stops, lang_of, same) -> bool:
        """Whether each word is that at place ``same``."""
        sizes = stops - starts
        if (sizes != sizes[same]).any() or (lang_of != lang_of[same]).any():
            return False
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return bool((raw[np.repeat(starts, sizes) + at] == raw[np.repeat(starts[same], sizes) + at]).all())

    def keys(self, longest: int) -> Keys:
        ids, pieces = np.concatenate(self.ids), np.concatenate(self.pieces)
        table = np.zeros((longest, len(ids)), dtype=np.int32)  # 0 is the end of a piece
        table[0] = ids + 1
        for ahead in range(1, longest):
            inside = pieces[ahead:] == pieces[:-ahead]
            table[ahead, :-ahead][inside] = ids[ahead:][inside] + 1
        times = np.bincount(ids, minlength=len(self.number))
        words = np.zeros((longest, len(times)), dtype=np.int32)
        words[0] = np.arange(1, len(times) + 1)
        table = table[:, table[1] > 0] if longest > 1 else table[:, :0]
        kinds = np.repeat(np.array([PLAIN, WORD], dtype=np.int8), [table.shape[1], len(times)])
        counts = np.concatenate((np.ones(table.shape[1], dtype=np.int64), times))
        return Keys(list(self.number), np.concatenate((table, words), axis=1), counts, kinds)


class Keys:
    """Keys as columns of word numbers, from 1, with their occurrences and kinds."""

    def __init__(self, names: list[bytes], table: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> None:
        self.names, self.table, self.counts, self.kinds = names, table, counts, kinds

    def summed(self) -> Keys:
        """Equal keys of one kind are one."""
        base = len(self.names) + 1
        if 4 * base ** len(self.table) < 1 << 63:
            code = self.kinds.astype(np.int64)
            for column in self.table:
                code = code * base + column
            order = np.argsort(code)
        else:
            order = np.lexsort([*self.table[::-1], self.kinds])
        table, kinds = self.table[:, order], self.kinds[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (table[:, 1:] != table[:, :-1]).any(axis=0) | (kinds[1:] != kinds[:-1])
        first = np.flatnonzero(new)
        counts = np.add.reduceat(self.counts[order], first) if len(first) else self.counts[:0]
        return Keys(self.names, table[:, first], counts, kinds[first])

    def without_hot_pairs(self, share: float, least: int) -> Keys:
        """With the keys of hot pairs routed by all their words. For summed keys."""
        plain = np.flatnonzero(self.kinds == PLAIN)
        if len(self.table) < 3 or not len(plain):
            return self
        pairs = self.table[:2, plain]
        first = np.flatnonzero(np.concatenate(([True], (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))))
        sizes = np.diff(first, append=len(plain))
        hot = sizes > max(least, share * len(plain))
        if not hot.any():
            return self
        kinds = self.kinds.copy()
        kinds[plain[np.repeat(hot, sizes)]] = BENEATH
        marks = np.zeros((len(self.table), int(hot.sum())), dtype=np.int32)
        marks[:2] = pairs[:, first[hot]]
        totals = np.add.reduceat(self.counts[plain], first)[hot]
        return Keys(
            self.names,
            np.concatenate((self.table, marks), axis=1),
            np.concatenate((self.counts, totals)),
            np.concatenate((kinds, np.full(len(totals), PAIR, dtype=np.int8))),
        )

    def routes(self, among: int) -> np.ndarray:
        """By leading words: a word's own, a pair's, or for hot pairs the whole key's."""
        names = [xxhash.xxh64_intdigest(name) for name in self.names]
        hashes = np.array([0, *names], dtype=np.uint64)
        leading = np.select([self.kinds == WORD, self.kinds == BENEATH], [1, len(self.table)], 2)
        route = np.zeros(len(self.counts), dtype=np.uint64)
        for depth, column in enumerate(self.table):
            route = np.where(depth < leading, mix(route * _STEP + hashes[column]), route)
        return (route % np.uint64(among)).astype(np.int64)

    def parcels(self, routes: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        order = np.argsort(routes, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(routes[order])) + 1):
            if len(part):
                yield int(routes[part[0]]), *self._packed(part)

    def _packed(self, part: np.ndarray) -> tuple[bytes, bytes]:
        used, table = np.unique(self.table[:, part], return_inverse=True)
        if len(used) and used[0] != 0:
            used, table = np.concatenate(([0], used)), table + 1
        names = [self.names[i - 1] for i in used[1:].tolist()]
        sizes = np.array([len(n) for n in names], dtype="<u4")
        numbers = np.concatenate((table.reshape(len(self.table), -1).astype("<u4").ravel(), sizes))
        counts = self.counts[part].astype("<i8")
        planes = [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in (numbers, counts)]
        head = json.dumps([len(self.table), len(part), len(names)]).encode()
        press = zstandard.ZstdCompressor(level=1).compress
        return press(b"".join(names)), press(head + b"\n" + b"".join(planes) + self.kinds[part].tobytes())


def _unpacked(names: bytes, data: bytes) -> Keys:
    head, _, rest = zstandard.ZstdDecompressor().decompress(data).partition(b"\n")
    longest, n, words = json.loads(head)

    def numbers(start: int, many: int, dtype: str) -> np.ndarray:
        width = np.dtype(dtype).itemsize
        planes = np.frombuffer(rest, np.uint8, many * width, start).reshape(width, many)
        return np.ascontiguousarray(planes.T).view(dtype).ravel()

    table = numbers(0, longest * n + words, "<u4")
    counts = numbers(4 * len(table), n, "<i8")
    kinds = np.frombuffer(rest, np.int8, n, 4 * len(table) + 8 * n)
    text, ends = zstandard.ZstdDecompressor().decompress(names), np.cumsum(table[longest * n :]).tolist()
    listed = [text[a:b] for a, b in zip([0, *ends], ends)]
    return Keys(listed, table[: longest * n].astype(np.int32).reshape(longest, n), counts, kinds)


def _merged(parts: list[Keys]) -> Keys:
    """The keys of all parts, with the words numbered alike."""
    number: dict[bytes, int] = {}
    tables = []
    for part in parts:
        found = [number.setdefault(name, len(number) + 1) for name in part.names]
        tables.append(np.array([0, *found], dtype=np.int32)[part.table])
    return Keys(
        list(number),
        np.concatenate(tables, axis=1),
        np.concatenate([p.counts for p in parts]),
        np.concatenate([p.kinds for p in parts]),
    )


def _rows(parcels: Iterator[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    route, names, data = zip(*parcels)
    return pa.RecordBatch.from_arrays(
        [pa.array(route, pa.int64()), pa.array(names, pa.binary()), pa.array(data, pa.binary())],
        names=["route", "names", "data"],
    )


def _dealt(
    longest: int, routes: int, chunk: int, hot: tuple[float, int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The keys of texts, summed and dealt to routes, ``chunk`` words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for raw, offsets, langs in _slices(batch):
                words.add(raw, offsets, langs)
                if words.held >= chunk:
                    yield sent(words)
                    words = Words()
        if words.held:
            yield sent(words)

    def sent(words: Words) -> pa.RecordBatch:
        keys = words.keys(longest).summed().without_hot_pairs(*hot)
        return _rows(keys.parcels(keys.routes(routes)))

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Texts of about ``SLICE_BYTES``; longer ones are cut at the end of a piece."""
    langs = [lang.as_py() for lang in batch.column("lang").cast(pa.binary())]
    held, offsets, of = [], [0], []
    for lang, text in zip(langs, batch.column("text").cast(pa.binary())):
        for part in _parts(text.as_py() or b""):
            held.append(part)
            offsets.append(offsets[-1] + len(part))
            of.append(lang)
            if offsets[-1] >= SLICE_BYTES:
                yield np.frombuffer(b"".join(held), np.uint8), np.array(offsets), of
                held, offsets, of = [], [0], []
    if offsets[-1]:
        yield np.frombuffer(b"".join(held), np.uint8), np.array(offsets), of


def _parts(text: bytes) -> Iterator[bytes]:
    if len(text) <= SLICE_BYTES:
        yield text
        return
    ends, start = np.flatnonzero(_STOP[np.frombuffer(text, np.uint8)]) + 1, 0
    while start < len(text):
        later = np.searchsorted(ends, start + SLICE_BYTES)
        end = int(ends[later]) if later < len(ends) else len(text)
        yield text[start:end]
        start = end


def _dealt_again(routes: int, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parcels dealt to more routes, about ``chunk`` of one route's keys at a time. For
    parcels in the order of their routes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, parts, held = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if parts and (row["route"] != route or held >= chunk):
                    yield sent(parts)
                    parts, held = [], 0
                route = row["route"]
                parts.append(_unpacked(row["names"], row["data"]))
                held += len(parts[-1].counts)
        if parts:
            yield sent(parts)

    def sent(parts: list[Keys]) -> pa.RecordBatch:
        keys = _merged(parts).summed()
        return _rows(keys.parcels(keys.routes(routes)))

    return run


def quicksorted(table: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(size, first, occurrences)`` of the phrases of ``least`` occurrences or more that
    begin ``table``'s keys: the phrase is the ``size`` first words of key ``first``."""
    longest = len(table)
    order = np.arange(table.shape[1], dtype=np.int64)
    starts, depths = np.zeros(min(1, len(order)), dtype=np.int64), np.zeros(min(1, len(order)), dtype=np.int64)
    while len(starts):
        sizes = np.diff(starts, append=len(order))
        pivots = np.sort([table[depths, order[starts + at]] for at in (0 * sizes, sizes // 2, sizes - 1)], axis=0)[1]
        part = np.repeat(np.arange(len(starts)), sizes)
        side = np.sign(table[depths[part], order] - pivots[part]) + 1
        # places of the smaller, the equal and the larger keys of each partition, in this order
        split = np.bincount(3 * part + side, minlength=3 * len(starts))
        order = order[np.argsort((3 * part + side).astype(np.int64), kind="stable")]
        begins = np.cumsum(split) - split
        there = np.flatnonzero(split)
        weight = np.add.reduceat(counts[order], begins[there])
        depth = np.repeat(depths, 3)[there]
        equal = there % 3 == 1
        phrase = equal & (weight >= least) & (np.repeat(pivots, 3)[there] > 0)
        for size in range(1, longest + 1):
            chosen = phrase & (depth == size - 1)
            if chosen.any():
                yield size, order[begins[there[chosen]]], weight[chosen]
        depth = depth + equal
        # a partition of equal keys goes on unless they end here
        stays = (weight >= least) & (~equal | (phrase & (depth < longest)))
        sizes = split[there]
        order = order[np.repeat(stays, sizes)]
        starts = np.cumsum(sizes[stays]) - sizes[stays]
        depths = depth[stays]


def _counted(longest: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """The phrases and words of one route."""

    def run(parcels: pa.Table) -> pa.Table:
        keys = _merged([_unpacked(row["names"], row["data"]) for row in parcels.to_pylist()]).summed()
        names = [name.rpartition(b" ") for name in keys.names]
        langs, words = [n[0].decode() for n in names], [n[2].decode() for n in names]
        found = {"lang": [], "phrase": [], "size": [], "f": [], "whole": []}

        def add(size: int, table: np.ndarray, times: np.ndarray, whole: bool) -> None:
            listed = table[:size].T.tolist()
            found["lang"] += [langs[key[0] - 1] for key in listed]
            found["phrase"] += [" ".join([words[i - 1] for i in key]) for key in listed]
            found["size"] += [size] * len(listed)
            found["f"] += times.tolist()
            found["whole"] += [whole] * len(listed)

        single = keys.kinds == WORD
        often = single & (keys.counts >= least)
        add(1, keys.table[:, often], keys.counts[often], True)
        totals: dict[str, int] = {}
        for i, times in zip(keys.table[0, single].tolist(), keys.counts[single].tolist()):
            totals[langs[i - 1]] = totals.get(langs[i - 1], 0) + times
        for lang, times in totals.items():
            for column, value in zip(found, (lang, "", 0, times, False)):
                found[column].append(value)

        code = keys.table[0].astype(np.int64) * (len(names) + 1) + (keys.table[1] if longest > 1 else 0)
        marked = np.isin(code, code[keys.kinds == PAIR])
        beneath = keys.kinds == BENEATH
        parted = marked & (keys.kinds == PLAIN)
        here = np.flatnonzero((keys.kinds == PLAIN) | (keys.kinds == PAIR))
        for size, first, times in quicksorted(keys.table[:, here], keys.counts[here], least):
            first = here[first]
            if size == 1:  # its occurrences are spread over routes
                continue
            whole = (size == 2) | ~marked[first]
            add(size, keys.table[:, first[whole]], times[whole], True)
        for rows in (np.flatnonzero(parted), np.flatnonzero(beneath)):
            for size, first, times in quicksorted(keys.table[:, rows], keys.counts[rows], 1):
                if size > 2:
                    add(size, keys.table[:, rows[first]], times, False)
        return pa.table({name: pa.array(found[name], kind) for name, kind in _COUNT_TYPES.items()})

    return run


_COUNT_TYPES = {"lang": pa.string(), "phrase": pa.string(), "size": pa.int32(), "f": pa.int64(), "whole": pa.bool_()}


def phrase_counts(documents: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of the phrases of up to ``longest`` words that occur
    ``least`` times or more, and ``(lang, n)``, the words of each lang."""
    texts = ready(documents).select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    routes = 1 << (buckets_for(documents, ROUTE_BYTES) - 1).bit_length()  # so that rounds nest
    dealt = min(routes, FAN_OUT)
    parcels = texts.mapInArrow(_dealt(longest, dealt, CHUNK_WORDS, (HOT_SHARE, HOT_KEYS)), _PARCEL)
    while dealt < routes:
        before, dealt = dealt, min(routes, dealt * FAN_OUT)
        in_order = parcels.repartition(before, "route").sortWithinPartitions("route")
        parcels = in_order.mapInArrow(_dealt_again(dealt, CHUNK_WORDS), _PARCEL)
    found = kept(parcels.groupBy("route").applyInArrow(_counted(longest, least), _COUNT))
    words = found.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    parts = found.where("size > 0 AND NOT whole").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    counts = found.where("whole").drop("whole").union(parts.where(F.col("f") >= least))
    return kept(counts), kept(words)


def collocations(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each lang."""
    counts, words = phrase_counts(documents, longest, least)
    phrases = counts.where("size > 1")
    found = _scored(_uncovered(phrases, covered), counts)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    few = found.withColumn("place", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order)))
    ranked = few.where(F.col("place") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    return (
        ranked.where(F.col("rank") <= top)
        .join(F.broadcast(words), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _uncovered(phrases: DataFrame, covered: int) -> DataFrame:
    """The phrases without those that a longer one around them mostly accounts for."""
    inside = F.expr(
        "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, s), ' '))))"
    )
    around = (
        phrases.where("size > 2")
        .select("lang", F.explode(inside).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("most"))
    )
    rows = phrases.join(around, ["lang", "phrase"], "left")
    return rows.where(F.coalesce(100 * F.col("most") < covered * F.col("f"), F.lit(True))).drop("most")


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` by the lowest-scoring cut, ties to the first."""
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.struct("lang", F.expr("substring_index(phrase, ' ', k)").alias("phrase")).alias("left"),
        F.struct("lang", F.expr("substring_index(phrase, ' ', k - size)").alias("phrase")).alias("right"),
    )
    parts = counts.select(F.struct("lang", "phrase").alias("left"), F.col("f").alias("l"))
    cuts = join_one_each(cuts, parts, "left").drop("left")
    cuts = join_one_each(cuts, parts.select(F.col("left").alias("right"), F.col("l").alias("r")), "right")
    exact = {c: f"cast({c} AS decimal(19, 0))" for c in "alr"}
    score = F.expr(f"(1000000BD * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    return scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
split AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
),
placed AS (SELECT lang, id, generate_subscripts(w, 1) AS i, unnest(w) AS word_0 FROM split),
ahead AS (
  SELECT lang, word_0, {", ".join(f"lead(word_0, {k}) OVER piece AS word_{k}" for k in range(1, LONGEST))}
  FROM placed WINDOW piece AS (PARTITION BY id ORDER BY i)
),
f AS (
  {" UNION ALL ".join(
      f"SELECT lang, {k + 1} AS size, concat_ws(' ', {', '.join(f'word_{j}' for j in range(k + 1))}) AS phrase, "
      f"count(*) AS f FROM ahead WHERE word_{k} IS NOT NULL GROUP BY ALL"
      for k in range(LONGEST)
  )}
),
words AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {LEAST}),
inside AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (SELECT unnest(range(1, {LONGEST})) AS i), (SELECT unnest(range(2, {LONGEST})) AS s)
  WHERE s < size AND i + s - 1 <= size GROUP BY ALL
),
stay AS (
  SELECT c.* FROM candidates c LEFT JOIN inside USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < {COVERED} * a
),
cuts AS (
  SELECT s.lang, s.phrase, a, k, l.f AS l, r.f AS r,
    cast((1000000::hugeint * a * a) // (l.f::hugeint * r.f) AS bigint) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM stay) s
  JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1 : k], ' ')
  JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[k + 1 :], ' ')
),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, cast(n AS bigint) AS n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
) JOIN words USING (lang) WHERE rank <= {TOP}
"""
