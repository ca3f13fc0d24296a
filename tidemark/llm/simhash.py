"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in few bits.

A bit of a fingerprint is 1 if it is in over half of the XXH64 hashes of a text's word
shingles. Fingerprints link at ``RADIUS`` or fewer differing bits; the result is the
components of all links, with no link between different fingerprints lost.

1. Equal fingerprints are one row from here on, whatever number of documents has them.
2. The bits are cut into ``RADIUS + m`` blocks. A close pair differs in at most ``RADIUS`` of
   them, so it agrees in ``m`` whole ones: joining on every choice of m blocks finds it. m
   grows with the number of fingerprints, so that buckets stay small.
3. A bucket's rows are sorted and each is compared with the ``NEAR`` that follow, which is
   every pair of a bucket of up to ``NEAR + 1``. Of the verified pairs a spanning forest is
   kept, so a group of copies sends a row per member and not its pairs. Buckets of
   far more rows, known from a sample, are split.
4. Larger buckets need no more if they lie in one component by now, as those of a group of
   near copies do. Of the others, the rows outside a bucket's largest component are
   compared with all its rows; if these are many, the bucket is first dealt anew by its
   other bits, cut into blocks in the same way.

Defined results: NULL, empty or blank texts have fingerprint 0, which links like any other;
texts of fewer than four words have one shingle, the whole sequence. Rows without doc_id
are left out; a repeated row is repeated in the result; a doc_id with several texts has a
row each, and names a component if it is the smallest in it. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, join_one_each, kept, ready
from tidemark.llm.components import connected_components

SHINGLE = 4
SEED = 42
BITS = 64
RADIUS = 4
#: Rows that follow in a bucket's order with which a row is compared.
NEAR = 64
#: Fingerprints a bucket should hold, were they random.
FILL = 16
#: One in so many fingerprints tells which buckets are split.
SAMPLE = 64
#: Rows of a part of a split bucket, and of a task.
PART_ROWS, TASK_ROWS = 20_000, 500_000
#: Buckets that may be broadcast.
MOST_BROADCAST = 100_000
#: Comparisons a fingerprint, and in all, that need no finer buckets first.
PAIRS_EACH, LEAST_PAIRS = 1000, 100_000_000
#: Buckets that agree in all but so many bits are small: no finer ones are made.
FEW_BITS = 12
#: Bytes of a text that are hashed at once.
SLICE_BYTES = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, some at a time."""
    start = 0
    while start < len(text):
        gap = _SPACE.search(text, start + SLICE_BYTES)
        end = gap.start() if gap else len(text)
        yield text[start:end].translate(_LOWER).split()  # at these six characters
        start = end


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    line, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
    spans = zip([0, *ends], ends[width - 1 :])
    return np.array([xxhash.xxh64_intdigest(line[a : b - 1], SEED) for a, b in spans], dtype=">u8")


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    ones, total, held = np.zeros(BITS, dtype=np.int64), 0, []
    for words in _word_lists(text):
        held += words
        if len(held) < size:
            continue
        hashes = _hashes(held, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, BITS // 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
        held = held[len(held) - size + 1 :]
    if total == 0 and held:
        return int(_hashes(held, len(held))[0])
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _fingerprints(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", size) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return run


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of ``documents(doc_id, text)``; fp is the fingerprint as a signed long."""
    rows = ready(documents).where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(_fingerprints(size), "doc_id long, fp long")


def similar_components(documents: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: the smallest doc_id reachable by links."""
    rows = kept(fingerprints(documents))
    classes = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = linked(classes.select("fp")).select(F.col("node").alias("fp"), "root")
    classes = kept(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    names = kept(classes.groupBy("root").agg(F.min("least").alias("component_id")))
    named = join_one_each(classes.select("fp", "root"), names, "root").select("fp", "component_id")
    return join_one_each(rows, kept(named), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def finer_masks(used: int, blocks: int, radius: int = RADIUS) -> list[int]:
    """``used`` with every choice of ``blocks`` of the ``radius + blocks`` blocks of other bits."""
    free = [bit for bit in range(BITS) if not used >> bit & 1]
    n = radius + blocks
    cut = [sum(1 << bit for bit in free[len(free) * i // n : len(free) * (i + 1) // n]) for i in range(n)]
    return [used | sum(choice) for choice in combinations(cut, blocks)]


def _enough_blocks(n: int) -> int:
    blocks = 2
    while n > FILL << (BITS * blocks // (RADIUS + blocks)) and blocks < 2 * RADIUS:
        blocks += 1
    return blocks


def linked(fps: DataFrame) -> DataFrame:
    """``(node, root)`` for every fingerprint linked to another; ``fps(fp)``, without repeats."""
    n, roots = fps.count(), None
    masks = finer_masks(0, _enough_blocks(n))
    rows = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        rows = kept(rows).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        found = kept(_compared(rows))
        edges = found.where("a IS NOT NULL").select("a", "b")
        if roots is not None:
            edges = edges.union(roots)
        roots = connected_components(edges)
        crowded = kept(found.where("mask IS NOT NULL").select("mask", "key").distinct())
        rows, pairs = _unsettled(rows, crowded, roots)
        if pairs == 0:
            return roots
        finest = min(BITS - m.bit_count() for m in masks)
        if finest <= FEW_BITS or pairs <= max(LEAST_PAIRS, PAIRS_EACH * n):
            return connected_components(_remaining(rows).union(roots))
        finer = {m: finer_masks(m, 2) for m in masks}
        masks = sorted({m for many in finer.values() for m in many})
        ways = fps.sparkSession.createDataFrame(
            [(_signed(used), [_signed(m) for m in many]) for used, many in finer.items()],
            "mask long, finer array<long>",
        )
        # Two ways can lead to one bucket.
        rows = rows.join(F.broadcast(ways), "mask").select("fp", F.explode("finer").alias("mask")).distinct()


def _compared(rows: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of a spanning forest of what neighbours in buckets have, and
    ``(mask, key)`` of the buckets that have pairs left. ``rows(fp, mask, key)``."""
    bucket = ["mask", "key"]
    sample = kept(rows.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0).groupBy(*bucket).agg(F.count("*").alias("n")))
    drawn = sample.agg(F.sum("n")).first()[0] or 0
    # So many drawn rows are more than a bucket can hold and be compared whole.
    large = sample.where(F.col("n") > max(NEAR + 1, drawn // MOST_BROADCAST))
    large = large.select(*bucket, F.ceil(F.col("n") * SAMPLE / F.lit(PART_ROWS)).cast("int").alias("parts"))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // TASK_ROWS)
    dealt = (
        rows.join(F.broadcast(large), bucket, "left")
        .withColumn("part", F.coalesce(F.pmod(F.xxhash64("fp", "mask"), F.col("parts")), F.lit(0)))
        .select(*bucket, "part", "fp")
        .repartition(parts, *bucket, "part")
        .sortWithinPartitions(*bucket, "part", "fp")
    )
    found = ready(dealt).mapInArrow(_neighbours(NEAR, RADIUS), "a long, b long, mask long, key long")
    none = F.lit(None).cast("long")
    return found.union(large.select(none, none, *bucket))


def _neighbours(near: int, radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            fresh = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            mask, key, part, fp = held = [np.concatenate(pair) for pair in zip(held, fresh)]
            lower, higher, crowded = [], [], np.zeros(0, np.int64)
            for d in range(1, min(near + 2, len(fp))):
                same = np.flatnonzero((key[d:] == key[:-d]) & (mask[d:] == mask[:-d]) & (part[d:] == part[:-d]))
                if not len(same):
                    break
                if d > near:
                    crowded = same
                    break
                close = same[np.bitwise_count((fp[same] ^ fp[same + d]).view(np.uint64)) <= radius]
                lower.append(close)
                higher.append(close + d)
            a = b = np.zeros(0, np.int64)
            if lower:
                root = _roots(len(fp), np.concatenate(lower), np.concatenate(higher))
                member = np.flatnonzero(root != np.arange(len(fp)))
                a, b = fp[member], fp[root[member]]
            buckets = np.unique(np.stack([mask[crowded], key[crowded]]), axis=1)
            absent, blank = pa.nulls(len(a), pa.int64()), pa.nulls(buckets.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(a, pa.int64()), blank]),
                    pa.concat_arrays([pa.array(b, pa.int64()), blank]),
                    pa.concat_arrays([absent, pa.array(buckets[0], pa.int64())]),
                    pa.concat_arrays([absent, pa.array(buckets[1], pa.int64())]),
                ],
                names=["a", "b", "mask", "key"],
            )
            held = [column[-near - 1 :] for column in held]

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place linked to each of ``n`` places by links ``i, j``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            return root
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]


def _unsettled(rows: DataFrame, crowded: DataFrame, roots: DataFrame) -> tuple[DataFrame, int]:
    """The rows of crowded buckets of several components, each with its root and whether
    that is the bucket's largest, and how many comparisons they need."""
    bucket = ["mask", "key"]
    crowded = broadcast_if_small(crowded, crowded.count(), MOST_BROADCAST)
    of = roots.select(F.col("node").alias("fp"), "root")
    inside = rows.join(crowded, bucket).join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    inside = kept(inside.select("fp", *bucket, "root"))
    shares = kept(inside.groupBy(*bucket, "root").agg(F.count("*").alias("n")))
    largest = kept(
        shares.groupBy(*bucket)
        .agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select(*bucket, F.col("most.root").alias("largest"), (F.col("n") * (F.col("n") - F.col("most.n"))).alias("pairs"))
    )
    pairs = largest.agg(F.sum("pairs")).first()[0] or 0
    if pairs == 0:
        return inside, 0
    small = broadcast_if_small(largest, largest.count(), MOST_BROADCAST)
    return kept(inside.join(small.drop("pairs"), bucket)), pairs


def _remaining(rows: DataFrame) -> DataFrame:
    """Links between different components within buckets, as links of their roots."""
    few = rows.where("root <> largest").select("mask", "key", F.col("fp").alias("x"), F.col("root").alias("a"))
    close = F.bit_count(F.col("x").bitwiseXOR(F.col("fp"))) <= RADIUS
    linked = few.join(rows.select("mask", "key", "fp", F.col("root").alias("b")), ["mask", "key"])
    return linked.where((F.col("a") != F.col("b")) & close).select("a", "b").distinct()
