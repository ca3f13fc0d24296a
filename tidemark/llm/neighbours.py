"""Approximate nearest neighbours by largest inner product: adaptive dimension scans.

Vectors are rotated at random, so that every block of ``COLUMNS`` dimensions is a sample of
the distance. They lie in lists around centroids fitted on a bounded sample; a query scans
the ``PROBED`` share of the lists nearest to it. In a list, the distance over the first
blocks tests the hypothesis that a candidate is among the best: it is abandoned as soon as
its partial squared distance, scaled up, is over the bound by more than the test allows
(``EPSILON`` deviations). Survivors are scored exactly on the original vectors.

Every vector is indexed. Lists are cut into blocks of ``BLOCK`` vectors and ``QUERIES``
queries, so neither a hot list nor a hot query meets in one task; each gives a query's
best of its block, and only these are ranked.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components, that
lack an id, or whose length is not the most frequent one, take no part. Equal scores go
by smaller vec_id; repeated vec_ids are candidates each, with equal and with unlike vectors,
save the query's own id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, ready

SAMPLE = 20_000
MOST_LISTS = 4096
PROBED = 0.7
LEAST_PROBED = 8
COLUMNS = 16
EPSILON = 2.1
#: Vectors scored in full for each query: their kth best score starts its bound.
SEEDS = 4096
#: Share of the pairs alive below which the rest is scanned pair by pair.
SPARSE = 0.1
BLOCK = 2048
QUERIES = 512


def _usable(vectors: DataFrame) -> DataFrame:
    value = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).where(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(value(x), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0)
    )


def _keyed(vectors: DataFrame) -> DataFrame:
    """With ``key``, which tells the unlike vectors of one vec_id apart."""
    return vectors.withColumn("key", F.xxhash64("embedding"))


def _rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def _centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """k-means by a few rounds over the sample."""
    generator = np.random.default_rng(11)
    distinct = np.unique(sample, axis=0)
    centres = distinct[generator.permutation(len(distinct))[:lists]]
    for _ in range(8):
        near = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T, axis=1)


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _listed(centres: np.ndarray):
    """Each vector with its list."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("embedding"), centres.shape[1]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("key"),
                    batch.column("embedding"),
                    pa.array(_nearest(x, centres), pa.int32()),
                ],
                names=["vec_id", "key", "embedding", "list"],
            )

    return place


def _probed(centres: np.ndarray, probes: int, seeds: np.ndarray, seed_rows: pd.DataFrame, k: int):
    """Each query with the lists it scans and the kth best score of the seeds, and with the
    best seeds themselves (``list`` NULL). Of ``seeds`` no two have id and vector equal;
    ``seed_rows`` has the vec_id, key and number of copies of each."""
    seed_ids, seed_keys, seed_copies = (seed_rows[c].to_numpy() for c in ("vec_id", "key", "copies"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            x = _matrix(batch.column("embedding"), centres.shape[1]).astype(np.float64)
            near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :probes]
            least = np.full(len(x), -np.inf)
            best = np.zeros((len(x), 0), int)
            if len(seeds) > k:
                scores = np.where(ids[:, None] == seed_ids[None, :], -np.inf, x @ seeds.T)
                best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                least = np.take_along_axis(scores, best, axis=1).min(axis=1)
            rows = np.repeat(np.arange(len(x)), near.shape[1])
            seeded = np.repeat(np.arange(len(x)), best.shape[1])
            exact = (x[seeded] * seeds[best.reshape(-1)]).sum(axis=1)
            found = np.isfinite(np.take_along_axis(scores, best, axis=1)).reshape(-1) if len(seeds) > k else []
            seeded, chosen, exact = seeded[found], best.reshape(-1)[found], exact[found]
            blank, absent = [None] * len(rows), [None] * len(seeded)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[rows], ids[seeded]]), pa.int64()),
                    batch.column("embedding").take(pa.array(np.concatenate([rows, seeded]))),
                    pa.array(near.reshape(-1).tolist() + absent, pa.int32()),
                    pa.array(least[rows].tolist() + absent, pa.float64()),
                    pa.array(blank + seed_ids[chosen].tolist(), pa.int64()),
                    pa.array(blank + seed_keys[chosen].tolist(), pa.int64()),
                    pa.array(blank + seed_copies[chosen].tolist(), pa.int64()),
                    pa.array(blank + exact.tolist(), pa.float64()),
                ],
                names=["query_id", "embedding", "list", "least", "vec_id", "key", "copies", "score"],
            )

    return place


def scan_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    least: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    rotation: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of a block for each query, as (query row, vector row, score), of those
    that score ``least`` or more."""
    width = vectors.shape[1]
    q, x = queries @ rotation, vectors @ rotation
    alive = query_ids[:, None] != ids[None, :]
    norms = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :]
    bound = np.maximum(norms - 2 * least[:, None], 0) * (1 + 1e-9) + 1e-9
    partial, rows = np.zeros(alive.shape), None
    for start in range(0, width, COLUMNS):
        end = min(start + COLUMNS, width)
        a, b = q[:, start:end], x[:, start:end]
        # how far over the bound a scaled partial distance may be by chance
        slack = (1 + EPSILON / math.sqrt(end)) ** 2 * end / width if end < width else 1.0
        if rows is None:  # all pairs, in one product
            partial += (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T
            alive &= partial <= bound * slack
            if alive.mean() < SPARSE:
                rows, columns = np.nonzero(alive)
                partial, bound = partial[rows, columns], bound[rows, columns]
        else:  # what is left, pair by pair
            partial += ((a[rows] - b[columns]) ** 2).sum(axis=1)
            stay = partial <= bound * slack
            rows, columns, partial, bound = rows[stay], columns[stay], partial[stay], bound[stay]
    if rows is None:
        rows, columns = np.nonzero(alive)
    scores = (queries[rows] * vectors[columns]).sum(axis=1)
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    best = place < k
    return rows[best], columns[best], scores[best]


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``, the ``k`` nearest found of each row of ``queries``,
    which are rows of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    usable = _usable(ready(vectors))
    lengths = usable.groupBy(F.size("embedding").alias("width")).count()
    common = lengths.orderBy(F.desc("count"), "width").first()
    result = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], result)
    width, total = common["width"], common["count"]
    usable = usable.where(F.size("embedding") == width)
    usable = _keyed(usable)
    # ids first, so that no more than the sample's vectors are sent
    chosen = usable.groupBy("vec_id", "key").agg(F.count("*").alias("copies"))
    chosen = chosen.orderBy(F.xxhash64("vec_id", "key"), "vec_id", "key").limit(SAMPLE)
    rows = usable.join(F.broadcast(chosen), ["vec_id", "key"]).dropDuplicates(["vec_id", "key"]).toPandas()
    rows = rows.sort_values(["vec_id", "key"])
    sample = np.stack(rows["embedding"].to_list()).astype(np.float64)
    picked = np.random.default_rng(13).permutation(len(sample))[:SEEDS]
    seeds, seed_rows = sample[picked], rows[["vec_id", "key", "copies"]].iloc[picked]
    centres = _centroids(sample, max(1, min(MOST_LISTS, round(math.sqrt(total) / 2))))
    probes = max(LEAST_PROBED, math.ceil(PROBED * len(centres)))
    rotation = _rotation(width)

    listed = kept(usable.mapInArrow(_listed(centres), "vec_id long, key long, embedding array<float>, list int"))
    asked = _usable(queries).where(F.size("embedding") == width)
    started = kept(
        asked.mapInArrow(
            _probed(centres, probes, seeds, seed_rows, k),
            "query_id long, embedding array<float>, list int, least double,"
            " vec_id long, key long, copies long, score double",
        )
    )
    probing = started.where("list IS NOT NULL").select("query_id", "embedding", "list", "least")
    # a row for each list at most, of which there are MOST_LISTS
    blocks = listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    groups = probing.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).alias("groups"))
    cuts = F.broadcast(blocks.join(groups, "list"))

    def numbers(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    stored = listed.join(cuts, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), "blocks").alias("block"), numbers("groups").alias("group"),
        "vec_id", "key", "embedding",
    )
    scanning = probing.join(cuts, "list").select(
        "list", numbers("blocks").alias("block"), F.pmod(F.xxhash64("query_id"), "groups").alias("group"),
        "query_id", "embedding", "least",
    )

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "key": [], "score": []}).astype(
                {"query_id": int, "vec_id": int, "key": int}
            )
        ids, query_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        x = np.stack(left["embedding"].to_list()).astype(np.float64)
        q = np.stack(right["embedding"].to_list()).astype(np.float64)
        rows, columns, scores = scan_block(q, query_ids, right["least"].to_numpy(), x, ids, rotation, k)
        return pd.DataFrame(
            {
                "query_id": query_ids[rows],
                "vec_id": ids[columns],
                "key": left["key"].to_numpy()[columns],
                "score": scores,
            }
        )

    keys = ["list", "block", "group"]
    found = stored.groupBy(*keys).cogroup(scanning.groupBy(*keys)).applyInPandas(
        scan, "query_id long, vec_id long, key long, score double"
    )
    # a seed is also found in its list; its copies are a candidate each
    seeded = started.where("list IS NULL").select("query_id", "vec_id", "key", "copies", "score")
    found = (
        found.join(seeded.select("query_id", "vec_id", "key"), ["query_id", "vec_id", "key"], "left_anti")
        .select("query_id", "vec_id", "score")
        .union(
            seeded.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
            .select("query_id", "vec_id", "score")
        )
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
