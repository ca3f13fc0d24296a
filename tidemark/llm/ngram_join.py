"""N-gram Jaccard join: documents whose sets of word shingles are alike, by prefix trees.

Two documents link when their shingle sets' Jaccard similarity is 0.75 or more; the
result is the components of all links, with no link between different sets lost.

1. Equal sets are one class, named by a 128-bit signature; only classes are compared.
2. Linked classes share ``l = n // 10`` shingles of those with the smallest hashes, taking
   ``n - ceil(3n/4) + l`` of each. These are dealt to buckets by hash and counted; a
   class goes on only if that many of its own are shared with another class. Shingles
   of a large part of all documents (``HOT_SHARE``) are recognised beforehand and dealt
   by document, so no bucket gathers one.
3. Of the classes left all shingles are counted in the same way. A class links with
   nothing unless three quarters of its shingles are shared. The global order is by
   frequency, rarest first. Linked classes share a shingle among the first ``n -
   ceil(3n/4) + 1`` of each (the prefix), so candidates share one there.
4. Each class follows the smallest class of most of its prefix shingles; classes so
   connected are a family. Families are cut into blocks of ``BLOCK``, the class most
   followed being in each. A block's ordered sets are stored in a trie, and members
   probe it, leaving subtrees of their own component: copies of one text are united
   without their pairs being made. Of a family of several blocks, sets outside its
   largest component then probe the tries of all its blocks.
5. Prefix shingles shared by different components of different families are what is left:
   the classes of the smaller family probe the tries of the larger one's blocks.

Defined results: NULL, empty or blank texts have no shingles and link with nothing. Texts
of fewer than five words have one shingle, the whole sequence. Rows without doc_id are
left out; a repeated row is repeated in the result; a doc_id with several texts belongs
to the components of each, named by their smallest doc_id. Other columns are ignored.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, buckets_for, kept, ready
from tidemark.llm.components import connected_components
from tidemark.llm.settrie import SetTrie
from tidemark.llm.shingles import mix, shingle_sets

#: Share of a chunk's rows that makes a shingle hot there; one found so in half that share
#: of all documents is hot. Fewer than 2 * (mean shingles a document) / HOT_SHARE shingles
#: can be, however many documents there are and however they are ordered.
HOT_SHARE = 1 / 64
#: Fewest rows of a batch, for a shingle to be hot.
HOT_ROWS = 16
#: Sets stored in one trie.
BLOCK = 384
#: Input bytes a bucket of shingles.
BUCKET_BYTES = 4 << 20
#: Shingles handled at once by a task.
CHUNK = 1_000_000
#: Documents that may be broadcast by id; beyond, the join shuffles.
MOST_BROADCAST = 2_000_000

def _signature(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    sums = np.array(
        [
            mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles)),
            mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64),
        ],
        dtype="<u8",
    )
    return sums.tobytes()


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The shingle sets of consecutive rows, about ``CHUNK`` shingles at a time."""
    first, held, chunk = 0, 0, []
    for shingles in shingle_sets(batch.column("text")):
        chunk.append(shingles)
        held += len(shingles)
        if held >= CHUNK:
            yield first, chunk
            first, held, chunk = first + len(chunk), 0, []
    if chunk:
        yield first, chunk


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row per shingle hot in a chunk."""
    for batch in batches:
        for first, sets in _chunks(batch):
            hot, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= max(HOT_ROWS, HOT_SHARE * len(sets))
            hot, counts = hot[often], counts[often]
            blank, absent = [None] * len(hot), [None] * len(sets)
            names = [_signature(s) for s in sets]
            ids = batch.column("doc_id").slice(first, len(sets)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids + blank, pa.int64()),
                    pa.array([len(s) for s in sets] + blank, pa.int64()),
                    pa.array(names + blank, pa.binary()),
                    pa.array([int.from_bytes(n[:8], "little", signed=True) for n in names] + blank, pa.int64()),
                    pa.array(absent + hot.view(np.int64).tolist(), pa.int64()),
                    pa.array(absent + counts.tolist(), pa.int64()),
                ],
                names=["doc_id", "n_shingles", "sig", "key", "token", "rows"],
            )


def _least(n: int) -> int:
    """Shingles that linked sets share among their ``_first``, if both have this size."""
    return max(1, n // 10)


def _first(n: int) -> int:
    return min(n, n - -(-3 * n // 4) + _least(n))


_DEALT = "bucket int, hot boolean, keys binary, tokens binary"


def _dealt(hot: np.ndarray, buckets: int, whole: bool):
    """Deals the shingles of each set, or its first ones, to buckets: by shingle, or by set
    if hot. A set's key is the first half of its signature."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in (c for batch in batches for c in _chunks(batch)):
            sets = {_signature(s)[:8]: s if whole else s[: _first(len(s))] for s in chunk if len(s)}
            if not sets:
                continue
            sizes = [len(s) for s in sets.values()]
            keys = np.repeat(np.frombuffer(b"".join(sets), dtype="<u8"), sizes)
            tokens = np.concatenate(list(sets.values()))
            is_hot = np.isin(tokens, hot) if len(hot) else np.zeros(len(tokens), bool)
            where = np.where(is_hot, mix(keys) % np.uint64(buckets), _bucket(tokens, buckets)).astype(np.int64)
            order = np.argsort(2 * where + is_hot, kind="stable")
            rows = [
                (int(where[part[0]]), bool(is_hot[part[0]]), keys[part].tobytes(), _packed(tokens[part]))
                for part in np.split(order, np.flatnonzero(np.diff((2 * where + is_hot)[order])) + 1)
            ]
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                names=["bucket", "hot", "keys", "tokens"],
            )

    return deal


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """A mix of the shingle's hash, so that small hashes are dealt to all buckets."""
    return mix(tokens) % np.uint64(buckets)


def _packed(tokens: np.ndarray) -> bytes:
    """Six bytes of a mix of each token; together with the bucket they tell it apart."""
    return mix(tokens ^ np.uint64(0x94D049BB133111EB)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(block: bytes) -> np.ndarray:
    wide = np.zeros((len(block) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(block, dtype=np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


_SHARED = "home int, keys binary, tokens binary, rows binary"


def _counted(hot: np.ndarray, hot_rows: np.ndarray, buckets: int, whole: bool):
    """Of one bucket: the shingles more than one set has, with their frequency, dealt by
    set; without ``whole`` only how many each set has of them."""

    def count(key: tuple[int, ...], frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for flag, part in frame.groupby("hot"):
            keys = np.frombuffer(b"".join(part["keys"]), dtype=np.uint64)
            tokens = _unpacked(b"".join(part["tokens"]))
            order = np.lexsort((keys, tokens))
            keys, tokens = keys[order], tokens[order]
            new = np.ones(len(keys), bool)  # a set that several chunks have counts once
            new[1:] = (keys[1:] != keys[:-1]) | (tokens[1:] != tokens[:-1])
            keys, tokens = keys[new], tokens[new]
            if flag:
                known = _unpacked(_packed(hot))
                place = np.argsort(known, kind="stable")
                rows = hot_rows[place][np.searchsorted(known[place], tokens)]
                tokens = tokens | np.uint64(1 << 63)
            else:
                starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
                times = np.diff(np.concatenate((starts, [len(tokens)])))
                rows = np.repeat(times, times)
                # unlike the tokens of other buckets
                tokens = tokens | (np.uint64(key[0] & 0x7FFF) << np.uint64(48))
            shared = rows > 1
            found.append((keys[shared], tokens[shared], rows[shared]))
        keys, tokens, rows = (np.concatenate(x) for x in zip(*found, strict=True))
        if not whole:
            keys, n = np.unique(keys, return_counts=True)
            return pd.DataFrame({"key": keys.view(np.int64), "shared": n})
        if len(keys) == 0:
            return pd.DataFrame([], columns=["home", "keys", "tokens", "rows"])
        home = (mix(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        out = [
            (
                int(home[pick[0]]),
                keys[pick].tobytes(),
                tokens[pick].tobytes(),
                rows[pick].astype(np.uint32).tobytes(),
            )
            for pick in np.split(order, np.flatnonzero(np.diff(home[order])) + 1)
        ]
        return pd.DataFrame(out, columns=["home", "keys", "tokens", "rows"])

    return count


_SETS = "key long, tokens binary, rows binary"


def _gathered(frame: pd.DataFrame) -> pd.DataFrame:
    """The shared shingles of each set dealt to one home, in global order."""
    keys = np.frombuffer(b"".join(frame["keys"]), dtype=np.int64)
    tokens = np.frombuffer(b"".join(frame["tokens"]), dtype=np.uint64)
    rows = np.frombuffer(b"".join(frame["rows"]), dtype=np.uint32)
    order = np.lexsort((tokens, rows, keys))
    keys, tokens, rows = keys[order], tokens[order], rows[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
    out = [
        (int(keys[a]), tokens[a:b].tobytes(), rows[a:b].tobytes())
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    return pd.DataFrame(out, columns=["key", "tokens", "rows"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared shingles among the prefix of each set, with their positions."""
    for batch in batches:
        sigs, sizes = batch.column("sig").to_pylist(), batch.column("n").to_pylist()
        tokens, owners, places = [], [], []
        for k, block in enumerate(batch.column("tokens").to_pylist()):
            found = np.frombuffer(block, dtype=np.int64)
            n = sizes[k]
            alone = n - len(found)  # rarest of all, so first in order
            chosen = found[: n - -(-3 * n // 4) + 1 - alone]
            tokens.append(chosen)
            owners += [k] * len(chosen)
            places.append(np.arange(alone, alone + len(chosen)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(tokens or [np.zeros(0, np.int64)])),
                pa.array([sigs[k] for k in owners], pa.binary()),
                pa.array([sizes[k] for k in owners], pa.int64()),
                pa.array(np.concatenate(places or [np.zeros(0, np.int64)]), pa.int64()),
            ],
            names=["token", "sig", "n", "place"],
        )


def _ranked(frame: pd.DataFrame) -> list[np.ndarray]:
    """Each set's tokens as ranks in the global order, most frequent first, so that sets
    of one family begin alike."""
    sets = [np.frombuffer(b, dtype=np.uint64) for b in frame["tokens"]]
    rows = [np.frombuffer(b, dtype=np.uint32) for b in frame["rows"]]
    all_tokens, first, inverse = np.unique(
        np.concatenate(sets), return_index=True, return_inverse=True
    )
    order = np.lexsort((all_tokens, -np.concatenate(rows)[first].astype(np.int64)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ends = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(r) for r in np.split(rank[inverse], ends)]


def _within_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Links that connect the sets of one block as all its links do."""
    frame = frame.drop_duplicates("sig").sort_values("sig").reset_index(drop=True)
    everyone = list(range(len(frame)))
    return _united(frame, np.arange(len(frame)), everyone, everyone)


def _across_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """The same for some sets (``probe``) with those of a block, components being known."""
    frame = frame.sort_values(["probe", "sig"]).reset_index(drop=True)
    probe = frame["probe"].to_numpy()
    classes = np.unique(frame["root"], return_inverse=True)[1]
    return _united(frame, classes, np.flatnonzero(~probe).tolist(), np.flatnonzero(probe).tolist())


def _united(frame: pd.DataFrame, classes: np.ndarray, stored: list[int], probes: list[int]) -> pd.DataFrame:
    sets, sigs, sizes = _ranked(frame), frame["sig"].tolist(), frame["n"].to_numpy()
    trie = SetTrie(stored, sets, sizes, _universe(sets))
    links = [
        (sigs[k], sigs[m]) for k in probes for m in trie.probe(sets[k], int(sizes[k]), classes, k)
    ]
    return pd.DataFrame(links, columns=["a", "b"])


def _universe(sets: list[np.ndarray]) -> int:
    return 1 + max((int(s[-1]) for s in sets if len(s)), default=0)


def similar_components(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``documents(doc_id, text)``."""
    texts = ready(documents).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    summaries = kept(
        texts.mapInArrow(
            _summaries, "doc_id long, n_shingles long, sig binary, key long, token long, rows long"
        )
    )
    rows = summaries.where("token IS NULL").select("doc_id", "n_shingles", "sig")
    sets = kept(_shared_sets(texts, summaries))
    links = _links(sets)
    components = connected_components(links)

    smallest = rows.groupBy("sig").agg(F.min("doc_id").alias("smallest"))
    named = smallest.join(components.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig")
    )
    named = named.join(named.groupBy("root").agg(F.min("smallest").alias("component_id")), "root")
    blank = F.col("n_shingles") == 0
    linked = rows.where(~blank).join(named.select("sig", "component_id"), "sig")
    return linked.select("doc_id", "n_shingles", "component_id").union(
        rows.where(blank).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


def representatives(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` without those of a group's other doc_ids: of each
    component the smallest doc_id stays. Rows without doc_id stay."""
    others = (
        similar_components(documents)
        .groupBy("doc_id")
        .agg(F.max(F.col("component_id") == F.col("doc_id")).alias("first"))
        .where(~F.col("first"))
        .select("doc_id")
    )
    return documents.join(others, "doc_id", "left_anti").select(documents.columns)


def _shared_sets(texts: DataFrame, summaries: DataFrame) -> DataFrame:
    """Classes of which three quarters of the shingles are shared: sig, n, and the shared
    shingles in global order with their frequencies."""
    documents = summaries.where("token IS NULL AND n_shingles > 0").count()
    found = (  # bounded, see HOT_SHARE; the others are dealt by shingle
        summaries.where("token IS NOT NULL")
        .groupBy("token")
        .agg(F.sum("rows").alias("rows"))
        .where(F.col("rows") >= HOT_SHARE / 2 * documents)
        .collect()
    )
    hot = np.array(sorted((r["token"], r["rows"]) for r in found), dtype=np.int64).reshape(-1, 2)
    hot, hot_rows = hot[:, 0].copy().view(np.uint64), hot[:, 1]
    classes = (
        summaries.where("token IS NULL AND n_shingles > 0")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("key").alias("key"))
    )

    def counted(rows: DataFrame, buckets: int, whole: bool, schema: str) -> DataFrame:
        return (
            rows.mapInArrow(_dealt(hot, buckets, whole), _DEALT)
            .repartition(buckets, "bucket")
            .groupBy("bucket")
            .applyInPandas(_counted(hot, hot_rows, buckets, whole), schema)
        )

    buckets = min(buckets_for(texts, BUCKET_BYTES), 1 << 15)
    shared = counted(texts, buckets, False, "key long, shared long")
    smaller = F.ceil(3 * F.col("n") / 4)  # the smallest size of a linked class
    left = kept(
        shared.groupBy("key")
        .agg(F.sum("shared").alias("shared"))
        .join(classes, "key")
        .where(F.col("shared") >= F.greatest(F.lit(1), F.floor(smaller / 10)))
        .select("key", "sig", "n", "doc_id")
    )
    chosen = broadcast_if_small(left.select("doc_id").distinct(), left.count(), MOST_BROADCAST)
    whole = (
        counted(texts.join(chosen, "doc_id", "left_semi"), buckets, True, _SHARED)
        .groupBy("home")
        .applyInPandas(_gathered, _SETS)
    )
    return whole.join(left, "key").where(F.octet_length("tokens") / 8 >= 0.75 * F.col("n")).select(
        "sig", "n", "tokens", "rows"
    )


def _links(sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between signatures, with the same components as all links."""
    index = kept(sets.mapInArrow(_prefixes, "token long, sig binary, n long, place long"))

    # Each class follows the smallest class of most of its prefix shingles.
    hubs = index.groupBy("token").agg(F.min("sig").alias("hub"), F.count("*").alias("m")).where("m > 1")
    followed = kept(
        index.join(hubs, "token")
        .groupBy("sig", "hub")
        .count()
        .groupBy("sig")
        .agg(F.max_by("hub", F.struct("count", F.col("hub"))).alias("hub"))
    )
    families = connected_components(followed.select(F.col("sig").alias("a"), F.col("hub").alias("b")))
    families = kept(
        followed.join(families.withColumnRenamed("node", "sig"), "sig", "left").select(
            "sig", "hub", F.coalesce("root", "sig").alias("family")
        )
    )
    most_followed = (
        families.groupBy("family", "hub")
        .count()
        .groupBy("family")
        .agg(
            F.max_by("hub", F.struct("count", F.col("hub"))).alias("centre"),
            F.ceil(F.sum("count") / BLOCK).alias("blocks"),
        )
    )
    members = families.join(most_followed, "family").select(
        "sig", "family", "blocks", F.pmod(F.xxhash64("sig"), "blocks").alias("block")
    )
    centres = most_followed.select(
        F.col("centre").alias("sig"),
        "family",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    placed = members.select("sig", "family", "block").union(centres)
    within = kept(
        sets.join(placed, "sig").groupBy("family", "block").applyInPandas(_within_block, "a binary, b binary")
    )
    first = kept(within.union(_between_blocks(sets, members, within)))

    roots = connected_components(first).withColumnRenamed("node", "sig")
    placed_index = (
        index.join(roots, "sig", "left")
        .join(members.select("sig", "family"), "sig", "left")
        .withColumn("root", F.coalesce("root", "sig"))
        .withColumn("family", F.coalesce("family", "sig"))
    )
    open_tokens = (
        placed_index.groupBy("token")
        .agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("root", "family")))
        .where("min_root <> max_root AND min_family <> max_family")
        .select("token")
    )
    sizes = members.groupBy("family").agg(F.count("*").alias("size"))
    left = kept(
        placed_index.join(open_tokens, "token").join(sizes, "family").select("token", "sig", "root", "family", "size")
    )
    hosts = left.select("token", F.col("family").alias("host"), F.col("size").alias("host_size")).distinct()
    probes = (
        left.join(hosts, "token")
        .where(F.struct("host_size", "host") > F.struct("size", "family"))
        .select("sig", "root", F.col("host").alias("family"))
        .distinct()
    )
    return first.union(_probed(sets, members, first, kept(probes)))


def _between_blocks(sets: DataFrame, members: DataFrame, within: DataFrame) -> DataFrame:
    """Links across the blocks of families that have several: sets outside the family's
    largest component probe all blocks."""
    split = kept(members.where("blocks > 1"))
    if not split.take(1):
        return within.limit(0)
    split = kept(_rooted(split, within))
    largest = (
        split.groupBy("family", "root")
        .count()
        .groupBy("family")
        .agg(F.max_by("root", F.struct("count", F.col("root"))).alias("largest"))
    )
    probes = split.join(largest, "family").where("root <> largest").select("sig", "root", "family")
    return _probed(sets, members, within, kept(probes))


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    roots = connected_components(links).withColumnRenamed("node", "sig")
    return members.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))


def _probed(sets: DataFrame, members: DataFrame, links: DataFrame, probes: DataFrame) -> DataFrame:
    """Links of ``probes(sig, root, family)`` with the sets of the families' blocks, in chunks
    of probes; sets already in one component need none."""
    chunks = kept(probes.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("chunks")))
    hosts = kept(_rooted(members.join(chunks, "family"), links))
    stored = hosts.select(
        "sig",
        "root",
        "family",
        "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("probe"),
    )
    blocks = hosts.select("family", "blocks", "chunks").distinct()
    probing = probes.join(blocks, "family").select(
        "sig",
        "root",
        "family",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64(F.lit(1), F.col("sig")), "chunks").alias("chunk"),
        F.lit(True).alias("probe"),
    )
    return (
        sets.join(stored.union(probing), "sig")
        .groupBy("family", "block", "chunk")
        .applyInPandas(_across_blocks, "a binary, b binary")
    )
