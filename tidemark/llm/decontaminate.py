"""Benchmark decontamination with DataFrame functions only.

Texts are lower-cased and cut into words (runs of letters and digits), so case and
punctuation don't hide a passage. A window of a document is as long as an item; at the
document's ends windows are cut. Window and item are alike when the exact weighted Jaccard
similarity of their shingles of five words, sum of the smaller over sum of the larger
occurrence counts, is ``THRESHOLD`` or more.

1. Where a document has an item's shingles is found by a join on their hashes. No more of a
   window's shingles can be shared than are hits, which bounds its similarity. The bound is
   greatest in a window that starts at a hit, or, cut by the start, ends at one; so if no
   such window has a bound of ``THRESHOLD``, none at any place is alike.
2. The window of the greatest bound gets a SimHash fingerprint, as the items have. Those of
   equal size and ``RADIUS`` differing bits at most are candidates: fingerprints are cut
   into ``RADIUS + 1`` blocks, of which such pairs have one in common, and joined by block.
   Candidates are verified by their exact similarity. A pair of similarity 0.75 can differ
   in more bits, so a window is verified against the item that laid it in any case.
3. A document whose best window fails for an item, though its bound would do, has windows at
   every place of sufficient bound tried in the same way: shingles repeated in one of
   the texts make bounds exceed similarities.

Hot passages: equal window texts are one row before they are fingerprinted, and no document
is paired with another.

Defined results: NULL, empty or blank texts and texts of fewer than five words match
nothing; items of fewer than five words are too short to tell a leak and match nothing.
Rows without doc_id or item_id are left out; repeated rows change nothing; the rows of
one doc_id count as documents of that id, and the texts of one item_id as items of that
id, of which the most similar counts. ``n_windows`` is how many places have the greatest
bound. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, kept, let

SHINGLE = 5
THRESHOLD = 0.75
#: Bits in which fingerprints of candidates differ at most.
BITS, RADIUS = 64, 15
#: Benchmark shingles that may be broadcast; beyond, the join shuffles.
MOST_BROADCAST = 1_000_000


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _shingle_at(words_: Column, start: Column) -> Column:
    return F.xxhash64(F.slice(words_, start + 1, SHINGLE))


def _shingles(words_: Column) -> Column:
    """The hash of the shingle at each place of ``words_``; none if it is too short."""
    last = F.size(words_) - SHINGLE
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: _shingle_at(words_, i))
    ).otherwise(F.array().cast("array<bigint>"))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, similarity, n_windows)`` for each document that has a window
    alike an item; ``documents(doc_id, text)``, ``benchmark(item_id, text)``."""
    documents = documents.where("doc_id IS NOT NULL").select("doc_id", "text")
    # an item is a distinct text, whichever ids it has
    named = kept(
        benchmark.where("item_id IS NOT NULL")
        .select("item_id", words(F.col("text")).alias("words"))
        .where(F.size("words") >= SHINGLE)
        .select("item_id", F.md5(F.concat_ws(" ", "words")).alias("item"), "words")
        .distinct()
    )
    items = kept(
        named.groupBy("item")
        .agg(F.first("words").alias("words"))
        .select("item", F.size("words").alias("size"), F.explode(_shingles(F.col("words"))).alias("h"))
        .groupBy("item", "size", "h")
        .agg(F.count("*").alias("times"))
    )
    places = kept(_places(documents, items))
    best = places.select("doc_id", "n_doc", "item", "size", "best", F.expr("array(-best.back)").alias("starts"))
    alike = kept(_alike(documents, best, items))
    failed = kept(places.join(alike, ["doc_id", "item"], "left_anti"))
    if not failed.isEmpty():
        every = failed.select("doc_id", "n_doc", "item", "size", "best", _every_start().alias("starts"))
        alike = kept(alike.union(_alike(documents, every, items)))
    windows = places.groupBy("doc_id", "item").agg(F.max("n_windows").alias("n_windows"))
    return (
        alike.join(windows, ["doc_id", "item"], "left")
        .join(named.select("item", "item_id"), "item")
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("similarity").alias("similarity"),
            F.max_by(F.coalesce("n_windows", F.lit(1)), "similarity").alias("n_windows"),
        )
    )


def _places(documents: DataFrame, items: DataFrame) -> DataFrame:
    """For each document and item that may be alike: the sorted places of the item's shingles
    (``hits``), the greatest bound and where it is (``best``), and how often."""
    sought = items.select("h", "item", "size")
    sought = broadcast_if_small(sought, items.count(), MOST_BROADCAST)
    m = F.col("size") - (SHINGLE - 1)
    found = (
        documents.select("doc_id", words(F.col("text")).alias("words"))
        .select(
            "doc_id",
            (F.size("words") - (SHINGLE - 1)).alias("n_doc"),
            F.posexplode(_shingles(F.col("words"))).alias("pos", "h"),
        )
        .join(sought, "h")
        .groupBy("doc_id", "n_doc", "item", "size")
        .agg(F.sort_array(F.collect_set("pos")).alias("hits"))
        # alike windows share three quarters of the item's shingles at least
        .where(4 * F.size("hits") >= 3 * m)
    )
    hits, n_doc = F.col("hits"), F.col("n_doc")

    def bound(shared: Column, n: Column, start: Column) -> Column:
        return F.struct((shared / (n + m - shared)).alias("bound"), (-start).alias("back"))

    def up_to(place: Column) -> Column:
        """How many hits are at ``place`` or before, by halving."""
        return F.aggregate(
            F.array(*[F.lit(1 << k) for k in reversed(range(30))]),
            F.lit(0),
            lambda n, step: n
            + F.when((n + step <= F.size(hits)) & (F.get(hits, n + step - 1) <= place), step).otherwise(0),
        )

    from_hit = F.transform(hits, lambda h, i: bound(up_to(h + m - 1) - i, F.least(m, n_doc - h), h))
    to_hit = F.transform(F.filter(hits, lambda h: h + 1 < m), lambda h, i: bound(i + 1, h + 1, h - m + 1))
    def greatest(bounds: Column) -> Column:
        return let(
            F.array_max(bounds),
            lambda best: F.struct(
                best["bound"].alias("bound"),
                best["back"].alias("back"),
                F.size(F.filter(bounds, lambda b: b["bound"] == best["bound"])).cast("long").alias("n_windows"),
            ),
        )

    best = kept(found.withColumn("best", let(F.concat(from_hit, to_hit), greatest)))
    return best.where(F.col("best.bound") >= THRESHOLD).withColumn("n_windows", F.col("best.n_windows"))


def _every_start() -> Column:
    """All starts of windows with three quarters of an item's shingles in hits: for each hit
    those of which it is the first."""
    hits, m = F.col("hits"), F.col("size") - (SHINGLE - 1)
    need = F.ceil(3 * m / 4).cast("int")

    def starts(h: Column, i: Column) -> Column:
        least = F.greatest(F.coalesce(F.get(hits, i - 1) + 1, h - m + 1), F.get(hits, i + need - 1) - m + 1)
        return F.when((i + need <= F.size(hits)) & (least <= h), F.sequence(least, h)).otherwise(
            F.array().cast("array<int>")
        )

    return F.flatten(F.transform(hits, starts))


def _alike(documents: DataFrame, starts: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item, similarity)`` of alike windows that begin at one of ``starts``."""
    start, size = F.col("start"), F.col("size")
    first = F.greatest(start, F.lit(0))
    cut = F.slice(F.col("words"), first + 1, start + size - first)
    members = kept(
        documents.join(starts.drop("best"), "doc_id")
        .select("doc_id", words(F.col("text")).alias("words"), "n_doc", "item", "size", "starts")
        # no equality, which would be a key of the join, and have all documents cut into words
        .where((F.size("words") - (SHINGLE - 1)).between(F.col("n_doc"), F.col("n_doc")))
        .select("doc_id", "words", "item", "size", F.explode("starts").alias("start"))
        .select("doc_id", "item", "size", cut.alias("cut"))
        .withColumn("content", F.md5(F.concat_ws(" ", F.col("size").cast("string"), F.concat_ws(" ", "cut"))))
    )
    windows = kept(
        members.groupBy("content", "size")
        .agg(F.first("cut").alias("cut"))
        .select("content", "size", F.explode(_shingles(F.col("cut"))).alias("h"))
        .groupBy("content", "size", "h")
        .agg(F.count("*").alias("times"))
    )
    own = members.select("content", "item").distinct()
    verified = kept(_verified(windows, items, _candidates(windows, items).union(own).distinct()))
    return (
        members.select("doc_id", "content")
        .distinct()
        .join(verified, "content")
        .groupBy("doc_id", "item")
        .agg(F.max("similarity").alias("similarity"))
    )


def _fingerprints(counts: DataFrame, name: str) -> DataFrame:
    """``(name, size, fp)``: a bit is 1 if more than half of all shingle occurrences have it.
    Two counts share a long, 32 bits each."""
    half = BITS // 2
    lanes = [
        F.sum(F.col("times") * (_bit(F.col("h"), k) + F.shiftleft(_bit(F.col("h"), k + half), 32))).alias(f"lane_{k}")
        for k in range(half)
    ]
    sums = counts.groupBy(name, "size").agg(F.sum("times").alias("all"), *lanes)
    fp = F.lit(0).cast("long")
    for k in range(half):
        lane = F.col(f"lane_{k}")
        for bit, ones in ((k, lane.bitwiseAND(F.lit((1 << 32) - 1))), (k + half, F.shiftrightunsigned(lane, 32))):
            fp = fp.bitwiseOR(F.shiftleft((2 * ones > F.col("all")).cast("long"), bit))
    return sums.select(name, "size", fp.alias("fp"))


def _bit(value: Column, k: int) -> Column:
    return F.shiftrightunsigned(value, k).bitwiseAND(F.lit(1).cast("long"))


def _in_blocks(prints: DataFrame, name: str) -> DataFrame:
    """A row per block of a fingerprint."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    blocks = [
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned("fp", edges[k]).bitwiseAND(F.lit((1 << edges[k + 1] - edges[k]) - 1)).alias("bits"),
        )
        for k in range(RADIUS + 1)
    ]
    return prints.select(name, "size", F.col("fp").alias(f"{name}_fp"), F.explode(F.array(*blocks)).alias("at")).select(
        name, "size", f"{name}_fp", "at.block", "at.bits"
    )


def _candidates(windows: DataFrame, items: DataFrame) -> DataFrame:
    """``(content, item)`` of equal size whose fingerprints are within ``RADIUS``."""
    ours = _in_blocks(kept(_fingerprints(windows, "content")), "content")
    theirs = kept(_in_blocks(_fingerprints(items, "item"), "item"))
    theirs = broadcast_if_small(theirs, theirs.count(), MOST_BROADCAST)
    near = F.bit_count(F.col("content_fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    return ours.join(theirs, ["size", "block", "bits"]).where(near).select("content", "item").distinct()


def _verified(windows: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(content, item, similarity)`` of the pairs of enough similarity."""
    ours = windows.groupBy("content").agg(F.sum("times").alias("n"))
    theirs = items.groupBy("item").agg(F.sum("times").alias("m"))
    both = (
        pairs.join(windows.select("content", "h", "times"), "content")
        .join(items.select("item", "h", F.col("times").alias("item_times")), ["item", "h"])
        .groupBy("content", "item")
        .agg(F.sum(F.least("times", "item_times")).alias("shared"))
        .join(ours, "content")
        .join(theirs, "item")
    )
    similarity = F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))
    return (
        both.withColumn("similarity", similarity)
        .where(F.col("similarity") >= THRESHOLD)
        .select("content", "item", "similarity")
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that leak an item. Rows without doc_id stay."""
    leaking = leaks(documents, benchmark).select("doc_id").distinct()
    return documents.join(leaking, "doc_id", "left_anti").select(documents.columns)
