"""Mixing sources to target weights by weighted sampling without replacement.

Sources share a budget of words by weight; a target stops at ``MOST_EPOCHS`` times its
source's size, and the excess goes to the others by weight until none is above. A source
gives as many complete epochs as its target holds; the fraction that is left is drawn by
exponential keys, ``-ln(u) / quality`` with ``u`` a hash of doc_id, text and source: documents
in ascending order of key, until the prefix sum of their sizes comes nearest to the rest of
the target. The quality is a weight the caller gives, such as a classifier's score; by
default the share of words that end in a letter, or in one and a mark of punctuation, which
numbers, codes and strings of symbols do not.

No source is sorted as a whole: sizes are summed by source and key range, the range the
rest of the target ends in is found from these sums, and only that range is sorted.

Rows equal in doc_id, text and source are one group with a count until the end, so any
number of them is cut to the number to take, and only those of a group that is taken in
part are numbered, within the partitions they lie in.

Defined results: NULL or blank texts have size 0 and take no words; a NULL source is a
source of its own, the last; of equal rows any are taken, as many as brings the sum
nearest; rows without doc_id are drawn by their texts; an empty table gives an empty mix.
Other columns are kept; those with the result's names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, kept, word_count

#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's size as a share of all words.
SHARE = 1.5
MOST_EPOCHS = 2
#: Sources whose shares may be broadcast; beyond, the join shuffles.
MOST_BROADCAST = 100_000
#: A word's end that prose has. Words of other letters than ASCII count as letters.
PROSE = r"[^\x00-\x40\x5B-\x60\x7B-\x7F][.,;:!?]?([\x20\x09-\x0D]|\z)"
LEAST_QUALITY = 0.05


def prose_share(text: Column) -> Column:
    """The share of words that end as prose does."""
    return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(PROSE)), word_count(text)), F.lit(0.0))


def _digest() -> Column:
    """What tells rows apart."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source")]
    return F.md5(F.concat_ws("|", parts[0], F.md5(F.coalesce(F.col("text"), F.lit(""))), parts[1]))


def sampling_key(digest: Column, quality: Column) -> Column:
    """The exponential key, the same in every run."""
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.ln(uniform) / F.greatest(F.lit(LEAST_QUALITY), quality)


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source, source_size, n)``, a row per source, with ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place") % len(WEIGHTS) + 1)
    most = MOST_EPOCHS * F.col("source_size")
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    rows = rows.withColumn("ratio", most / F.col("weight"))
    # Sources fill up in the order of size over weight.
    filling = Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    budget = SHARE * F.sum("source_size").over(everything)
    full_before = F.coalesce(F.sum(most).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (budget - full_before) / weight_left)
    # the first that doesn't fill up sets the level of all that don't
    first = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(everything)
    share = F.coalesce(first["level"] * F.col("weight"), most.cast("double"))
    return rows.withColumn("target", F.least(most.cast("double"), share)).select(
        "source", "source_size", "n", "target"
    )


_RESULT = ("size", "source_size", "target", "taken")


def _keyed(documents: DataFrame, quality: Column | None) -> DataFrame:
    """``documents`` with ``_size``, ``_digest`` and ``_key``."""
    weight = prose_share(F.col("text")) if quality is None else quality
    rows = documents.withColumns({"_size": word_count(F.col("text")), "_digest": _digest(), "_weight": weight})
    return rows.withColumn("_key", sampling_key(F.col("_digest"), F.col("_weight"))).drop("_weight")


def mix(documents: DataFrame, quality: Column | None = None) -> DataFrame:
    """``documents(doc_id, text, source, ...)`` with size, source_size, target and taken."""
    rows = _keyed(documents, quality)
    plan = _cut(kept(rows.select("source", "_size", "_digest", "_key")))
    columns = [c for c in documents.columns if c not in _RESULT]
    return _taken(rows, plan).select(*columns, *_RESULT)


def mixed_sizes(documents: DataFrame, quality: Column | None = None) -> DataFrame:
    """The mix without the texts: doc_id, size, source_size, target, taken."""
    narrow = kept(_keyed(documents, quality).select("doc_id", "source", "_size", "_digest", "_key"))
    return _taken(narrow, _cut(narrow)).select("doc_id", *_RESULT)


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    plan = kept(plan)
    small = broadcast_if_small(plan, plan.count(), MOST_BROADCAST)
    joined = rows.drop(*_RESULT).join(small, F.col("source").eqNullSafe(F.col("plan_source")), "left")
    here = F.struct(F.col("_key").alias("key"), F.col("_digest").alias("digest"))
    drawn = F.coalesce(here <= F.col("last"), F.lit(False)).cast("long")
    if plan.where("part_copies > 0").isEmpty():
        joined = joined.withColumn("_drawn", drawn)
    else:
        parted = F.coalesce(F.col("_digest") == F.col("part_digest"), F.lit(False))
        some = _numbered(joined.where(parted)).withColumn("_drawn", (F.col("_place") < F.col("part_copies")).cast("long"))
        joined = joined.where(~parted).withColumn("_drawn", drawn).unionByName(some.drop("_place"))
    taken = F.col("_size") * (F.col("epochs") + F.col("_drawn"))
    return joined.withColumn("taken", taken).withColumn("size", F.col("_size"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_place``, from 0 in each group of equal rows: the place in a
    partition, plus the rows of the group in the partitions before."""
    found = kept(rows.withColumn("_id", F.monotonically_increasing_id())).withColumn("_partition", F.shiftright("_id", 33))
    inside = Window.partitionBy("plan_source", "_digest", "_partition").orderBy("_id")
    before = Window.partitionBy("of_source", "of_digest").orderBy("of_partition")
    counts = found.groupBy(
        F.col("plan_source").alias("of_source"), F.col("_digest").alias("of_digest"), F.col("_partition").alias("of_partition")
    ).agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_before", F.sum("_rows").over(before) - F.col("_rows"))
    same = [
        F.col("plan_source").eqNullSafe(F.col("of_source")),
        F.col("_digest") == F.col("of_digest"),
        F.col("_partition") == F.col("of_partition"),
    ]
    placed = found.join(counts, same).withColumn("_place", F.row_number().over(inside) - 1 + F.col("_before"))
    return placed.drop("_id", "_partition", "_rows", "_before", "of_source", "of_digest", "of_partition")


def _cut(narrow: DataFrame) -> DataFrame:
    """For each source its size, target, complete epochs, the last group of equal rows that
    is drawn, and the group that is drawn in part, with the number of its rows to draw."""
    sizes = narrow.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(sizes)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = kept(
        plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn(
            "ranges", 4 * F.ceil(F.sqrt("n"))
        )
    )
    groups = (
        narrow.where("_size > 0")
        .groupBy("source", F.col("_key").alias("key"), F.col("_digest").alias("digest"), F.col("_size").alias("size"))
        .agg(F.count("*").alias("copies"))
    )
    of = plan.select(F.col("source").alias("of_source"), "rest", "ranges")
    part = F.floor(F.col("ranges") * (F.col("key") / (1 + F.col("key")))).cast("long")
    rows = kept(groups).join(of, F.col("source").eqNullSafe(F.col("of_source")))
    rows = rows.withColumns({"part": part, "words": F.col("size") * F.col("copies")})
    place = F.struct("key", "digest")
    by_source = Window.partitionBy("of_source").orderBy("part")
    parts = (
        rows.groupBy("of_source", "rest", "part")
        .agg(F.sum("words").alias("words"), F.max(place).alias("last"))
        .withColumn("until", F.sum("words").over(by_source.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("until") - F.col("words"))
    )
    parts = kept(parts.where("before < rest"))
    none = F.lit(None).cast("string").alias("part_digest"), F.lit(0).cast("long").alias("part_copies")
    whole = parts.where("until <= rest").select("of_source", "last", *none)
    ends = parts.where("until > rest").select(
        F.col("of_source").alias("end_source"), F.col("part").alias("end_part"), "before"
    )
    in_order = Window.partitionBy("of_source").orderBy("key", "digest")
    # a row is drawn if that brings the sum nearer to what is left
    left = F.col("rest") - F.col("before") - F.col("within")
    copies = F.least(F.col("copies"), F.floor((2 * left - F.col("size")) / (2 * F.col("size"))) + 1)
    inside = (
        rows.join(
            ends,
            F.col("of_source").eqNullSafe(F.col("end_source")) & (F.col("part") == F.col("end_part")),
        )
        .withColumn("within", F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        .withColumn("drawn", copies.cast("long"))
        .where("drawn > 0")
    )
    all_drawn = F.col("drawn") == F.col("copies")
    inside = inside.select(
        "of_source",
        F.when(all_drawn, place).alias("last"),
        F.when(~all_drawn, F.col("digest")).alias("part_digest"),
        F.when(~all_drawn, F.col("drawn")).otherwise(0).alias("part_copies"),
    )
    last = whole.union(inside).groupBy("of_source").agg(
        F.max("last").alias("last"), F.max("part_digest").alias("part_digest"), F.max("part_copies").alias("part_copies")
    )
    return plan.join(last, F.col("source").eqNullSafe(F.col("of_source")), "left").select(
        F.col("source").alias("plan_source"), "source_size", "target", "epochs", "last", "part_digest",
        F.coalesce("part_copies", F.lit(0)).alias("part_copies"),
    )


SQL = r"""
WITH told AS (
  SELECT doc_id, source, text,
    md5(coalesce(cast(doc_id AS varchar), '') || '|' || md5(coalesce(text, '')) || '|' || coalesce(source, '')) AS digest,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size
  FROM documents
),
docs AS (
  SELECT doc_id, source, digest, size,
    -ln((cast('0x' || substr(digest, 1, 13) AS bigint) + 0.5::double) / 4503599627370496.0::double)
      / greatest(0.05::double, coalesce(len(regexp_extract_all(text,
          '[^\x00-\x40\x5B-\x60\x7B-\x7F][.,;:!?]?([\x20\x09-\x0D]|\z)')) / nullif(size, 0)::double, 0.0::double)) AS key
  FROM told
),
sizes AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM docs GROUP BY source
),
weighted AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sizes
),
ratios AS (SELECT *, 2 * source_size / weight::double AS ratio FROM weighted),
levels AS (
  SELECT *, (1.5::double * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, place
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double)
    / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::double AS level
  FROM ratios
),
target AS (
  SELECT source, source_size, least(2.0::double * source_size,
    coalesce((min(CASE WHEN ratio > level THEN {'r': ratio, 'p': place, 'l': level} END) OVER ()).l * weight,
      2.0::double * source_size)) AS target
  FROM levels
),
epoch AS (
  SELECT *, CASE WHEN source_size > 0 THEN cast(floor(target / source_size) AS bigint) ELSE 0 END AS epochs
  FROM target
),
placed AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.digest ROWS UNBOUNDED PRECEDING) AS until
  FROM docs d JOIN epoch e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  cast(size * (epochs + CASE WHEN 2 * (until - size) + size <= 2 * rest THEN 1 ELSE 0 END) AS bigint) AS taken
FROM placed
"""
