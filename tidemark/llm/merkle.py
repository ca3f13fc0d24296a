"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Rows are leaves. The leaves of a group, in order, are hashed in runs of three to a
subroot, and the subroots of all groups, in order of the group, likewise to the root.

1. Leaves are numbered by sorting them into ranges; a row's place is its place in its range
   plus the sizes of the ranges before, so a group that holds a third of all rows is
   spread over many tasks.
2. Trees are built in blocks of ``3 ** LEVELS`` consecutive nodes. Runs never reach over a
   block's ends, so a block's nodes are hashed without looking at others, and its top is
   one node of the next round.
3. Every node knows its parent and the hashes of its siblings: a segment of the way to the
   root. Joining this table with itself, on the ancestor that each segment reaches, doubles
   the distance and concatenates the segments, until every leaf's segment reaches the root.
   After the round that makes segments of ``d`` levels, only nodes at multiples of ``d``
   are asked for again, so the table joined shrinks by ``3 ** d``.
4. A proof folds to a root: the hash is joined with the siblings of each level in turn.

A digest is the lowercase hex SHA-256 of its inputs, concatenated, digests as hex text. A
leaf's inputs are its fields, each ``-`` if NULL, else its length in UTF-8 bytes, ``:`` and
its text.

Defined results: rows without doc_id come first in their source, and rows of one doc_id in
the order of their leaves; repeated rows are leaves each. NULL is a source of its own, the
first. NULL text is not empty text. Rows without doc_id are not tampered with. A source of
one row has its leaf as subroot, a table of one source its subroot as root, and both then
an empty proof, whose digest is that of no input. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, buckets_for, join_one_each, kept

#: Nodes of a run.
FAN = 3
#: Levels built at once.
LEVELS = 6
WIDTH = FAN**LEVELS
#: Input bytes of a range of leaves.
RANGE_BYTES = 8 << 20
#: Bytes of segments that may be broadcast; beyond, the join shuffles.
MOST_BROADCAST = 8 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PLACE_BITS = 33  # of monotonically_increasing_id, for the row within its partition


def _inputs(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(_inputs, fields)), 256)


def without_newlines(documents: DataFrame) -> Column:
    """The tampered text: of every document whose id's CRC-32 is even, newlines go."""
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    return F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def manifest(
    documents: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """``(order, leaf, subroot, root, proof, changed)`` for each row: its digests, the
    siblings on its way to the root as one hex text, ``moves``, a digit per level that
    tells its place among them, and ``changed``, the leaf with ``tampered`` columns."""
    plain = [F.col(f) for f in fields]
    other = [(tampered or {}).get(f, F.col(f)) for f in fields]
    rows = documents.select(
        F.col(group).alias("grp"), F.col(order).alias("id"), leaf(*plain).alias("leaf"), leaf(*other).alias("changed")
    )
    leaves = kept(_numbered(kept(rows)))
    steps, tops = _trees(leaves)
    # the tree over the groups' subroots, whose leaves are in the order of the groups
    over = kept(
        tops.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(tops.count()).alias("n"),
            F.col("hash").alias("leaf"),
        )
    )
    over_steps, over_top = _trees(over)
    heads = (
        _proved(over, over_steps, _deepest(over))
        .join(F.broadcast(over_top.select("tree", F.col("hash").alias("root"))), "tree")
        .select(
            F.col("at").alias("tree"), F.col("leaf").alias("subroot"), "root",
            F.col("seg").alias("top_seg"), F.col("moves").alias("top_moves"),
        )
    )
    whole = join_one_each(_proved(leaves, steps, _deepest(leaves)), kept(heads), "tree")
    return whole.select(
        F.col("id").alias(order), "leaf", "subroot", "root", "changed",
        F.lower(F.hex(F.concat("seg", "top_seg"))).alias("proof"),
        F.concat("moves", "top_moves").alias("moves"),
    )


def tamper_report(documents: DataFrame) -> DataFrame:
    """Proof digests, and the root that each row gives after the tampering."""
    rows = manifest(documents, tampered={"text": without_newlines(documents)})
    again = folded(F.col("changed"), F.col("proof"), F.col("moves"))
    return (
        rows.withColumn("folded_root", again)
        .withColumn("proof_sha256", F.sha2("proof", 256))
        .select(
            "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def folded(hash_: Column, proof: Column, moves: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(state: Column, level: Column) -> Column:
        move = F.substring(moves, level, 1).cast("int")
        # moves count a lone node, the two of a pair, the three of a run
        size = F.when(move >= 3, 3).when(move >= 1, 2).otherwise(1)
        place = move - F.when(move >= 3, 3).when(move >= 1, 1).otherwise(0)
        left = F.substring(proof, state["next"], 64 * place)
        right = F.substring(proof, state["next"] + 64 * place, 64 * (size - 1 - place))
        joined = F.sha2(F.concat(left, state["hash"], right), 256)
        return F.struct(joined.alias("hash"), (state["next"] + 64 * (size - 1)).alias("next"))

    start = F.struct(hash_.alias("hash"), F.lit(1).alias("next"))
    levels = F.when(F.length(moves) > 0, F.sequence(F.lit(1), F.length(moves))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, start, up, lambda state: state["hash"])


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows(grp, id, leaf, changed)`` with ``tree``, the group's place, ``at``, the row's
    place in its group, and ``n``, the group's size."""
    ranges = buckets_for(rows, RANGE_BYTES)
    # The last key tells equal rows apart, so that any number of them can be cut.
    order = [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("copy")]
    dealt = kept(
        rows.withColumn("copy", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .drop("copy")
        .withColumn("row", F.monotonically_increasing_id())
    )
    part = F.shiftright("row", _PLACE_BITS).cast("int").alias("part")
    runs = kept(dealt.groupBy("grp", part).agg(F.min("row").alias("first"), F.count("*").alias("rows")))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.groupBy("grp").agg(F.sum("rows").alias("n"))
    trees = kept(_places(sizes))
    places = kept(
        runs.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .join(trees.select(F.col("grp").alias("of"), "tree", "n"), F.col("grp").eqNullSafe(F.col("of")))
        .select(F.col("part"), "tree", "n", (F.col("before") - F.col("first")).alias("shift"), F.col("grp").alias("of"))
    )
    places = broadcast_if_small(places, places.count(), 100_000)
    same = F.col("grp").eqNullSafe(F.col("of")) & (F.col("here") == F.col("part"))
    here = F.shiftright("row", _PLACE_BITS).cast("int")
    return dealt.withColumn("here", here).join(places, same).select(
        "tree", (F.col("row") + F.col("shift")).alias("at"), "n", "grp", "id", "leaf", "changed"
    )


def _places(sizes: DataFrame) -> DataFrame:
    """The groups with ``tree``, their place by name, NULL first."""
    ranges = buckets_for(sizes, RANGE_BYTES)
    order = F.col("grp").asc_nulls_first()
    dealt = kept(
        sizes.repartitionByRange(ranges, order).sortWithinPartitions(order)
        .withColumn("row", F.monotonically_increasing_id())
    )
    part = F.shiftright("row", _PLACE_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy(part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    runs = runs.select("part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(F.broadcast(runs), part == F.col("part")).select(
        "grp", "n", (F.col("row") + F.col("shift")).alias("tree")
    )


def _deepest(leaves: DataFrame) -> int:
    return leaves.agg(F.max(_depth(F.col("n")))).first()[0] or 0


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``; 3 ** 39 is beyond 2 ** 62."""
    levels = F.array(*[F.lit(FAN**k) for k in range(40) if FAN**k < 1 << 62])
    return F.size(F.filter(levels, lambda most: most < n))


def _trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of all trees over ``leaves(tree, at, n, leaf)``, the step from every node to its parent,
    ``(tree, level, at, seg, moves)``, and the root, ``(tree, hash)``."""
    nodes = leaves.select("tree", "at", "n", F.col("leaf").alias("hash"))
    steps, tops, base = [], [], 0
    while True:
        blocks = kept(_blocks(nodes, base))
        steps.append(blocks.select("tree", F.explode("steps").alias("step")).select("tree", "step.*"))
        tops.append(blocks.where(F.col("n") <= WIDTH).select("tree", "hash"))
        nodes = blocks.where(F.col("n") > WIDTH).select(
            "tree", F.col("block").alias("at"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"), "hash"
        )
        base += LEVELS
        if nodes.isEmpty():
            return reduce(DataFrame.union, steps), reduce(DataFrame.union, tops)


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """``(tree, n, block, steps, hash)`` for each block of nodes of one level, ``base``: the
    steps up within it, as far as its tree goes, and the hash of its top."""
    rows = (
        nodes.groupBy("tree", "n", F.expr(f"at div {WIDTH}").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("nodes"))
        .withColumn("level_0", F.transform("nodes", lambda node: node["hash"]))
        .withColumn("climb", F.when(F.col("n") > WIDTH, LEVELS).otherwise(_depth(F.col("n"))))
    )
    none = F.array().cast("array<struct<level:int,at:bigint,seg:binary,moves:string>>")
    for up in range(LEVELS):
        here, more = F.col(f"level_{up}"), F.col("climb") > up
        runs = F.sequence(F.lit(0), F.expr(f"cast((size(level_{up}) + {FAN - 1}) div {FAN} - 1 as int)"))
        rows = rows.withColumn(
            f"steps_{up}", F.when(more, F.transform(here, _step(here, base, up))).otherwise(none)
        ).withColumn(f"level_{up + 1}", F.when(more, F.transform(runs, _joined(here))).otherwise(here))
    return rows.select(
        "tree", "n", "block",
        F.concat(*[f"steps_{up}" for up in range(LEVELS)]).alias("steps"),
        F.col(f"level_{LEVELS}")[0].alias("hash"),
    )


def _step(here: Column, base: int, up: int) -> Callable[[Column, Column], Column]:
    """The step to its parent of the node at place ``i`` of ``here``."""

    def step(_hash: Column, i: Column) -> Column:
        place = i % FAN
        run = F.slice(here, i - place + 1, FAN)
        others = F.array_join(F.filter(run, lambda _, k: k != place), "")
        move = place + F.when(F.size(run) == 3, 3).when(F.size(run) == 2, 1).otherwise(0)
        return F.struct(
            F.lit(base + up).alias("level"),
            (F.col("block") * FAN ** (LEVELS - up) + i).alias("at"),
            F.unhex(others).alias("seg"),
            move.cast("string").alias("moves"),
        )

    return step


def _joined(here: Column) -> Callable[[Column], Column]:
    """The hash of run ``i`` of ``here``."""
    return lambda i: F.sha2(F.array_join(F.slice(here, i * FAN + 1, FAN), ""), 256)


def _proved(leaves: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    """``leaves`` with ``seg`` and ``moves`` of the whole way to the root of their tree."""
    own = steps.where("level = 0").drop("level")
    empty = [F.coalesce("seg", F.lit(b"")).alias("seg"), F.coalesce("moves", F.lit("")).alias("moves")]
    rows = leaves.join(own, ["tree", "at"], "left").select(*leaves.columns, *empty)
    nodes = steps.where("level > 0")
    reach = 1
    while reach < depth:
        rows = _lengthened(rows, nodes.where(F.col("level") == reach), reach, F.lit(reach))
        asked = nodes.where(F.col("level") % (2 * reach) == 0)
        above = nodes.where(F.col("level") % (2 * reach) == reach)
        nodes = kept(_lengthened(asked, above, reach, F.col("level") + reach))
        reach *= 2
    return rows


def _lengthened(rows: DataFrame, above: DataFrame, reach: int, level: Column) -> DataFrame:
    """Segments of ``reach`` levels with those of the ancestors that they reach. No more than
    ``3 ** reach`` rows reach one ancestor, and where these are many the ancestors are few."""
    above = above.select(
        F.col("tree").alias("a_tree"), F.col("level").alias("a_level"), F.col("at").alias("a_at"),
        F.col("seg").alias("a_seg"), F.col("moves").alias("a_moves"),
    )
    above = broadcast_if_small(above, above.count(), MOST_BROADCAST // (64 * reach + 64))
    ancestor = F.expr(f"at div {FAN**reach}") if FAN**reach < 1 << 63 else F.lit(0)
    same = (F.col("tree") == F.col("a_tree")) & (level == F.col("a_level")) & (ancestor == F.col("a_at"))
    changed = {
        "seg": F.concat("seg", F.coalesce("a_seg", F.lit(b""))),
        "moves": F.concat("moves", F.coalesce("a_moves", F.lit(""))),
    }
    joined = rows.join(above, same, "left")
    return joined.select(*[changed[c].alias(c) if c in changed else c for c in rows.columns])


_PLAIN, _TAMPERED = (
    " || ".join(
        f"coalesce(cast(strlen({v}) AS varchar) || ':' || {v}, '-')"
        for v in (f"cast({f} AS varchar)" if f != "text" else text for f in FIELDS)
    )
    for text in ("text", "replace(text, chr(10), '')")
)

SQL = f"""
WITH RECURSIVE crc_byte AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8),
      lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b))
),
docs AS (
  SELECT doc_id, source, sha256({_PLAIN}) AS leaf,
    CASE WHEN xor(list_reduce(
        list_transform(string_split(cast(doc_id AS varchar), ''), lambda d: cast(ascii(d) AS bigint)),
        lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1]), 4294967295), 4294967295) % 2 = 0
      THEN sha256({_TAMPERED}) ELSE sha256({_PLAIN}) END AS changed
  FROM documents, crc_byte
),
leaves AS (
  SELECT doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM docs
),
nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 3, n
),
subroots AS (SELECT tree, h AS subroot, count(*) OVER () AS n FROM nodes WHERE n = 1),
over AS (
  SELECT 0 AS level, tree AS pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM over WHERE n > 1 GROUP BY level, pos // 3, n
),
everything AS (SELECT tree, level, pos, h FROM nodes UNION ALL SELECT -1, level, pos, h FROM over),
steps AS (
  SELECT a.tree, a.level, a.pos,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') || '|'
      || coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS step
  FROM everything a JOIN everything b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  GROUP BY a.tree, a.level, a.pos
),
depths AS (SELECT tree, max(level) AS depth FROM everything GROUP BY tree),
ways AS (
  SELECT l.tree, l.pos, list(s.step ORDER BY s.tree DESC, s.level) AS way
  FROM leaves l JOIN steps s
    ON (s.tree = l.tree AND s.pos = l.pos // cast(pow(3, s.level) AS bigint))
    OR (s.tree = -1 AND s.pos = l.tree // cast(pow(3, s.level) AS bigint))
  JOIN depths d ON d.tree = s.tree AND s.level < d.depth
  GROUP BY l.tree, l.pos
),
results AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM over WHERE n = 1) AS root,
    sha256(replace(array_to_string(coalesce(way, []), ''), '|', '')) AS proof_sha256,
    list_reduce(coalesce(way, []),
      lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), changed) AS folded_root
  FROM leaves JOIN subroots USING (tree) LEFT JOIN ways USING (tree, pos)
)
SELECT *, folded_root = root AS verified FROM results
"""
