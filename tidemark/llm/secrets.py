"""Secret scans with DataFrame functions only.

Three rules give the base spans: assignments, access keys and hexadecimal runs. Beyond
them, two first-order Markov models over characters tell random strings from ordinary
identifiers: a run of ``CANDIDATE`` is a secret if the mean log-likelihood ratio of its
transitions is over ``LEAST_RATIO``. The models are trained from labelled samples:
identifiers of ``SAMPLE_DOCUMENTS`` documents that match no rule, and as many random
strings, digests in base 16 and 64. Each model is a table over pairs of ``ALPHABET``, so
its size is fixed.

Spans are in code points, end exclusive. Matches of a pattern lie between the pieces
that the pattern splits the text into, so their places are sums of lengths.

Defined results: NULL and empty texts have no spans; base_sha256 is then that of the
empty string. Without any identifier to learn from, that model is uniform. Repeated rows
and equal doc_ids are scanned each. Ties in start follow the order of ``KINDS``. Other
columns are kept; those with the result's names are replaced.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: The shortest assigned value.
ASSIGNED = 12
# Runs are maximal, so the least length can be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9_-]{8,}"
SAMPLE_DOCUMENTS = 2000
#: Mean log-likelihood ratio per transition, in nats, from which a run is random.
LEAST_RATIO = 0.0
MASK = "[SECRET]"

#: What every span has in it, and places that none reaches over: after a character of no
#: pattern, and after a single space that is not beside an assignment's sign.
ANY = f"{ASSIGN}|{CANDIDATE}|{ACCESS}|{HEX}"
CUT = r"""(?<=[^A-Za-z0-9+/_.=\-"':\x20])|(?<=[^:=\x20]\x20)(?=[^:=\x20])"""

_SIZE = len(ALPHABET) + 1  # place 0 is any other character
_SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _sums_before(lengths: Column) -> Column:
    """For each place of a non-empty array, the sum of the places before. In blocks of the
    root of its size, as appending to an array copies it."""

    def add(state: Column, length: Column) -> Column:
        return F.struct(
            (state["sum"] + length).alias("sum"), F.concat(state["sums"], F.array(state["sum"])).alias("sums")
        )

    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("sums"))

    def in_blocks(width: Column) -> Column:
        last = F.floor((F.size(lengths) - 1) / width).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), last),
            lambda b: F.aggregate(F.slice(lengths, b * width + 1, width), start, add),
        )
        return let(blocks, shifted)

    def shifted(blocks: Column) -> Column:
        offsets = F.aggregate(F.transform(blocks, lambda block: block["sum"]), start, add, lambda state: state["sums"])
        return F.flatten(
            F.zip_with(blocks, offsets, lambda block, offset: F.transform(block["sums"], lambda n: n + offset))
        )

    return let(F.ceil(F.sqrt(F.size(lengths).cast("double"))).cast("int"), in_blocks)


def _spans(
    text: Column, pattern: str, kind: int, group: int = 0, keep: Callable[[Column], Column] | None = None
) -> Column:
    """The spans of the matches of which ``keep`` holds for ``group``."""
    pieces = F.split(text, pattern, -1)

    def placed(matches: Column) -> Column:
        checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        rows = F.zip_with(
            F.zip_with(matches, checked, lambda m, c: F.struct(F.char_length(m).alias("length"), c.alias("value"))),
            F.slice(pieces, 1, F.size(matches)),
            lambda match, piece: F.struct(
                F.char_length(piece).alias("gap"), match["length"].alias("length"), match["value"].alias("value")
            ),
        )
        return let(rows, summed)

    def summed(rows: Column) -> Column:
        return let(
            _sums_before(F.transform(rows, lambda row: row["gap"] + row["length"])), lambda before: found(rows, before)
        )

    def found(rows: Column, before: Column) -> Column:
        spans = F.zip_with(
            rows,
            before,
            lambda row, at: F.struct(
                F.struct(
                    (at + row["gap"]).alias("start"),
                    F.lit(kind).alias("kind"),
                    (at + row["gap"] + row["length"]).alias("stop"),
                ).alias("span"),
                (keep(row["value"]) if keep else F.lit(True)).alias("kept"),
            ),
        )
        return F.transform(F.filter(spans, lambda s: s["kept"]), lambda s: s["span"])

    everything = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(text.rlike(pattern), everything).otherwise(F.array().cast(_SPAN))


def _class(character: Column) -> Column:
    return F.instr(F.lit(ALPHABET), character)


def train(documents: DataFrame) -> list[float]:
    """The log-likelihood ratio of each transition, random over ordinary."""
    chosen = (
        documents.where("doc_id IS NOT NULL")
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCUMENTS)
    )
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ordinary = (
        sample.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("token"))
        .where(~F.col("token").rlike(HEX) & ~F.col("token").rlike(ACCESS) & ~F.col("token").rlike("[0-9]{6,}"))
        .select(F.lit(0).alias("label"), "token")
    )
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = documents.sparkSession.range(SAMPLE_DOCUMENTS).select(
        F.lit(1).alias("label"), F.explode(F.array(digest, F.base64(F.unhex(digest)))).alias("token")
    )
    place = F.col("place")
    code = _SIZE * _class(F.substring("token", place, F.lit(1))) + _class(F.substring("token", place + 1, F.lit(1)))
    counts = (
        ordinary.union(random)
        .where(F.length("token") > 1)
        .select("label", "token", F.explode(F.expr("sequence(1, length(token) - 1)")).alias("place"))
        .groupBy("label", code.alias("code"))
        .count()
        .collect()  # at most two rows for each pair of the alphabet
    )
    tables = [[[1.0] * _SIZE for _ in range(_SIZE)] for _ in range(2)]  # smoothed by one
    for row in counts:
        tables[row["label"]][row["code"] // _SIZE][row["code"] % _SIZE] += row["count"]
    logs = [[[math.log(n / sum(line)) for n in line] for line in table] for table in tables]
    return [logs[1][a][b] - logs[0][a][b] for a in range(_SIZE) for b in range(_SIZE)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """The mean log-likelihood ratio of the token's transitions."""
    table = F.from_json(F.lit(json.dumps(model)), F.lit("array<double>"))

    def mean(codes: Column) -> Column:
        steps = F.size(codes) - 1
        ratios = F.zip_with(
            F.slice(codes, F.lit(1), steps), F.slice(codes, F.lit(2), steps), lambda a, b: F.get(table, _SIZE * a + b)
        )
        return F.aggregate(ratios, F.lit(0.0), lambda total, ratio: total + ratio) / steps

    return let(F.transform(F.split(token, ""), _class), mean)


def _all_spans(text: Column, model: list[float]) -> list[Column]:
    """The spans of each kind."""
    return [
        _spans(text, ASSIGN, 0, 2, lambda value: F.char_length(value) >= ASSIGNED),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
        _spans(text, CANDIDATE, 3, 0, lambda value: log_ratio(value, model) > LEAST_RATIO),
    ]


def with_spans(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, ...)`` with ``found_`` and the kind, the spans in order; kinds
    by number."""
    spans = _all_spans(F.coalesce(F.col("text"), F.lit("")), train(documents))
    return documents.withColumns({f"found_{kind}": found for kind, found in zip(KINDS, spans, strict=True)})


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def secret_scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row."""
    base = F.concat("found_assign", "found_access", "found_hex")
    return with_spans(documents.select("doc_id", "text")).select(
        "doc_id",
        F.size("found_assign").cast("long").alias("n_assign"),
        F.size("found_access").cast("long").alias("n_access"),
        F.size("found_hex").cast("long").alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, "found_markov")).alias("spans"),
    )


def _masked(text: Column, model: list[float]) -> Column:
    """A short text with its secrets masked."""

    def from_spans(found: Column) -> Column:
        def add(state: Column, span: Column) -> Column:
            gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
            apart = span["start"] >= state["at"]
            return F.struct(
                F.greatest(state["at"], span["stop"]).alias("at"),
                F.when(apart, F.concat(state["out"], gap, F.lit(MASK))).otherwise(state["out"]).alias("out"),
            )

        def rest(state: Column) -> Column:
            return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

        return F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, rest)

    return let(F.array_sort(F.concat(*_all_spans(text, model))), from_spans)


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret in the text replaced by ``MASK``, and ``n_chars``, if
    there, adjusted. Other rows are as they were.

    Texts are masked part by part, cut where no span can reach over, so that each is
    gone through once."""
    columns, model, text = documents.columns, train(documents), F.col("text")
    parts = F.transform(
        F.split(text, CUT, -1),
        lambda part: F.when(part.rlike(ANY), _masked(part, model)).otherwise(part),
    )
    out = documents.withColumn("_masked", F.when(text.rlike(ANY), F.array_join(parts, "")).otherwise(text))
    if "n_chars" in columns:
        changed = F.col("_masked") != text
        out = out.withColumn(
            "n_chars", F.when(changed, F.length("_masked").cast("long")).otherwise(F.col("n_chars"))
        )
    return out.select(*[F.col("_masked").alias(c) if c == "text" else F.col(c) for c in columns])
