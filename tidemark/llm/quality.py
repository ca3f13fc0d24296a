"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of characters and words, and whether
it repeats, of the line itself and of the lines before and after it; none is taken from
the language, source, id or label. The chain is trained on labelled documents by
maximum likelihood with forward-backward expectations. As a bad document may have good
lines, it is trained twice: first without links between lines, every line bearing its
document's label; then as a chain, where the lines of a bad document that look good to
the first model are good, all but its worst. A document's score is the mean of its lines' marginal
probabilities of being good, weighted by length.

Only training is bounded: ``TRAIN_DOCUMENTS`` labelled documents by hash of doc_id, of each
no more than ``TRAIN_LINES`` lines, evenly spaced. Scoring reads whole texts, slice by slice.

Defined results: a NULL text is empty, and an empty text is one empty line; rows without
doc_id are scored, and not held out; conflicting labels of one doc_id count as 1; without
labelled documents every score is 0.5; repeated rows are scored each. Other columns are
kept, those with the result's names replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ready
from tidemark.llm.shingles import mix, texts, word_hashes

#: Documents with crc32(doc_id) % FOLDS = 0 are held out of training.
FOLDS = 5
TRAIN_DOCUMENTS = 3000
TRAIN_LINES = 48
#: Score from which a document is taken for good.
LEAST_SCORE = 0.3
STEPS = 150
RATE = 0.2
DECAY = 1e-6

_KINDS = 6  # letter, upper, digit, space, mark, pipe
_KIND_OF = np.full(256, 4, dtype=np.int64)
_KIND_OF[128:] = 0
_KIND_OF[97:123] = 0
_KIND_OF[65:91] = 1
_KIND_OF[48:58] = 2
_KIND_OF[[9, 10, 11, 12, 13, 32]] = 3
_KIND_OF[ord("|")] = 5
_COMMON_MARKS = np.zeros(256, dtype=bool)
_COMMON_MARKS[[ord(c) for c in ".,;:'\"()-?"]] = True
OWN = 14  # features of one line
WIDTH = 3 * OWN + 1


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines of a slice of texts: features, lengths in bytes, and the first line of
    each text (one more at the end)."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(raw == 10)
    # a line starts at each text's start and after each of its breaks
    starts = np.concatenate([offsets[:-1], breaks + 1])
    text_of = np.concatenate([np.arange(n), np.searchsorted(offsets[1:], breaks, side="right")])
    order = np.lexsort((starts, text_of))
    starts, text_of = starts[order], text_of[order]
    firsts = np.searchsorted(text_of, np.arange(n + 1))
    stops = np.empty_like(starts)
    stops[:-1] = starts[1:] - 1
    last = firsts[1:] - 1
    stops[last] = offsets[1:]
    lengths = np.maximum(stops - starts, 0)

    size = np.maximum(lengths, 1).astype(float)
    sums = lambda flags: np.concatenate(([0], np.cumsum(flags)))
    inside = lambda flags: (s := sums(flags))[stops] - s[starts]
    kind = _KIND_OF[raw]
    lower, upper, digit, space, mark, pipe = (inside(kind == k).astype(float) for k in range(_KINDS))
    rare = inside((kind == 4) & ~_COMMON_MARKS[raw])
    # upper case of Latin-1: C3 80..9E
    accented = np.zeros(len(raw), bool)
    if len(raw) > 1:
        accented[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    upper = upper + inside(accented)
    letters = np.maximum(lower + upper, 1)

    words, word_firsts = word_hashes(raw, offsets)
    solid = kind != 3
    begins = solid.copy()
    if len(raw) > 1:
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begins[1:] &= ~solid[:-1] | edge[1:-1]
    word_at = sums(begins)
    n_words = np.maximum(word_at[stops] - word_at[starts], 1).astype(float)
    again = np.zeros(len(words), bool)
    if len(words) > 1:
        again[1:] = words[1:] == words[:-1]
        again[word_firsts[:-1][word_firsts[:-1] < len(words)]] = False
    repeated_words = sums(again)
    same_words = repeated_words[word_at[stops]] - repeated_words[word_at[starts]]

    # a line's hash is the sum of its words' mixed with their places
    word_sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words)))
    line_hash = mix(word_sums[word_at[stops]] - word_sums[word_at[starts]] + lengths.astype(np.uint64))
    _, group, times = np.unique(
        line_hash ^ mix(text_of.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True
    )
    copies = (times[group] > 1) & (lengths > 0)

    own = np.stack(
        [
            upper / letters,
            digit / size,
            np.minimum(4 * rare / size, 1),
            np.minimum(10 * pipe / size, 1),
            np.minimum(mark / n_words, 3) / 3,
            np.minimum(lengths / n_words, 30) / 30,
            same_words / n_words,
            copies.astype(float),
            np.minimum(np.log1p(lengths), 10) / 10,
            (lengths == 0).astype(float),
            (upper > 0.5 * letters) & (letters > 10),
            4 * rare > 0.2 * size,
            10 * pipe > 0.3 * size,
            same_words > 0.3 * n_words,
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[firsts[:-1]] = 0
    after[last] = 0
    return np.hstack([own, before, after, np.ones((len(own), 1))]), lengths, firsts


def marginals(good: np.ndarray, counts: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains of two states, vectorised over chains.

    ``good``: log-odds of the good state by (chain, step); ``counts``: steps of each chain;
    ``change``: log weights from state to state. Gives the marginal of the good state by
    (chain, step) and the expected number of each change, summed.
    """
    chains, steps = good.shape
    odds = 1 / (1 + np.exp(-np.clip(good, -50, 50)))
    emit = np.stack([1 - odds, odds], axis=2)
    weight = np.exp(change - change.max())
    active = np.arange(steps)[None, :] < counts[:, None]
    forward = np.empty((chains, steps, 2))
    forward[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        step = (forward[:, t - 1] @ weight) * emit[:, t]
        forward[:, t] = step / step.sum(axis=1, keepdims=True)
    backward = np.ones((chains, 2))
    good_at = np.zeros((chains, steps))
    changes = np.zeros((2, 2))
    for t in range(steps - 1, -1, -1):
        joint = forward[:, t] * backward
        joint /= joint.sum(axis=1, keepdims=True)
        good_at[:, t] = np.where(active[:, t], joint[:, 1], 0)
        if t:
            message = emit[:, t] * backward
            pair = forward[:, t - 1, :, None] * weight[None] * message[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            changes += pair[active[:, t]].sum(axis=0)
            message = message @ weight.T
            message /= message.sum(axis=1, keepdims=True)
            backward = np.where(active[:, t][:, None], message, 1.0)
    return good_at, changes


def fit(chains: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and change weights."""
    if not chains:
        return np.zeros(WIDTH), np.zeros((2, 2))
    counts = np.array([len(c) for c in chains])
    active = np.arange(counts.max())[None, :] < counts[:, None]
    lines = np.concatenate(chains).astype(float)
    truth = active & (labels == 1)[:, None]
    weights, _ = _ascend(lines, active, truth, linked=False)
    odds = np.full(active.shape, np.inf)
    odds[active] = lines @ weights
    odds[np.arange(len(odds)), odds.argmin(axis=1)] = -np.inf
    return _ascend(lines, active, truth | (active & (odds > 0)), linked=True)


def _ascend(lines: np.ndarray, active: np.ndarray, truth: np.ndarray, linked: bool):
    """Maximises the penalised likelihood of the lines' labels, by Adam steps."""
    weights, change = np.zeros(WIDTH), np.zeros((2, 2))
    counts, total = active.sum(axis=1), active.sum()
    both = active[:, 1:]
    seen = np.array(
        [[(both & (truth[:, :-1] == a) & (truth[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)]
    )
    moment = [np.zeros(WIDTH), np.zeros((2, 2))]
    spread = [np.zeros(WIDTH), np.zeros((2, 2))]
    odds = np.zeros(active.shape)
    for step in range(1, STEPS + 1):
        odds[active] = lines @ weights
        expected, changes = marginals(odds, counts, change)
        slopes = [
            (truth - expected)[active] @ lines / total - DECAY * weights,
            linked * ((seen - changes) / total - DECAY * change),
        ]
        for k, (value, slope) in enumerate(zip((weights, change), slopes, strict=True)):
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            spread[k] = 0.999 * spread[k] + 0.001 * slope**2
            value += RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    return weights, change


def _held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fits the chain on a bounded sample of labelled rows that aren't held out."""
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCUMENTS)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, n, raw, offsets in texts(batch.column("text")):
                x, _, firsts = line_features(raw, offsets)
                for k in range(n):
                    lines = x[firsts[k] : firsts[k + 1]]
                    if len(lines) > TRAIN_LINES:
                        lines = lines[np.linspace(0, len(lines) - 1, TRAIN_LINES).astype(int)]
                    rows.append(lines.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())],
                names=["doc_id", "quality", "lines"],
            )

    rows = (
        ready(documents)
        .select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(sample), "doc_id")  # no more than TRAIN_DOCUMENTS rows
        .select("doc_id", "quality", "text")
        .mapInArrow(features, "doc_id long, quality int, lines binary")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    chains = [np.frombuffer(r["lines"], dtype="<f4").reshape(-1, WIDTH) for r in rows]
    return fit(chains, np.array([r["quality"] for r in rows]))


def slice_scores(raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The score of each text of a slice."""
    x, lengths, firsts = line_features(raw, offsets)
    counts = np.diff(firsts)
    odds = x @ weights
    scores = np.empty(len(counts))
    order = np.argsort(counts, kind="stable")
    weight = np.maximum(lengths, 1).astype(float)
    a = 0
    while a < len(order):  # chains of up to twice the length together
        b = int(np.searchsorted(counts[order], 2 * counts[order[a]], side="right"))
        group = order[a:b]
        steps = counts[group].max()
        place = np.minimum(firsts[group][:, None] + np.arange(steps)[None, :], len(odds) - 1)
        good, _ = marginals(odds[place], counts[group], change)
        share = weight[place] * (np.arange(steps)[None, :] < counts[group][:, None])
        scores[group] = (good * share).sum(axis=1) / share.sum(axis=1)
        a = b
    return np.clip(scores, 0.0, 1.0)


def with_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents(doc_id, text, ...)`` with held_out, score and predicted."""
    weights, change = train(documents, labels)
    added = ("held_out", "score", "predicted")
    rest = [f for f in documents.schema.fields if f.name not in added]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slice_scores(raw, offs, weights, change) for _, _, raw, offs in texts(batch.column("text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(scores, pa.float64())],
                names=[*(f.name for f in rest), "score"],
            )

    return (
        ready(documents)
        .select(*(F.col(f.name) for f in rest))
        .mapInArrow(scored, T.StructType([*rest, T.StructField("score", T.DoubleType())]))
        .select(
            *(F.col(f.name) for f in rest),
            _held_out(F.col("doc_id")).alias("held_out"),
            "score",
            F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).alias("predicted"),
        )
    )
