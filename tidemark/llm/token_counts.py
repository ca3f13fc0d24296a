"""Token counts by a unigram model, with the forward scores shared in a trie.

Text is cut into pre-tokens, maximal runs of ``[^\\x20\\x09-\\x0D]``, each led by the word
mark. The best segmentation of a pre-token into vocabulary pieces is the one of largest
summed log-probability, of equal ones that of fewer pieces. Distinct pre-tokens are
walked in order, so that they form a trie of which only one path is held: the best score
of a prefix is computed once for all pre-tokens that share it, and the count at the end
of a pre-token is stored as its terminal count.

The vocabulary files give an order of pieces but no probabilities; these follow Zipf's
law over that order. A character without a piece costs a token for each of its UTF-8
bytes, at less than any piece's probability.

Nothing is shuffled: each task counts the pre-tokens of its own batches and remembers
terminal counts, up to ``REMEMBERED`` of them.

Defined results: NULL, empty or blank texts have no tokens; repeated rows are counted
each; a text without white space is one pre-token, however long. Other columns are kept,
those with the result's names replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ready

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
#: Zipf-Mandelbrot shift.
SHIFT = 2.7
#: How much less likely than the rarest piece a byte is, in nats.
BYTE_PENALTY = 10.0
REMEMBERED = 1_000_000


def unigram_scores(path: str = VOCABULARY) -> dict[str, float]:
    """Log-probabilities of a vocabulary's pieces; "" has that of a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (rank + SHIFT) for rank in range(len(pieces))))
    scores = {piece: -math.log(rank + SHIFT) - total for rank, piece in enumerate(pieces)}
    scores[""] = min(scores.values()) - BYTE_PENALTY
    return scores


class SharedPrefixes:
    """Terminal counts of pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.byte = scores[""]

    def counts(self, tokens: list[str]) -> list[int]:
        """The number of pieces of each of ``tokens``, which ascend."""
        best, pieces = [0.0], [0]  # by length of the prefix of the current path
        path, terminal = "", []
        for token in tokens:
            same, most = 0, min(len(path), len(token))
            while same < most and path[same] == token[same]:
                same += 1
            del best[same + 1 :], pieces[same + 1 :]
            for end in range(same + 1, len(token) + 1):
                self._extend(token, end, best, pieces)
            path = token
            terminal.append(pieces[len(token)])
        return terminal

    def _extend(self, token: str, end: int, best: list[float], pieces: list[int]) -> None:
        width = len(token[end - 1].encode())
        score, count = best[end - 1] + width * self.byte, pieces[end - 1] + width
        for start in range(max(0, end - self.longest), end):
            piece = self.scores.get(token[start:end])
            if piece is not None:
                candidate = best[start] + piece
                if candidate > score or (candidate == score and pieces[start] + 1 < count):
                    score, count = candidate, pieces[start] + 1
        best.append(score)
        pieces.append(count)


def token_counts(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``documents(text, ...)`` with n_words, n_distinct and n_tokens in place of the text."""
    names = ("n_words", "n_distinct", "n_tokens")
    rest = [f for f in documents.schema.fields if f.name not in names and f.name != "text"]
    scores = documents.sparkSession.sparkContext.broadcast(unigram_scores(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = SharedPrefixes(scores.value), {}
        for batch in batches:
            bags = [Counter((t.as_py() or "").encode().split()) for t in batch.column("text")]
            if len(known) > REMEMBERED:
                known = {}
            new = sorted({w for bag in bags for w in bag if w not in known})
            known.update(zip(new, trie.counts([WORD_MARK + w.decode() for w in new]), strict=True))
            columns = [
                [sum(bag.values()) for bag in bags],
                [len(bag) for bag in bags],
                [sum(known[w] * n for w, n in bag.items()) for bag in bags],
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), *(pa.array(c, pa.int64()) for c in columns)],
                names=[*(f.name for f in rest), *names],
            )

    return (
        ready(documents)
        .select(*(F.col(f.name) for f in rest), F.col("text").cast("string"))
        .mapInArrow(counted, T.StructType([*rest, *(T.StructField(n, T.LongType()) for n in names)]))
    )
