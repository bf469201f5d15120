"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.llm.common import crc_mod, id_text, kept_columns
from hailscope.llm.tokens import small_groups
from hailscope.llm.words import Words

#: The fit is done on this many labelled documents at most, and lines of each.
TRAIN_DOCS, TRAIN_LINES = 1_500, 48
#: Remainder of crc32(doc_id) modulo FOLDS whose labels are never read.
FOLDS, HELD_OUT = 5, 0
GOOD_FROM = 0.3


def _classes() -> np.ndarray:
    kind = np.zeros((5, 256), bool)  # upper, digit, sign, other than ASCII, white
    kind[0, 65:91] = kind[1, 48:58] = kind[3, 128:] = True
    kind[4, [32, *range(9, 14)]] = True
    kind[2, 33:127] = ~np.char.isalnum([chr(b) for b in range(33, 127)])
    return kind


_KIND = _classes()
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:?'\")"]] = True
SHARES, OWN = 8, 8 * 3 + 5


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, the number of lines of each text, and the lines' lengths in bytes.

    Shares of capitals, digits, signs, other letters and white space among the bytes; of
    words equal to the word before, of words ending in a sign that closes no
    clause, of words that begin with a sign; lengths; first and last place. Each line also
    has the shares of the lines before and after it.
    """
    words = Words(texts)
    data = np.frombuffer(words.data, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    shares = []
    for kind in _KIND:
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int32)])
        shares.append((total[ends] - total[starts]) / np.maximum(size, 1))
    line = np.searchsorted(ends, words.starts)
    count = np.bincount(line, minlength=len(ends))
    again = np.zeros(len(line), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1])
    final, head = data[words.ends - 1], data[words.starts]
    for mark in (again, _KIND[2][final] & ~_STOPS[final], _KIND[2][head]):
        shares.append(np.bincount(line, mark, len(ends)) / np.maximum(count, 1))
    shares = np.stack(shares, 1)
    bounds = np.cumsum([len(t.encode()) + 1 for t in texts]) - 1
    closing = np.isin(ends, bounds)
    lines = np.diff(np.concatenate([[-1], np.flatnonzero(closing)]))
    opening = np.concatenate([[True], closing[:-1]])
    rest = [np.log1p(size) / 5, np.log1p(count) / 5, size == 0, opening, closing]
    own = np.concatenate([shares, shares > 0.02, shares > 0.3, np.stack(rest, 1)], axis=1).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[opening], after[closing] = 0, 0
    one = np.ones((len(own), 1), np.float32)
    return np.concatenate([own, before, after, one], axis=1), lines, size


@dataclass(frozen=True)
class LineModel:
    """``weights``: log-odds of a good line by feature; ``steps[a, b]``: score of b after a (0 bad, 1 good)."""

    weights: np.ndarray
    steps: np.ndarray

    def _before(self, odds: np.ndarray) -> np.ndarray:
        """Log-odds that the lines before each line give it; ``odds`` is [line, lane]."""
        t, out = self.steps, np.zeros_like(odds)
        for i in range(1, len(odds)):
            seen = out[i - 1] + odds[i - 1]
            out[i] = np.logaddexp(seen + t[1, 1], t[0, 1]) - np.logaddexp(seen + t[1, 0], t[0, 0])
        return out

    def marginals(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability of good for each line; ``lines`` says how many each document has.

        Documents of like length run side by side, one step per line. The backward
        pass is the forward pass over the lines in reverse, so padding stays at the end.
        """
        odds = features @ self.weights
        first = np.cumsum(lines) - lines
        out = np.empty(len(odds))
        by_length = np.argsort(lines, kind="stable")
        begin = 0
        while begin < len(by_length):
            longest = lines[by_length[begin:]]
            end = begin + max(1, int(np.searchsorted(longest, 2 * longest[0] + 8, "right")))
            lanes = by_length[begin:end]
            n = lines[lanes]
            rows = np.arange(n.max())
            forth = first[lanes][None, :] + np.minimum(rows[:, None], n - 1)
            back = first[lanes][None, :] + np.maximum(n - 1 - rows[:, None], 0)
            ahead = self._before(odds[forth])
            behind = LineModel(self.weights, self.steps.T)._before(odds[back])
            real = rows[:, None] < n
            out[forth[real]] = odds[forth[real]] + ahead[real]
            out[back[real]] += behind[real]
            begin = end
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

    def score(self, texts: list[str]) -> np.ndarray:
        """Mean marginal of the lines of each text, weighted by their length (an empty line weighs one byte)."""
        features, lines, size = line_features(texts)
        weight = size + 1.0
        starts = np.cumsum(lines) - lines
        good = np.add.reduceat(self.marginals(features, lines) * weight, starts)
        return good / np.add.reduceat(weight, starts)


def fit(texts: list[str], labels: np.ndarray, rounds: int = 250, rate: float = 0.1, shrink: float = 1e-5) -> LineModel:
    """Maximum likelihood by gradient steps (Adam); every line has the label of its document."""
    width = 3 * OWN + 1
    weights, steps = np.zeros(width), np.zeros((2, 2))
    if not texts:
        return LineModel(weights, steps)
    features, lines, _ = line_features(texts)
    first = np.cumsum(lines) - lines
    use = np.minimum(lines, TRAIN_LINES)
    rows = np.arange(use.max())
    real = rows[:, None] < use
    at = first[None, :] + np.minimum(rows[:, None], use - 1)
    x = features[at].astype(np.float64) * real[:, :, None]
    y = np.broadcast_to(labels.astype(float)[None, :], real.shape)
    share = 1.0 / use.sum()
    moment = [np.zeros(width), np.zeros(width), np.zeros((2, 2)), np.zeros((2, 2))]
    for k in range(1, rounds + 1):
        model = LineModel(weights, steps)
        odds = x @ weights
        ahead = model._before(odds)
        behind = np.zeros_like(odds)
        for i in range(len(odds) - 2, -1, -1):
            seen = behind[i + 1] + odds[i + 1]
            value = np.logaddexp(steps[1, 1] + seen, steps[1, 0]) - np.logaddexp(steps[0, 1] + seen, steps[0, 0])
            behind[i] = np.where(real[i + 1], value, 0)
        p = 1 / (1 + np.exp(-np.clip(ahead + odds + behind, -500, 500)))
        slope_w = np.tensordot((y - p) * real, x, 2) * share - shrink * weights
        left, right = (ahead + odds)[:-1], (odds + behind)[1:]
        four = np.stack([a * left + steps[a, b] + b * right for a in (0, 1) for b in (0, 1)])
        four = np.exp(four - four.max(axis=0))
        four /= four.sum(axis=0)
        both = real[1:]
        seen = np.stack([(1 - y[1:]), np.zeros_like(y[1:]), np.zeros_like(y[1:]), y[1:]])
        slope_s = ((seen - four) * both).sum(axis=(1, 2)).reshape(2, 2) * share - shrink * steps
        for g, now, m in ((slope_w, weights, 0), (slope_s, steps, 2)):
            moment[m] = 0.9 * moment[m] + 0.1 * g
            moment[m + 1] = 0.99 * moment[m + 1] + 0.01 * g * g
            now += rate * (moment[m] / (1 - 0.9**k)) / (np.sqrt(moment[m + 1] / (1 - 0.99**k)) + 1e-9)
    return LineModel(weights, steps)


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> LineModel:
    """Fit on at most ``train_docs`` labelled documents outside the held-out fold.

    The sample is the labelled ids with the smallest hashes, so it is spread over
    the table and the same in every run. Ids with a NULL or with two different
    labels are not used. Only the sample's texts come to the driver.
    """
    usable = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("quality"))
        .filter((F.col("low") == F.col("quality")) & (crc_mod(F.col("label_id"), FOLDS) != HELD_OUT))
    )
    ids = docs.select("doc_id").filter("doc_id is not null")
    chosen = (
        usable.join(ids, F.col("label_id") == F.col("doc_id"), "left_semi")
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(train_docs)
        .select("label_id", "quality")
    )
    rows = (
        id_text(docs)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", F.substring_index("text", "\n", TRAIN_LINES).alias("text"), "quality")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort()
    return fit([r["text"] for r in rows], np.array([r["quality"] for r in rows]))


def score_documents(docs: DataFrame, model: LineModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, score`` and the columns ``keep`` of every row of ``docs``.

    Lines are split at newlines. The field's node scores come from the features of
    a line and its two neighbours, forward and backward passes give each line's
    probability of being good, and the document's score is their mean weighted by length.
    The weights are small and fixed in size; scoring is one pass without a shuffle.

    NULL text is empty: one empty line, which has a score like any other. Repeated
    rows are scored each, NULL ids stay, an empty table gives no rows. Columns not
    named in ``keep`` are not read.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores = [model.score(texts[i:j]) for i, j in small_groups(texts)]
            column = pa.array(np.concatenate([np.zeros(0), *scores]))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names)

    plain = id_text(docs, keep)
    names = [*plain.columns, "score"]
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).select("doc_id", "text", "score", *kept_columns(keep))
