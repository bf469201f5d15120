"""A corpus language model: gated logistic mixing of context predictions of every bit, a refinement, and the text's own history."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import crc_mod, id_text, stage
from hailscope.llm.tokens import small_groups

#: Remainder of crc32(doc_id) modulo FOLDS whose texts are never learned from.
FOLDS, HELD_OUT = 7, 2
#: Slots (as powers of two) of the predictors, which see 1, 2, 3 and 4 bytes before a bit, and the word so far.
SLOT_BITS = (16, 20, 20, 20, 21)
K = len(SLOT_BITS)
#: Bytes of a word whose contexts reach over its border; what is before them is a part of its head.
HEAD = 3
#: Slots of one row of counts (a power of two), and rows of a part that one group adds up.
PART_BITS, WIDTH = 16, 16
#: Frequent words and heads, at most, whose costs each task holds; it works out all others.
KNOWN_WORDS, KNOWN_HEADS = 200_000, 200_000
#: First weight of a text's own history, and how many tokens that is worth.
OWN_SHARE, OWN_PRIOR = 0.05, 20.0
#: Gates: by how often the two longest contexts were seen, and by the bit's place in its byte.
LEVELS, WORD_LEVELS = 6, 10
GATES = LEVELS * WORD_LEVELS * 8
#: Newton steps of the weights, their longest step, first weight, and the pull towards it.
STEPS, LONGEST, FIRST, PULL = 3, 0.5, 0.3, 2.0
#: Refinement: steps of the mixed odds on each side of zero, steps in one unit, and what its first guess is worth.
BUCKETS, FINE, REFINE_PRIOR = 16, 2, 10.0
#: Bytes whose bits are mixed at once.
CHUNK = 1 << 14
SPACE = 32

_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_BYTE, _PLACE = np.arange(256)[:, None], np.arange(8)
_SMALL_PLACE = _PLACE.astype(np.int16)
_BIT = (_BYTE >> (7 - _PLACE) & 1).astype(np.int8)
_ONCE = np.where(_BIT, 1 << 16, 1).astype(np.uint32)  # one occurrence in a pair of counts
_NODE = (1 << _PLACE) | (_BYTE >> (8 - _PLACE))  # the bits of the byte so far behind a one
_HALVES = np.stack([_NODE[:, :4], (1 << _PLACE[:4]) | ((_BYTE & 15) >> (4 - _PLACE[:4]))], axis=1)  # by half byte
_LEVEL = np.minimum(np.log2(np.arange(1 << WORD_LEVELS) + 1), WORD_LEVELS - 1).astype(np.int64)


def tokens_of(text: str) -> list[bytes]:
    """Lower-cased words (ASCII rules), then the end, which is the empty word."""
    return [*text.encode().lower().split(), b""]


@dataclass(frozen=True)
class Spelling:
    """Bytes to be predicted: the four bytes before each, a hash of the word so far, the byte, and whose it is."""

    before: np.ndarray
    prefix: np.ndarray
    byte: np.ndarray
    owner: np.ndarray

    def chunks(self, most: int = CHUNK):
        for i in range(0, len(self.byte), most):
            part = slice(i, i + most)
            yield Spelling(self.before[part], self.prefix[part], self.byte[part], self.owner[part])

    @cached_property
    def nodes(self) -> np.ndarray:
        return np.take(_HALVES, self.byte, axis=0)

    def rows(self, k: int) -> np.ndarray:
        """First slots of predictor ``k`` for both halves of every byte: the nodes of a half lie side by side."""
        seen = self.prefix if k == K - 1 else self.before & _U((1 << 8 * (k + 1)) - 1)
        high = (seen + _U(k + 1)) * _A
        high = (high ^ (high >> _U(29))) * _B
        low = (high + (self.byte >> 4).astype(_U) + _U(1)) * _A
        low = (low ^ (low >> _U(31))) * _B
        shift = _U(64 - SLOT_BITS[k] + 4)
        return (np.stack([high >> shift, low >> shift], axis=1) << _U(4)).view(np.int64)

    def slots(self, k: int) -> np.ndarray:
        """Slots of predictor ``k`` for the bits of every byte."""
        return (self.rows(k)[:, :, None] | self.nodes).reshape(-1, 8)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _A, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def spell_rest(words: list[bytes]) -> Spelling:
    """What follows the first ``HEAD`` bytes of every word, the space after it included."""
    data = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)  # words hold no space
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    place = np.arange(len(data) - 1) - np.repeat(ends - sizes, sizes)
    at = np.flatnonzero(place >= HEAD)
    terms = data[1:].astype(_U) * _powers(int(sizes.max(initial=1)))[place]
    sums = np.concatenate([[_U(0)], np.cumsum(terms, dtype=_U)])
    owner = np.repeat(np.arange(len(words)), sizes)[at]
    before = np.zeros(len(at), _U)
    for back in (4, 3, 2, 1):
        before = before << _U(8) | data[at + 1 - back].astype(_U)
    return Spelling(before, sums[at] - sums[(ends - sizes)[owner]], data[at + 1], owner)


def spell_heads(heads: np.ndarray) -> Spelling:
    """The first ``HEAD`` bytes of words (with the space of shorter ones) after the last bytes before them."""
    byte = [(heads >> 8 * back & 255).astype(_U) for back in (5, 4, 3)]
    byte += [np.full(len(heads), SPACE, _U), *((heads >> 8 * back & 255).astype(_U) for back in (2, 1, 0))]
    power = _powers(HEAD)
    before = sum(byte[i] << _U(8 * (3 - i)) for i in range(4)).astype(_U)
    prefix, some = np.zeros(len(heads), _U), np.ones(len(heads), bool)
    parts = []
    for place in range(HEAD):
        now = byte[4 + place]
        at = np.flatnonzero(some)
        parts.append((before[at], prefix[at], now[at].astype(np.uint8), at))
        before = (before << _U(8) | now) & _U(0xFFFFFFFF)
        prefix = prefix + now * power[place]
        some = some & (now != SPACE)
    return Spelling(*map(np.concatenate, zip(*parts, strict=True)))


def heads_of(tokens: list[list[bytes]], sizes: np.ndarray) -> np.ndarray:
    """For every token of some texts the three bytes before the space before it, and its own first bytes, in one number."""
    data = b"".join([b"    %b " % b" ".join(t) for t in tokens]) + bytes(HEAD)
    data = np.frombuffer(data, np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(tokens)), np.fromiter(map(len, tokens), np.int64, len(tokens)))
    start = np.cumsum(sizes + 1) - sizes - 1 + 4 * (owner + 1)
    key = data[start - 4] << 40 | data[start - 3] << 32 | data[start - 2] << 24 | data[start] << 16
    return key | np.where(sizes >= 1, data[start + 1], 0) << 8 | np.where(sizes >= 2, data[start + 2], 0)


def _stretch(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))


def _levels(seen: np.ndarray) -> np.ndarray:
    return _LEVEL[np.minimum(seen, len(_LEVEL) - 1).astype(np.int64)]


@dataclass(frozen=True)
class Mixer:
    """Counts by predictor and slot (ones in the upper half of a number), weights by gate, and the refinement.

    One that is :meth:`ready` to score holds the stretched predictions, and levels, in place of the counts.
    """

    counts: list[np.ndarray]
    weights: np.ndarray  # [K + 1, GATES]
    refined: np.ndarray  # [256, 2 * BUCKETS + 1], chances of a one
    levels: list[np.ndarray] | None = None  # of the two longest contexts: their shares in the gate's number

    def ready(self) -> Mixer:
        halves = [((c >> 16).astype(np.float32), (c & 0xFFFF).astype(np.float32)) for c in self.counts]
        shares = np.minimum(_LEVEL, LEVELS - 1) * WORD_LEVELS * 8, _LEVEL * 8
        levels = [np.take(s.astype(np.int16), (a + b).astype(np.int32), mode="clip") for s, (a, b) in zip(shares, halves[-2:], strict=True)]
        return replace(self, counts=[_stretch(*h) for h in halves], levels=levels)

    def inputs(self, part: Spelling, own: np.ndarray | None = None, own_word: np.ndarray | None = None):
        """Stretched predictions and gates; with ``own``, one occurrence is left out of the counts."""
        x = np.empty((K + 1, len(part.byte), 8), np.float32)
        bit, levels = _BIT[part.byte], []
        for k in range(K):
            slots = part.slots(k)
            if self.levels is not None:
                np.take(self.counts[k], slots, out=x[k], mode="clip")
                if k >= K - 2:
                    levels.append(np.take(self.levels[k - K + 2], slots, mode="clip"))
                continue
            both = np.take(self.counts[k], slots, mode="clip")
            if own is not None:  # what is left out was counted, so no half goes below zero
                both -= _ONCE[part.byte] * (own_word if k == K - 1 else own)[:, None]
            ones, zeros = (both >> 16).astype(np.float32), (both & 0xFFFF).astype(np.float32)
            x[k] = _stretch(ones, zeros)
            if k >= K - 2:
                levels.append(_levels(ones + zeros))
        x[-1] = FIRST
        if self.levels is not None:
            return x, (levels[0] + levels[1] + _SMALL_PLACE).astype(np.int64), bit
        gate = (np.minimum(levels[0], LEVELS - 1) * WORD_LEVELS + levels[1]) * 8 + _PLACE
        return x, gate, bit

    def odds(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        out = np.zeros(gate.shape, np.float32)
        for k, weights in enumerate(self.weights.astype(np.float32)):
            out += x[k] * np.take(weights, gate, mode="clip")
        return np.clip(out, -20, 20)

    def refine(self, odds: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the refinement the lower neighbour of the odds is, and the share of the upper one."""
        at = np.clip((odds + BUCKETS / FINE) * FINE, 0, 2 * BUCKETS - 1e-3)
        low = at.astype(np.int64)
        return _NODE[byte] * (2 * BUCKETS + 1) + low, at - low

    def bits(self, spelling: Spelling, n: int) -> np.ndarray:
        """Bits that the bytes of each of ``n`` owners cost."""
        out = np.zeros(n)
        flat = self.refined.ravel().astype(np.float32)
        for part in spelling.chunks(CHUNK >> 1):
            x, gate, bit = self.inputs(part)
            odds = self.odds(x, gate)
            low, share = self.refine(odds, part.byte)
            one = (1 / (1 + np.exp(-odds)) + (1 - share) * np.take(flat, low, mode="clip") + share * np.take(flat[1:], low, mode="clip")) / 2
            cost = -np.log2(np.where(bit == 1, one, 1 - one)).sum(axis=1, dtype=float)
            np.add.at(out, part.owner, cost)
        return out


def _first_mixer(counts: list[np.ndarray]) -> Mixer:
    weights = np.full((K + 1, GATES), FIRST)
    weights[-1] = 0
    center = (np.arange(2 * BUCKETS + 1) - BUCKETS) / FINE
    return Mixer(counts, weights, np.tile(1 / (1 + np.exp(-center)), (256, 1)))


def _count_tokens(batches):
    """Words and heads with their counts, added up per stretch of text before they are shuffled."""
    names = ["word", "head", "n"]
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for i, j in small_groups(texts, 1 << 22):
            counts, tokens = Counter(), [tokens_of(t) for t in texts[i:j]]
            for found in tokens:
                counts.update(found)
            sizes = np.fromiter(map(len, chain.from_iterable(tokens)), np.int64)
            heads, n = np.unique(heads_of(tokens, sizes), return_counts=True)
            words = [pa.array(counts.keys(), pa.binary()), pa.nulls(len(counts), pa.int64()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(words, names)
            heads = [pa.nulls(len(heads), pa.binary()), pa.array(heads, pa.int64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(heads, names)


def _spelled(batches):
    """Spellings of a table of words and heads, with the counts of their owners in the bytes and in the word so far."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        words, heads = table.filter(table["word"].is_valid()), table.filter(table["head"].is_valid())
        if heads.num_rows:
            n = heads["n"].to_numpy()
            yield spell_heads(heads["head"].to_numpy()), n, n
        if words.num_rows:
            n = words["n"].to_numpy()
            # A word met once says nothing of words met again: it is spelled, but is no context itself.
            yield spell_rest(words["word"].to_pylist()), n, np.where(n > 1, n, 0)


def _node_counts(halves: np.ndarray) -> np.ndarray:
    """Zeros and ones at each node, from how often each half byte was met behind each row."""
    halves = halves.reshape(-1, 16)
    out = np.zeros((len(halves), 16, 2), np.int64)
    for depth in range(4):
        first = 1 << depth
        out[:, first : 2 * first] = halves.reshape(len(halves), first, 2, -1).sum(axis=3)
    return out.ravel()


def _count_bits(batches):
    """Bit counts of the occurrences of one partition, by parts of the tables."""
    total = [np.zeros(1 << b, np.int64) for b in SLOT_BITS]
    some = False
    for spelling, n, n_word in _spelled(batches):
        some = True
        for part in spelling.chunks():
            half = np.stack([part.byte >> 4, part.byte & 15], axis=1)
            for k in range(K):
                weight = np.repeat((n_word if k == K - 1 else n)[part.owner], 2)
                np.add.at(total[k], (part.rows(k) | half).ravel(), weight)
    if some:
        parts = [_node_counts(p) for t in total for p in t.reshape(-1, 1 << PART_BITS)]
        data = [zlib.compress(p.tobytes(), 1) for p in parts]
        branch = np.full(len(parts), TaskContext.get().partitionId())
        columns = [pa.array(range(len(parts)), pa.int32()), pa.array(branch, pa.int32()), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "branch", "data"])


def _add_parts(table: pa.Table) -> pa.Table:
    total = np.zeros(2 << PART_BITS, np.int64)
    for data in table["data"].to_pylist():
        total += np.frombuffer(zlib.decompress(data), np.int64)
    return pa.table({"part": table["part"][:1], "branch": table["branch"][:1], "data": [zlib.compress(total.tobytes(), 1)]})


def bit_counts(counts: DataFrame) -> list[np.ndarray]:
    """The counts of all occurrences, added up by a tree whose groups have ``WIDTH`` rows at most, whatever its depth."""
    shape = "part int, branch int, data binary"
    branches = counts.rdd.getNumPartitions()
    parts = counts.select("word", "head", "n").mapInArrow(_count_bits, shape)
    while branches > 1:
        branches = -(-branches // WIDTH)
        above = F.floor(F.col("branch") / WIDTH).cast("int").alias("branch")
        parts = parts.select("part", above, "data").groupBy("part", "branch").applyInArrow(_add_parts, shape)
    tables = [np.zeros(1 << b, np.uint32) for b in SLOT_BITS]
    first = np.concatenate([[0], np.cumsum([t.size >> PART_BITS for t in tables])])
    for r in parts.toLocalIterator():
        k = int(np.searchsorted(first, r["part"], "right")) - 1
        own = np.frombuffer(zlib.decompress(r["data"]), np.int64).reshape(-1, 2)
        scale = np.maximum(own.max(axis=1) / 65_000, 1)  # a larger count keeps its ratio
        own = np.ceil(own / scale[:, None]).astype(np.uint32)
        at = (r["part"] - first[k]) << PART_BITS
        tables[k][at : at + len(own)] = own[:, 0] | own[:, 1] << 16
    return tables


_UPPER = np.triu_indices(K + 1)


def _sums(total: np.ndarray):
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.float64())], ["at", "value"])


def _added(counts: DataFrame, run, size: int) -> np.ndarray:
    rows = counts.select("word", "head", "n").mapInArrow(run, "at long, value double")
    out = np.zeros(size)
    for r in rows.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out


def _slopes(shared, weights: np.ndarray):
    """Slopes and curvatures of the bits that all occurrences cost, by weight and gate, each without its own count."""

    def run(batches):
        mixer = replace(shared.value, weights=weights)
        slope, square = np.zeros((GATES, K + 1)), np.zeros((GATES, K + 1, K + 1))
        for spelling, n, n_word in _spelled(batches):
            for part in spelling.chunks():
                own = n_word[part.owner]
                x, gate, bit = mixer.inputs(part, np.ones(len(own), np.uint32), np.minimum(own, 1).astype(np.uint32))
                one = 1 / (1 + np.exp(-mixer.odds(x, gate)))
                many = n[part.owner][:, None]
                miss, curve, flat = many * (bit - one), many * (one * (1 - one)), gate.ravel()
                flat = flat.astype(np.uint16)
                order = np.argsort(flat, kind="stable")
                found = flat[order]
                ends = np.append(np.flatnonzero(found[1:] != found[:-1]) + 1, len(found))
                x, miss, curve = np.take(x.reshape(K + 1, -1), order, axis=1, mode="clip").astype(float), miss.ravel()[order], curve.ravel()[order]
                gates = found[ends - 1].tolist()
                for gate, i, j in zip(gates, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    now = x[:, i:j]
                    slope[gate] += now @ miss[i:j]
                    square[gate] += (now * curve[i:j]) @ now.T
        yield from _sums(np.concatenate([slope.T, square[:, *_UPPER].T]).ravel())

    return run


def learn_weights(counts: DataFrame, shared, weights: np.ndarray) -> np.ndarray:
    """Newton steps for every gate over all occurrences: sums only, so neither order nor partitions matter."""
    first = weights
    for _ in range(STEPS):
        size = K + 1 + len(_UPPER[0])
        total = _added(counts, _slopes(shared, weights), size * GATES).reshape(size, GATES)
        slope = total[: K + 1] - PULL * (weights - first)
        curve = np.zeros((GATES, K + 1, K + 1))
        for at, (i, j) in enumerate(zip(*_UPPER, strict=True), K + 1):
            curve[:, i, j] = curve[:, j, i] = total[at]
        curve += PULL * np.eye(K + 1)
        step = np.linalg.solve(curve, slope.T[:, :, None])[:, :, 0].T
        weights = weights + np.clip(step, -LONGEST, LONGEST)
    return weights


def learn_refinement(counts: DataFrame, shared, weights: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """Chances of a one by the bits of the byte so far and the mixed odds, over all occurrences."""

    def run(batches):
        mixer = replace(shared.value, weights=weights)
        total = np.zeros((2, refined.size))
        for spelling, n, n_word in _spelled(batches):
            for part in spelling.chunks():
                own = n_word[part.owner]
                x, gate, bit = mixer.inputs(part, np.ones(len(own), np.uint32), np.minimum(own, 1).astype(np.uint32))
                low, share = mixer.refine(mixer.odds(x, gate), part.byte)
                many, low = n[part.owner][:, None], low.ravel()
                for at, near in ((low, many * (1 - share)), (low + 1, many * share)):
                    total[0] += np.bincount(at, near.ravel(), refined.size)
                    total[1] += np.bincount(at, (near * bit).ravel(), refined.size)
        yield from _sums(total.ravel())

    seen, ones = _added(counts, run, 2 * refined.size).reshape(2, *refined.shape)
    return (ones + REFINE_PRIOR * refined) / (seen + REFINE_PRIOR)


@dataclass(frozen=True)
class WordModel:
    """What each task holds: totals, the mixer, and the counts and costs of frequent words and heads."""

    total: int
    kinds: int
    known: dict[bytes, int]
    least: int  # count of the rarest word held
    rest: np.ndarray  # bits of the words of ``known`` after their heads
    heads: np.ndarray  # ascending
    head_bits: np.ndarray
    mixer: Mixer

    def rest_of(self, words: list[bytes]) -> np.ndarray:
        return self.mixer.bits(spell_rest(words), len(words))

    def head_cost(self, keys: np.ndarray) -> np.ndarray:
        """Bits of every head; those that are not held are worked out, each once."""
        kinds, which = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.heads, kinds), max(len(self.heads) - 1, 0))
        out, held = np.zeros(len(kinds)), np.zeros(len(kinds), bool)
        if len(self.heads):
            held = self.heads[at] == kinds
            out[held] = self.head_bits[at[held]]
        others = kinds[~held]
        out[~held] = self.mixer.bits(spell_heads(others), len(others))
        return out[which]


def training_texts(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)


def count_words(docs: DataFrame) -> DataFrame:
    """``word, head, n`` over the texts outside the held-out fold, a word or a head in each row.

    A head is the beginning of a word with the last bytes before it, see :func:`heads_of`.
    Staged, as every later step reads it.
    """
    counts = id_text(training_texts(docs)).select("text").mapInArrow(_count_tokens, "word binary, head long, n long")
    return stage(counts.groupBy("word", "head").agg(F.sum("n").alias("n")), "word-counts")


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent rows, ``most`` at most: whole steps of the logarithm of the count."""
    step = F.floor(F.log2("n") * 16).alias("step")
    left, least = most, None
    for r in counts.groupBy(step).count().orderBy(F.desc("step")).collect():
        left -= r["count"]
        if left < 0:
            break
        least = r["step"]
    return counts.filter(step >= least) if least is not None else counts.limit(0)


def train(docs: DataFrame, counts: DataFrame, known_words: int = KNOWN_WORDS, known_heads: int = KNOWN_HEADS) -> WordModel:
    """Fit on all training texts; ``counts`` are their words and heads. Only tables of fixed size come to the driver.

    ``known_words`` and ``known_heads`` say what tasks hold ready, and change no score.
    """
    context = counts.sparkSession.sparkContext
    words, heads = counts.filter(F.col("word").isNotNull()), counts.filter(F.col("head").isNotNull())
    row = words.agg(F.sum("n"), F.count("*")).first()
    total, kinds = (int(x or 0) for x in row)
    mixer = _first_mixer(bit_counts(counts))
    shared = context.broadcast(mixer)
    weights = learn_weights(counts, shared, mixer.weights)
    refined = learn_refinement(counts, shared, weights, mixer.refined)
    mixer = replace(mixer, weights=weights, refined=refined).ready()
    shared = context.broadcast(mixer)

    def cost(batches):
        ready = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                part = pa.Table.from_batches([batch.slice(i, 20_000)])
                word, head = part["word"].to_pylist(), part["head"]
                if head.null_count:
                    bits = ready.bits(spell_rest(word), len(word))
                else:
                    bits = ready.bits(spell_heads(head.to_numpy()), len(word))
                part = part.append_column("bits", pa.array(bits)).combine_chunks()
                yield from part.to_batches()

    shape = "word binary, head long, n long, bits double"
    found = _frequent(words, known_words).select("word", "head", "n").mapInArrow(cost, shape).select("word", "n", "bits").toArrow()
    known = dict(zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True))
    rest = found["bits"].to_numpy()
    found = _frequent(heads, known_heads).select("word", "head", "n").mapInArrow(cost, shape).select("head", "bits").toArrow()
    order = np.argsort(found["head"].to_numpy())
    least = min(known.values(), default=0)
    return WordModel(total, kinds, known, least, rest, found["head"].to_numpy()[order], found["bits"].to_numpy()[order], mixer)


def _history(owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each token came before in its text, and how many tokens did."""
    at = np.arange(len(owner))
    starts = np.concatenate([[True], owner[1:] != owner[:-1]])
    place = at - np.maximum.accumulate(np.where(starts, at, 0))
    # Sorted with their places in the lower bits, numbers need no stable sort of places, which is far slower.
    bits = len(at).bit_length()
    kind = np.sort((owner * (int(word.max(initial=0)) + 1) + word) << bits | at)
    order = kind & (1 << bits) - 1
    kind >>= bits
    new = np.concatenate([[True], kind[1:] != kind[:-1]])
    before = np.empty(len(at), np.int64)
    before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return before, place


class _Places(dict):
    """Places of the words held; any other word is given the next place, until :meth:`forget`."""

    def __init__(self, words):
        super().__init__((w, i) for i, w in enumerate(words))
        self.others: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.others.append(word)
        place = self[word] = len(self)
        return place

    def forget(self) -> None:
        for word in self.others:
            del self[word]
        self.others = []


INFO = "doc_id long, n_tokens long, n_bytes long, n_known long, base double, score double"
SCORED = f"rid long, word binary, times long, info struct<{INFO}>"


def _score(shared):
    """Per text its score, counts, and sums over the words held; each other word is a row that still needs its count."""

    def run(batches):
        model: WordModel = shared.value
        size, index = len(model.known), _Places(model.known)
        seen = np.array(list(model.known.values()), float)
        length = np.fromiter(map(len, model.known), np.int64, size)
        below = model.total + model.kinds + 1
        at = TaskContext.get().partitionId() << 33
        held_base = np.log10((seen + 1) / below)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in small_groups(texts, 1 << 21):
                all_tokens, n = [tokens_of(t) for t in texts[i:j]], j - i
                counts = np.fromiter(map(len, all_tokens), np.int64, n)
                word = np.fromiter(map(index.__getitem__, chain.from_iterable(all_tokens)), np.int64, int(counts.sum()))
                words = index.others
                index.forget()
                owner = np.repeat(np.arange(n), counts)
                sizes = np.concatenate([length, np.fromiter(map(len, words), np.int64, len(words))])[word]
                bits = model.head_cost(heads_of(all_tokens, sizes))
                bits += np.concatenate([model.rest, model.rest_of(words)])[word]
                before, place = _history(owner, word)
                own = before / np.maximum(place, 1)
                met = np.flatnonzero(before)
                # How well the text's own history did so far decides its weight in the next token.
                chance = (1 - OWN_SHARE) * np.exp2(-bits[met])
                did = np.zeros(len(word))
                did[met] = OWN_SHARE * own[met] / (OWN_SHARE * own[met] + chance)
                total = np.concatenate([[0], np.cumsum(did)])
                first = np.cumsum(counts) - counts
                share = (OWN_SHARE * OWN_PRIOR + total[:-1] - total[first][owner]) / (OWN_PRIOR + place)
                score = np.log2(1 - share) - bits
                score[met] = np.logaddexp2(np.log2(share[met] * own[met]), score[met])
                score *= np.log10(2)
                common = word < size
                base = np.concatenate([held_base, np.zeros(len(words))])[word]
                rid = at + np.arange(n)
                at += n
                # Each other word once per text, with how often it is there.
                late = ~common
                pairs, times = np.unique(owner[late] * (len(words) + 1) + word[late] - size, return_counts=True)
                of, which = np.divmod(pairs, len(words) + 1)
                info = [
                    pa.array(ids[i:j], pa.int64()),
                    pa.array(counts),
                    pa.array(np.bincount(owner, sizes + 1, n).astype(np.int64)),
                    pa.array(np.bincount(owner, common, n).astype(np.int64)),
                    pa.array(np.bincount(owner, base, n)),
                    pa.array(np.bincount(owner, score, n)),
                ]
                info = pa.StructArray.from_arrays(info, [x.split()[0] for x in INFO.split(", ")])
                # no word has a space: the rows of texts find no count, and they spread
                names = ["rid", "word", "times", "info"]
                columns = [pa.array(rid), pa.array([b" %d" % r for r in rid], pa.binary()), pa.array(np.zeros(n, np.int64)), info]
                yield pa.RecordBatch.from_arrays(columns, names)
                columns = [
                    pa.array(rid[of]),
                    pa.array(words, pa.binary()).take(pa.array(which)),
                    pa.array(times.astype(np.int64)),
                    pa.nulls(len(of), info.type),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def score_documents(docs: DataFrame, counts: DataFrame, model: WordModel) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every row.

    ``score`` is the log10 probability of the whole text. Each token is spelled,
    its closing space included, and every bit of every byte of every token is
    predicted from counts of all training occurrences in hashed contexts:

    * the 1, 2, 3 and 4 bytes before it, over the borders of words, and the word so far
      (learned from words met at least twice);
    * the predictions are combined in the logistic domain by weights that a
      gate picks from how often the two longest contexts were seen and the bit's place;
      the weights are learned over all training occurrences, each one's own counts left out;
    * the mixed prediction is averaged with that of a refinement table, which says
      how often such a prediction, behind these bits of the byte, was a one.

    A token's chance is then mixed with its share in the text so far, by a weight
    that adapts token by token to how well that did.

    A byte that far in a word hangs on the word alone, so words and heads (the first bytes, with those before
    the word) are spelled once each and tasks hold the costs of the frequent ones; what
    they hold changes no score. ``base_score`` is the add-one model of single words, with exact
    counts: words that tasks do not hold are joined with the full table.

    NULL and empty texts are the end token alone; repeated rows are scored each; a
    NULL id has the remainder of the empty text; an empty table gives no rows. Texts are never cut:
    a text is held by one task with its tokens. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = id_text(docs).mapInArrow(_score(shared), SCORED)
    others = counts.filter(F.col("word").isNotNull())
    if model.known:
        others = others.filter(F.col("n") < model.least)
    n, times = F.coalesce(F.col("n"), F.lit(0)), F.col("times")
    below = float(model.total + model.kinds + 1)
    info = {x.split()[0]: F.col("info." + x.split()[0]) for x in INFO.split(", ")}
    part = lambda name: F.coalesce(info[name], F.lit(0))
    scored = rows.join(others.select("word", "n").hint("merge"), "word", "left").select(
        "rid",
        info["doc_id"].alias("doc_id"),
        info["n_tokens"].alias("n_tokens"),
        info["n_bytes"].alias("n_bytes"),
        info["score"].alias("score"),
        (part("n_known") + F.when(n > 0, times).otherwise(0)).alias("n_known"),
        (part("base") + times * F.log10((n + 1) / below)).alias("base"),
    )
    sums = scored.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_bytes", "n_known", "base", "score"))
    )
    return sums.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
