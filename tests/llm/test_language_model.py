"""The language model against a plain one that goes through the texts bit by bit."""

from __future__ import annotations

import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from hailscope.llm import lm

TEXTS = [
    "The river is quiet. The river is wide, the town is quiet.",
    "A town by the wide river; nobody saw the town.",
    "quiet quiet quiet river",
    None,
    "",
    "Été was quiet, été was wide and  a\x00b a\x00 is not a",
    "nobody was there. Nobody is there, nobodyness is there",
    "unheard-of words wander westward",
]
ROWS = [(i, TEXTS[i % len(TEXTS)]) for i in range(24)]


def _held(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 7 == 2


def _steps(text: str | None):
    """For every token, and each of its bytes: slot of every predictor by bit, and the byte."""
    stream, out = [32] * 4, []
    for token in lm.tokens_of(text or ""):
        prefix, steps = 0, []
        for place, byte in enumerate(token + b" "):
            before = sum(b << 8 * (3 - at) for at, b in enumerate(stream[-4:]))
            one = lm.Spelling(*(np.array([x], t) for x, t in ((before, np.uint64), (prefix, np.uint64), (byte, np.uint8), (0, np.int64))))
            steps.append(([one.slots(k)[0].tolist() for k in range(lm.K)], byte, place))
            prefix = (prefix + byte * pow(int(lm._A), place, 1 << 64)) % (1 << 64)
            stream.append(byte)
        out.append((token, steps))
    return out


def _plain(model: lm.WordModel) -> list[float]:
    """log10 probabilities of all texts by the model's weights and refinement, with counts of its own."""
    often, seen = defaultdict(int), defaultdict(lambda: [0, 0])
    learned = [_steps(t) for i, t in ROWS if not _held(i)]
    for token, _ in sum(learned, []):
        often[token] += 1
    for token, steps in sum(learned, []):
        for slots, byte, place in steps:
            for k in range(lm.K):
                if k < lm.K - 1 or place < lm.HEAD or often[token] > 1:
                    for at in range(8):
                        seen[k, slots[k][at]][byte >> (7 - at) & 1] += 1
    scores = []
    for _, text in ROWS:
        score, before, total = 0.0, defaultdict(int), 0.0
        for place, (token, steps) in enumerate(_steps(text)):
            bits = 0.0
            for slots, byte, _ in steps:
                for at in range(8):
                    n = [seen[k, slots[k][at]] for k in range(lm.K)]
                    x = [np.log((b + 0.4) / (a + 0.4)) for a, b in n] + [lm.FIRST]
                    levels = [min(int(np.log2(sum(c) + 1)), lm.WORD_LEVELS - 1) for c in n[-2:]]
                    gate = (min(levels[0], lm.LEVELS - 1) * lm.WORD_LEVELS + levels[1]) * 8 + at
                    odds = float(np.clip(np.dot(x, model.mixer.weights[:, gate]), -20, 20))
                    step = min(max((odds + lm.BUCKETS / lm.FINE) * lm.FINE, 0), 2 * lm.BUCKETS - 1e-3)
                    row = model.mixer.refined[1 << at | byte >> (8 - at)]
                    refined = row[int(step)] + (step - int(step)) * (row[int(step) + 1] - row[int(step)])
                    one = (1 / (1 + np.exp(-odds)) + refined) / 2
                    bits -= np.log2(one if byte >> (7 - at) & 1 else 1 - one)
            own, chance = before[token] / max(place, 1), 2.0**-bits
            share = (lm.OWN_SHARE * lm.OWN_PRIOR + total) / (lm.OWN_PRIOR + place)
            score += np.log10(share * own + (1 - share) * chance)
            total += lm.OWN_SHARE * own / (lm.OWN_SHARE * own + (1 - lm.OWN_SHARE) * chance)
            before[token] += 1
        scores.append(score)
    return scores


def _scored(spark, partitions: int, held: int):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(partitions)
    counts = lm.count_words(docs)
    model = lm.train(docs, counts, known_words=held)
    got = {r.doc_id: r.score for r in lm.score_documents(docs, counts, model).collect()}
    return model, [got[i] for i, _ in ROWS]


def test_every_bit_goes_through_the_mix(spark):
    model, got = _scored(spark, 1, lm.KNOWN_WORDS)
    assert got == pytest.approx(_plain(model), abs=2e-3)
    # What tasks hold ready and how rows are dealt changes no score.
    assert _scored(spark, 8, 0)[1] == pytest.approx(got, abs=1e-4)


def test_long_words_cost_all_their_bits(spark):
    docs = spark.createDataFrame([(1, "x" * 50 + "yz" * 25_000)], "doc_id long, text string")
    other = spark.createDataFrame([(i, "river town") for i in range(20)], "doc_id long, text string")
    counts = lm.count_words(other)
    row = lm.score_documents(docs, counts, lm.train(other, counts)).first()
    assert row.score < -3_000 and row.n_tokens == 2


def test_bits_are_counted_by_half_bytes(monkeypatch):
    """One addition for each half byte gives the counts of each bit at its slot."""
    words, n = [b"about", b"above", b"a", "\u00e9t\u00e9".encode(), b"abc" * 9], [3, 1, 2, 5, 4]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(words, pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(n, pa.int64())], ["word", "head", "n"]
    )
    spelling, many = lm.spell_rest(words), np.array(n)
    want = []
    for k, size in enumerate(lm.SLOT_BITS):
        total = np.zeros((1 << size, 2), np.int64)
        own = np.where(many > 1, many, 0) if k == lm.K - 1 else many
        for slots, byte, owner in zip(spelling.slots(k), spelling.byte, spelling.owner, strict=True):
            for place, slot in enumerate(slots):
                total[slot, byte >> (7 - place) & 1] += own[owner]
        want.append(total.ravel())
    additions = 0

    class Add:
        @staticmethod
        def at(total, slots, weight, add=np.add.at):
            nonlocal additions
            additions += len(slots)
            add(total, slots, weight)

    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(lm.np, "add", Add)
    (found,) = lm._count_bits([batch])
    monkeypatch.undo()
    parts = [np.frombuffer(zlib.decompress(d), np.int64) for d in found.column("data").to_pylist()]
    assert np.array_equal(np.concatenate(parts), np.concatenate(want))
    assert additions == 2 * lm.K * len(spelling.byte)


def test_words_that_are_not_held_are_given_places_and_forgotten():
    places = lm._Places([b"a", b"b"])
    assert [places[w] for w in (b"c", b"a", b"d", b"c")] == [2, 0, 3, 2]
    assert places.others == [b"c", b"d"]
    places.forget()
    assert dict(places) == {b"a": 0, b"b": 1} and not places.others
    assert places[b"d"] == 2


def test_history_needs_no_sort_of_places(monkeypatch):
    rng = np.random.default_rng(3)
    owner, word = np.sort(rng.integers(0, 9, 500)), rng.integers(0, 40, 500)
    want = [sum(word[j] == word[i] and owner[j] == owner[i] for j in range(i)) for i in range(500)]
    monkeypatch.setattr(lm.np, "argsort", None)
    before, place = lm._history(owner, word)
    monkeypatch.undo()
    assert before.tolist() == want and place[0] == 0 and place[-1] == np.sum(owner == owner[-1]) - 1
