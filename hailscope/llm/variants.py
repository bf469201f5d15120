"""Spelling variants: words one edit apart, by two pivotal bigrams of each word."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import id_text, stage

RUN = "[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, FORM_RATIO, DROP_EVERY = 7, 2, 10, 31
#: Bigrams of a word's prefix, ties aside: q * edits + 1 hold two disjoint ones.
PREFIX = 3
#: By how much a list is taken to shrink for every further letter of its key.
SHRINK = 8.0
#: Most letters of a bigram's open side that a key holds.
OPEN = 4
#: Words that a task counts before it hands its counts on.
COUNTER_WORDS = 300_000
#: Forms point at words at least FORM_RATIO as frequent, so a chain has under 20 steps: 2 ** 5 suffice.
DOUBLINGS = 5


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word, n``: the words of at least ``min_length`` code points in whole texts, and how often they occur.

    A-Z are lower-cased. Where ``drop_every`` divides h, the crc32 of
    ``<doc_id>:<word>`` (a NULL id is empty), the word loses its code point h modulo
    its length. Tasks count on their own first, so a frequent word costs one row
    per task.
    """
    run = re.compile(RUN + "{%d,}" % min_length)

    def count(batches):
        seen: Counter[str] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    seen[word] += n
                if len(seen) > COUNTER_WORDS:
                    yield rows()
                    seen.clear()
        yield rows()

    counted = id_text(docs).mapInArrow(count, "word string, n long").filter(F.length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def bigram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank (rarest first) and count of every bigram *(action)*; at most the square of the 90 letters."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    ordered = sorted(counts, key=lambda r: (r["count"], r["gram"]))
    return {r["gram"]: (i, r["count"]) for i, r in enumerate(ordered)}


def prefix_of(word: str, ranks: dict[str, tuple[int, int]], size: int = PREFIX) -> tuple[list[int], int]:
    """Positions of the word's rarest bigrams, in order, and the rank of the last one.

    ``size`` bigrams, and whatever else has the rank of the last.
    """
    own = [ranks[word[i : i + 2]][0] for i in range(len(word) - 1)]
    last = sorted(own)[size - 1]
    return [i for i, rank in enumerate(own) if rank <= last], last


def pivots_of(word: str, positions: list[int], ranks: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """The two disjoint bigrams of the prefix with the shortest lists, by dynamic programming from left to right.

    The first is looked up with all that stands in front of it, the second with all
    that follows it, so each further letter there makes the list shorter.
    """
    end = len(word) - 2
    open_cost, open_at = float("inf"), -1  # best first pivot that ends before the bigram in hand
    best, pair = float("inf"), (-1, -1)
    waiting: list[int] = []
    for p in positions:
        while waiting and waiting[0] + 2 <= p:
            q = waiting.pop(0)
            cost = ranks[word[q : q + 2]][1] * SHRINK**-q
            if cost < open_cost:
                open_cost, open_at = cost, q
        total = open_cost + ranks[word[p : p + 2]][1] * SHRINK ** (p - end)
        if total < best:
            best, pair = total, (open_at, p)
        waiting.append(p)
    return pair


def pivoted(words: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """``word, n, positions, last, first, second``: prefix and pivots of every word *(action)*."""
    ranks = bigram_ranks(words)

    def run(batches):
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                positions, last = prefix_of(word, ranks, prefix)
                rows.append((positions, last, *pivots_of(word, positions, ranks)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], ["word", "n", "positions", "last", "first", "second"])

    return words.mapInArrow(run, "word string, n long, positions array<int>, last int, first int, second int")


def _open_side(p: Column, back: bool) -> Column:
    """How many letters lie on the bigram's open side: in front if ``back``, else behind."""
    return p if back else F.length("word") - p - 2


def _reach(left: Column) -> Column:
    """How many letters of an open side of ``left`` letters a key holds: half of them, so that one edit
    spares the nearest or the farthest ones; none of a short side."""
    return F.when(left < 4, 0).otherwise(F.least(F.floor(left / 2), F.lit(OPEN))).cast("int")


def _keys(p: Column, back: bool, reach: Column) -> list[Column]:
    """Keys of the bigram at ``p`` with the ``reach`` nearest and with the farthest letters of its open side.

    The closed side is all behind the bigram if ``back``, else all in front of it; it
    is part of every key, so places are equal from that end.
    """
    word, length = F.col("word"), F.length("word")
    if back:
        near, far = word.substr(p + 1 - reach, length), word.substr(F.lit(1), reach)
        closed = word.substr(p + 1, length)
    else:
        near, far = word.substr(F.lit(1), p + 2 + reach), word.substr(length + 1 - reach, reach)
        closed = word.substr(F.lit(1), p + 2)
    side = F.lit(2 * back)
    second = F.when(reach > 0, F.xxhash64(side + 1, reach, closed, far))
    return [F.xxhash64(side, reach, near), second]


def lookups(words: DataFrame) -> DataFrame:
    """``key, word, n, last``: what each word looks up, from its two pivots.

    One edit lies behind the first pivot or in front of the second (they are
    disjoint), so one of them is found, with all on its closed side, at the same
    place; on its open side one half or the other is spared.
    """
    keys = []
    for p, back in ((F.col("first"), False), (F.col("second"), True)):
        keys += _keys(p, back, _reach(_open_side(p, back)))
    return words.select(F.explode(F.array_compact(F.array(*keys))).alias("key"), "word", "n", "last")


def filed(words: DataFrame) -> DataFrame:
    """``key, word, n, last``: every key under which a word of a letter more or less may look it up."""
    keys = []
    for back in (False, True):
        left = _open_side(F.col("p"), back)
        less, more = _reach(left - 1), _reach(left + 1)
        keys += _keys(F.col("p"), back, less)
        keys += [F.when(more > less, k) for k in _keys(F.col("p"), back, more)]
    grams = words.select("word", "n", "last", F.explode("positions").alias("p"))
    return grams.select(F.explode(F.array_compact(F.array(*keys))).alias("key"), "word", "n", "last")


def near_pairs(words: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """``a, na, b, nb``: every two words one edit apart, once, with their counts *(action)*."""
    own = stage(pivoted(words, prefix), "variants-pivots")
    ask = lookups(own).withColumnsRenamed({"word": "asked", "n": "n_asked", "last": "last_asked"})
    close = F.abs(F.length("asked") - F.length("word")) <= 1
    one = F.levenshtein("asked", "word", 1) == 1
    found = ask.join(filed(own), "key").filter((F.col("last_asked") <= F.col("last")) & close & one)
    first = F.col("asked") < F.col("word")
    ends = [F.struct(F.col(w).alias("word"), F.col(n).alias("n")) for w, n in (("asked", "n_asked"), ("word", "n"))]
    pairs = found.select(
        F.when(first, ends[0]).otherwise(ends[1]).alias("a"), F.when(first, ends[1]).otherwise(ends[0]).alias("b")
    )
    pairs = pairs.select(F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` by doubling the steps *(action)*."""
    steps = stage(forms.select("word", F.col("form").alias("root")), "variants-roots")
    for _ in range(DOUBLINGS):
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = steps.join(on, "root", "left")
        steps = stage(both.select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
    return steps


def spelling_variants(docs: DataFrame, ratio: int = FORM_RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word and the form it is a variant of *(action)*.

    Words of whole texts, see :func:`count_words`, that occur ``min_count`` times at
    least. Two are near if one insertion, deletion or replacement of a code point
    apart. A word's form is its most frequent near word (then the first in code-point
    order), if at least ``ratio`` times as frequent; its root is the last of the chain
    of forms, the word itself if it has none.

    Near words are found by pivotal bigrams: of each word's rarest bigrams (the
    prefix) two disjoint ones are picked by dynamic programming. A word looks up its
    pivots in the prefixes of the others. Of two near words, the one whose prefix ends
    at the rarer bigram finds a pivot of its own in the other's prefix. Keys hold the
    bigram, its place from one end and letters beside it, so that lists stay short;
    candidates are verified by edit distance. No list is cut.

    NULL text has no words, and an empty table gives no rows. Rows that repeat count
    again. Very long texts are counted whole, one at a time. Other columns are not
    read.
    """
    words = stage(count_words(docs).filter(F.col("n") >= min_count), "variants-words")
    pairs = stage(near_pairs(words), "variants-pairs")
    sides = (("a", "b", "na", "nb"), ("b", "a", "nb", "na"))
    both = [pairs.select(F.col(w).alias("word"), F.col(o).alias("other"), F.col(n).alias("n"), F.col(m).alias("m")) for w, o, n, m in sides]
    best = F.min(F.struct((-F.col("m")).alias("minus"), "other")).alias("best")
    near = both[0].unionByName(both[1]).groupBy("word", "n").agg(best, F.count("*").alias("n_near"))
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    near = stage(
        near.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, -F.col("best.minus")).alias("form_n"),
        ),
        "variants-near",
    )
    out = words.join(near, "word", "left").join(roots(near.filter("form IS NOT NULL")), "word", "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )
