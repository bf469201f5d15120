"""Removal of passages that occur more than once, found with FM-indexes."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.llm.common import CARRIED, attach, discard, id_text, kept_columns, stage
from hailscope.llm.fm_index import FMIndex
from hailscope.llm.tokens import small_groups
from hailscope.llm.words import Words, sliding_argmin

WINDOW, GRAM = 35, 16
#: An anchor met more often than this is cut into single windows, which are dealt out each.
HOT_ANCHOR = 500
#: Words of one index.
SHARD_WORDS = 1_000_000
ROW = ["doc_id", "mark"]


def _anchors(words: Words, window: int, gram: int):
    """Text and first word of every window, the gram it is anchored at, and the hash of every gram."""
    grams = words.runs(gram)
    first, many = words.first[:-1], np.maximum(np.diff(words.first) - window + 1, 0)
    owner = np.repeat(np.arange(len(many)), many)
    starts = np.arange(len(owner)) + np.repeat(first - (np.cumsum(many) - many), many)
    return owner, starts, sliding_argmin(grams, window - gram + 1)[starts], grams


def _find_anchors(window: int, gram: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in small_groups(texts):
                owner, _, anchor, grams = _anchors(Words(texts[i:j]), window, gram)
                # The anchors of a text never go back, and no two texts share one.
                new = np.flatnonzero(np.diff(anchor, prepend=-1))
                owner, hashes = owner[new], grams[anchor[new]]
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                cuts = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | np.diff(hashes, prepend=~hashes[:1]).astype(bool))
                at = pa.array(i + owner[cuts])
                columns = [batch.column(0).take(at), batch.column(1).take(at)]
                columns += [pa.array(hashes[cuts].view(np.int64)), pa.array(np.diff(cuts, append=len(owner)))]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "anchor", "n"])

    return run


def _cut_segments(window: int, gram: int):
    """Stretches of windows with one repeated anchor; their words go along once per batch."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in small_groups(texts):
                sent, keys, sent_words = set(), [], []
                words = Words(texts[i:j])
                owner, starts, anchor, grams = _anchors(words, window, gram)
                # What is repeated, or hot, is so in every text that has it.
                cold, hot = (batch.column(c).slice(i, j - i).flatten().to_numpy(zero_copy_only=False) for c in (3, 4))
                hashes = grams[anchor].view(np.int64)
                single = np.isin(hashes, hot)
                wanted = np.flatnonzero(single | np.isin(hashes, cold))
                if not len(wanted):
                    continue
                # Windows next to each other with one anchor are in one text.
                new = (np.diff(wanted) != 1) | (np.diff(anchor[wanted]) != 0) | single[wanted[1:]]
                cuts = np.flatnonzero(np.concatenate([[True], new, [True]]))
                head, tail = wanted[cuts[:-1]], wanted[cuts[1:] - 1]
                begin, end = starts[head], starts[tail] + window
                data = words.data
                for a, b in zip(words.starts[begin].tolist(), words.ends[end - 1].tolist(), strict=True):
                    text = b" ".join(data[a:b].split())
                    key = hashlib.md5(text, usedforsecurity=False).digest()
                    keys.append(key)
                    sent_words.append(None if key in sent else text)
                    sent.add(key)
                route = np.where(single[head], np.frombuffer(b"".join(keys), "<i8")[::2], hashes[head])
                at = pa.array(i + owner[head])
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(begin - words.first[owner[head]])]
                columns += [pa.array(keys, pa.binary()), pa.array(route), pa.array(sent_words, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "at", "key", "route", "words"])

    return run


def _search(window: int):
    """One index per partition, over its segments; each segment is then searched in it."""

    def run(batches):
        parts = [batch.select(["key", "n", "words"]) for batch in batches if batch.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        keys, counts = table["key"].to_pylist(), table["n"].to_pylist()
        texts = pc.split_pattern(table["words"].cast(pa.large_string()).combine_chunks(), " ")
        sizes = texts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        codes = texts.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        symbols = np.zeros(len(codes) + len(texts), np.int64)
        ends = np.cumsum(sizes + 1) - 1
        is_word = np.ones(len(symbols), bool)
        is_word[ends] = False
        symbols[is_word] = codes + 1
        begins = ends - sizes
        once = np.flatnonzero(np.array(counts) == 1)
        lane, start, stop = FMIndex(symbols).repeats(symbols, begins[once], ends[once], window)
        lane = once[lane]
        often = np.flatnonzero(np.array(counts) > 1)  # its copies repeat all of it
        at = np.concatenate([lane, often])
        columns = [
            pa.array([keys[k] for k in at], pa.binary()),
            pa.array(np.array(counts)[at]),
            pa.array(np.concatenate([start - begins[lane], np.zeros(len(often), np.int64)])),
            pa.array(np.concatenate([stop - begins[lane], sizes[often]])),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n", "from", "to"])

    return run


def _remove(names: list[str]):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            kept, totals, gone = [], [], []
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                words = text.encode().split()
                keep = bytearray(b"\1") * len(words)
                for s in spans or []:
                    keep[s["from"] : s["to"]] = bytes(s["to"] - s["from"])
                kept.append(b" ".join(compress(words, keep) if spans else words).decode())
                totals.append(len(words))
                gone.append(keep.count(0))
            new = [pa.array(kept, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())]
            same = [batch.column(c) for c in names if c in batch.schema.names and c != "text"]
            yield pa.RecordBatch.from_arrays([same[0], *new, *same[1:]], names)

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, mark, from, to``: word intervals whose windows also start elsewhere.

    ``docs`` has ``doc_id, mark, text``. See :func:`substring_dedup`.
    """
    anchors = stage(docs.mapInArrow(_find_anchors(window, gram), "doc_id long, mark long, anchor long, n long"), "anchors")
    repeated = stage(
        anchors.groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).filter("n > 1"),
        "repeated-anchors",
    )
    hot = F.col("n") > HOT_ANCHOR
    chosen = (
        attach(anchors.drop("n"), repeated, ["anchor"], "rows", anchors.count())
        .groupBy(*ROW)
        .agg(
            F.collect_set(F.when(~hot, F.col("anchor"))).alias("cold"),
            F.collect_set(F.when(hot, F.col("anchor"))).alias("hot"),
        )
        .withColumnsRenamed({"doc_id": "has_id", "mark": "has_mark"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("has_id")) & (F.col("mark") == F.col("has_mark"))
    segments = stage(
        docs.join(chosen, same)
        .select(*ROW, "text", "cold", "hot")
        .mapInArrow(
            _cut_segments(window, gram),
            "doc_id long, mark long, at long, key binary, route long, words string",
        ),
        "segments",
    )
    discard(anchors)
    different = segments.groupBy("key").agg(
        F.count("*").alias("n"), F.min("route").alias("route"), F.max("words").alias("words")
    )
    different = stage(different, "different-segments")
    size = different.agg(F.sum(F.size(F.split("words", " "))).alias("n")).first()["n"] or 0
    shards = size // SHARD_WORDS + 1
    hits = stage(
        different.select("key", "n", "words", "route")
        .repartition(shards, "route")
        .mapInArrow(_search(window), "key binary, n long, from long, to long")
        .groupBy("key", "n")
        .agg(F.collect_list(F.struct("from", "to")).alias("spans")),
        "repeated-segments",
    )
    discard(different)
    owners = segments.select(*ROW, "at", "key")
    span = F.col("span")
    return (
        attach(owners, hits, ["key"], "n", segments.count())
        .select(*ROW, "at", F.explode("spans").alias("span"))
        .select(*ROW, (F.col("at") + span["from"]).alias("from"), (F.col("at") + span["to"]).alias("to"))
    )


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, text, n_words, n_removed`` and the columns ``keep``: texts without words that a repeated window covers.

    Words are runs without ASCII white space, compared as they are. A window is
    ``window`` words of one document; it is repeated if the same words start at
    any other place of any document. The words left are joined by one space.

    1. Every window is anchored at the gram of ``gram`` words in it with the smallest
       hash, so equal windows have equal anchors. Only anchors that occur twice
       anywhere can have repeated windows: all others are out after one count.
    2. Windows next to each other with one repeated anchor form a segment. Equal
       segments become one row with a count.
    3. Segments go to shards by their anchor, so equal windows meet in one shard.
       Each shard builds a compressed FM-index (packed wavelet matrix over its
       words) and streams its segments backward through it: the matching
       statistics give all intervals of ``window`` words or more that occur twice.
       Words are compared as text here; hashes only route. Windows of an anchor
       met more than ``HOT_ANCHOR`` times are segments each, so that such an anchor is dealt out by the text
       of its windows; shards hold about ``SHARD_WORDS`` words.
    4. Intervals go back to all owners of a segment with :func:`attach`.

    NULL and empty texts have no words and come back empty; a repeated row repeats
    all its windows; NULL ids are allowed; an empty table gives no rows; columns
    not named in ``keep`` are not read.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram is a part of a window")
    texts = id_text(docs, keep).withColumn("mark", F.xxhash64("text"))
    gone = (
        repeated_spans(texts.select(*ROW, "text"), window, gram)
        .groupBy(*ROW)
        .agg(F.collect_list(F.struct("from", "to")).alias("spans"))
        .withColumnsRenamed({"doc_id": "gone_id", "mark": "gone_mark"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark"))
    new = [T.StructField("text", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed"))]
    carried = [texts.schema[CARRIED + c] for c in keep]
    schema = T.StructType([texts.schema["doc_id"], *new, *carried])
    return (
        texts.join(gone, same, "left")
        .select("doc_id", "text", "spans", *(f.name for f in carried))
        .mapInArrow(_remove(schema.names), schema)
        .select("doc_id", "text", "n_words", "n_removed", *kept_columns(keep))
    )
