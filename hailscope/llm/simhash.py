"""Near duplicates by SimHash fingerprints that meet at the words of a covering code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import attach, id_text, stage
from hailscope.llm.graph import components
from hailscope.llm.tokens import small_groups

SHINGLE, MAX_BITS, SEED = 3, 2, 42


def _shingles(text: str, size: int) -> list[bytes]:
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprints_of(texts: list[str], size: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text as uint64; 0 for a text without words."""
    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        own = [digest(s, SEED) for s in _shingles(text, size)]
        counts.append(len(own))
        hashes += own
    counts = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = counts > 0
    if full.any():
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        starts = np.cumsum(counts) - counts
        for i in np.flatnonzero(full):
            ones = bits[starts[i] : starts[i] + counts[i]].sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > counts[i], bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, fp`` (a hash of the text; the 64 bits as a signed long), one row per document."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            got = [fingerprints_of(texts[i:j], size) for i, j in small_groups(texts)]
            fp = np.concatenate([np.zeros(0, np.uint64), *got]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp)], ["doc_id", "mark", "fp"])

    texts = id_text(docs).withColumn("mark", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id long, mark long, fp long")


def _flips(reach: int) -> list[np.ndarray]:
    """By syndrome: what to flip in a word to get every anchor at most ``reach`` <= 2 bits away."""
    bit = [0, *(1 << i for i in range(63))]  # by position from 1, as the code numbers them
    out = []
    for s in range(64):
        flips = [bit[s]] + ([bit[s] | 1 << 63] if reach > (s > 0) else [])
        if reach == 2 and s:
            flips += [bit[i] | bit[i ^ s] for i in range(1, 64) if i < i ^ s and i ^ s]
        out.append(np.array([f for f in flips if int(f).bit_count() <= reach], np.uint64))
    return out


# Position p (from 1) of the first 63 bits counts for bit j of the syndrome if p has that bit.
CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 64) if p >> j & 1)) for j in range(6)]


def anchors_of(fp: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All (index of fingerprint, anchor) with at most ``reach`` bits between them."""
    syndrome = sum((np.bitwise_count(fp & c) & 1).astype(np.int64) << j for j, c in enumerate(CHECKS))
    flips = _flips(reach)
    sizes = np.array([len(f) for f in flips])[syndrome]
    flat, first = np.concatenate(flips), np.cumsum([0, *map(len, flips)])[syndrome]
    owner = np.repeat(np.arange(len(fp)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, fp[owner] ^ flat[np.repeat(first, sizes) + within]


def links_of(members: np.ndarray, most: int) -> np.ndarray:
    """For each different fingerprint of one anchor, the index of the first one it is linked to, by steps."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= most
    label = np.arange(len(members))
    while True:
        low = np.where(near, label[None, :], len(members)).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _links(reach: int, most: int):
    """Links of every run of equal anchors; runs may go on in the next batch."""

    def run(batches):
        anchor, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(a, f):
            cuts = np.flatnonzero(np.diff(a)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(a)]])
            left, right = [], []
            for i in np.flatnonzero(ends - starts > 1):
                members = f[starts[i] : ends[i]]
                label = links_of(members, most)
                other = np.flatnonzero(label != np.arange(len(members)))
                left.append(members[other])
                right.append(members[label[other]])
            both = [np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64) for x in (left, right)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["a", "b"])

        for batch in batches:
            anchor = np.concatenate([anchor, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(anchor):
                continue
            open_from = int(np.searchsorted(anchor, anchor[-1]))
            if open_from:
                yield links(anchor[:open_from], fp[:open_from])
            anchor, fp = anchor[open_from:], fp[open_from:]
        if len(anchor):
            yield links(anchor, fp)

    return run


def simhash_components(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, mark, fp, root, component_id``: fingerprint and class of every document.

    ``mark`` is a hash of the text, ``root`` the class's smallest fingerprint.

    The anchors are the words of a Hamming code over 63 bits, the 64th bit being
    free; its covering radius is 1. For two fingerprints at most ``max_bits`` (2)
    apart there is one in between, at most 1 bit from either, and its anchor is one
    bit further at most. So each fingerprint goes to every anchor within the
    covering radius plus the threshold's half on its side (both sides are
    replicated): 33 at most. Fingerprints are compared within an anchor, whose
    members lie within 2 bits of it, so there are never more than 2,081: no hot
    group can arise. An anchor reports a spanning set of links, not all pairs.

    Equal fingerprints are one row before anything is compared, and their rows are
    joined back with :func:`attach`. Components are found by :func:`components`.

    ``component_id`` is the smallest id reachable. NULL text is empty; texts
    without words have fingerprint 0 and link like any other; rows that repeat are one
    class. A NULL id is never the smallest; a class of NULL ids alone has NULL. An
    empty table gives no rows. Other columns are not read.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("the code serves up to 2 bits")
    reach = 1 + (max_bits + 1) // 2
    prints = stage(fingerprints(docs, size), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")

    def to_anchors(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fp), 4096):
                part = fp[i : i + 4096]
                owner, anchor = anchors_of(part, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(part[owner].view(np.int64))], ["anchor", "fp"]
                )

    met = classes.select("fp").mapInArrow(to_anchors, "anchor long, fp long")
    links = met.repartition("anchor").sortWithinPartitions("anchor")
    links = links.mapInArrow(_links(reach, max_bits), "a long, b long")
    roots = components(links)
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members"))
    named = attach(rooted, groups, ["root"], "members", classes.count())
    named = stage(named.select("fp", "root", "component_id", "n"), "classes")
    return attach(prints, named, ["fp"], "n", prints.count()).select("doc_id", "mark", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay when each class keeps one document.

    The smallest id stays (a NULL id last, then the smallest text hash). Of rows
    that repeat both id and text one stays.
    """
    found = simhash_components(docs, size, max_bits)
    order = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("best")
    best = found.groupBy("root").agg(order).select("best.*").withColumnsRenamed({"doc_id": "best_id", "mark": "best_mark"})
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select(*columns, F.col("doc_id").alias("own_id"), F.xxhash64(text).alias("own_mark"))
    same = F.col("own_id").eqNullSafe(F.col("best_id")) & (F.col("own_mark") == F.col("best_mark"))
    left = marked.join(best, same, "left_semi").dropDuplicates(["own_id", "own_mark"])
    return left.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
