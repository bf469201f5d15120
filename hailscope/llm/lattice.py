"""Encoding into pieces by a relational lattice: substrings joined with the piece table, folded per word."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.llm.common import discard, id_text, stage
from hailscope.llm.tokens import small_groups

SPACE = "▁"
#: A text is cut where no piece of the vocabulary crosses: marks and letters, marks and other signs, single digits.
STRETCH = regex.compile(rf"{SPACE}*\p{{L}}+|{SPACE}*[^\p{{L}}0-9{SPACE}]+|{SPACE}+|[0-9]")
WORD = regex.compile(rf"{SPACE}[^{SPACE}]*")
#: Code points of a stretch that the lattice takes: its boundaries are the bits of one long.
LONGEST = 60
#: Marks in front of a stretch that the lattice takes.
MARKS = 8
#: Stretches at most whose pieces each task holds; all others are joined.
KNOWN_WORDS = 300_000
WORDS_PER_PART = 25_000
#: Different words a task counts or remembers before it starts anew.
CACHED = 100_000
SIGNS = ".,;:!?*#$%&"
#: A stretch that tasks hold is three bytes in a document's row: its place by frequency, from 1. This one is not held.
HOLE = bytes(3)
MOST_CODES = (1 << 24) - 1
ALL_BITS = (1 << 64) - 1
#: While something is staged: sorted words are grouped as they lie, and what was shuffled for it goes when it is written.
STAGING = {
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
NO_ID = (1 << 24) - 1

PIECES = T.StructType(
    [T.StructField("piece", T.StringType()), T.StructField("id", T.LongType()), T.StructField("rank", T.LongType())]
)


def _pieces(model_path: str) -> list[tuple[str, int, float]]:
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in plain]
    if crossing := [p for p, _, _ in rows if STRETCH.fullmatch(p) is None]:
        raise ValueError(f"pieces cross the cuts of a text: {crossing[:5]}")
    return rows


def piece_table(spark: SparkSession, model_path: str) -> DataFrame:
    """``piece, id, rank`` of the plain pieces of a vocabulary: tens of thousands of rows, whatever the data."""
    rows = _pieces(model_path)
    rank = {s: r for r, s in enumerate(sorted({s for _, _, s in rows}, reverse=True))}
    return spark.createDataFrame([(p, i, rank[s]) for p, i, s in rows], PIECES)


def words_of(text: str) -> list[str]:
    """The words of a text without their first space mark; more marks in front of a word stay."""
    plain = text.replace(SPACE, " ")
    words = plain.split(" ")
    if "" not in words:
        return words
    if not plain:
        return []
    return _marked(SPACE + plain.replace(" ", SPACE))


def _marked(marked: str) -> list[str]:
    """Words of a text with runs of spaces: a run belongs to what follows it."""
    out, run = [], 0
    for word in WORD.findall(marked):
        run += 1
        if len(word) > 1:
            out.append(SPACE * (run - 1) + word[1:])
            run = 0
    return [*out, SPACE * (run - 1)] if run else out


def stretches(word: str) -> list[str]:
    """The cuts of a word with its mark; letters, with or without signs behind, need no pattern."""
    if word.isalpha():
        return [SPACE + word]
    core = word.rstrip(SIGNS)
    if core.isalpha():
        return [SPACE + core, word[len(core) :]]
    return STRETCH.findall(SPACE + word)


def count_stretches(docs: DataFrame) -> DataFrame:
    """``word, n``: the different stretches of all texts and how often they occur."""

    def run(batches):
        seen: Counter = Counter()

        def flush():
            cut = {SPACE + word: n for word, n in seen.items() if word.isalpha()}
            for word, n in seen.items():
                if not word.isalpha():
                    for s in stretches(word):
                        cut[s] = cut.get(s, 0) + n
            seen.clear()
            columns = [pa.array(cut, pa.string()), pa.array(cut.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for texts in _groups(batch.column(0)):
                for text in texts:
                    seen.update(words_of(text))
                if len(seen) > CACHED:
                    yield flush()
        yield flush()

    parts = id_text(docs).select("text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _groups(texts: pa.Array):
    """Texts of a column in small lists, so that a worker never holds a whole batch as Python strings."""
    sizes = map(range, pc.binary_length(texts).to_pylist())  # a range has the length of its text
    for begin, end in small_groups(list(sizes)):
        yield texts.slice(begin, end - begin).to_pylist()


def encode_words(words: DataFrame, pieces: DataFrame, parts: int) -> DataFrame:
    """``word, n, tokens`` for different words of ``wid, word, n``, of ``LONGEST`` code points at most.

    Every substring of a word up to the longest piece is joined with the piece table
    (an equi-join on a hash, then the strings are compared; the table is fixed, so
    it is broadcast). Characters without a piece keep an edge without id. The edges of
    a word are grouped, sorted by rank and then start, and folded: the state holds
    the boundaries that are left as bits of one long, and an edge takes away
    the one boundary inside it if both its ends still are boundaries. As a piece of a merged
    vocabulary comes from pieces of smaller rank, this replays the merges. Edges
    between neighbouring boundaries of the last state are the pieces: ``tokens`` is
    start * 2^24 + id in order.

    Rows are dealt out by word once; exploding, joining and grouping keep that.
    """
    hashed = pieces.select(F.xxhash64("piece").alias("h"), F.col("piece").alias("known"), "id", "rank")
    longest, n, different = hashed.agg(F.max(F.length("known")), F.count("*"), F.countDistinct("h")).first()
    if n != different:
        raise ValueError("two pieces have one hash")
    worst = F.lit(1 << 20)
    same = F.col("known").eqNullSafe(F.col("piece"))
    start, end = F.col("s") - 1, F.col("s") - 1 + F.col("k")
    rank = F.when(same, F.col("rank")).otherwise(worst)
    key = F.coalesce(F.when(same, F.col("id")), F.lit(NO_ID))
    edge = F.shiftleft(rank, 36) + F.shiftleft(start.cast("long"), 30) + F.shiftleft(end.cast("long"), 24) + key
    edges = (
        words.repartition(parts, "wid")
        .sortWithinPartitions("wid")
        .select("wid", "word", F.length("word").alias("size"), "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("s"))
        .withColumn("rest", F.substring("word", F.col("s"), F.lit(longest)))
        .select("wid", "word", "n", "s", "rest", F.explode(F.sequence(F.lit(1), F.length("rest"))).alias("k"))
        .withColumn("piece", F.substring("rest", F.lit(1), F.col("k")))
        .withColumn("h", F.xxhash64("piece"))
        .join(F.broadcast(hashed), "h", "left")
        .filter(same | (F.col("k") == 1))
        .select("wid", "word", "n", edge.alias("edge"))
    )
    grouped = edges.groupBy("wid").agg(
        F.first("word").alias("word"), F.first("n").alias("n"), F.sort_array(F.collect_list("edge")).alias("edges")
    )
    # Higher-order functions over Spark SQL's own shifts: bits of a long, by start s, end e and what lies between.
    s, e = "int(shiftright(x, 30) & 63)", "int(shiftright(x, 24) & 63)"
    between = f"(shiftleft(1L, {e}) - shiftleft(2L, {s}))"
    ends = f"(shiftleft(1L, {s}) | shiftleft(1L, {e}))"
    step = f"if((m & {ends}) = {ends} AND bit_count(m & {between}) = 1, m & ~{between}, m)"
    folded = grouped.withColumn("mask", F.expr(f"aggregate(edges, shiftleft(1L, length(word) + 1) - 1L, (m, x) -> {step})"))
    final = f"(mask & {ends}) = {ends} AND (mask & {between}) = 0"
    tokens = f"sort_array(transform(filter(edges, x -> {final}), x -> shiftleft(shiftright(x, 30) & 63, 24) + (x & {NO_ID})))"
    return folded.select("word", "n", F.expr(tokens).alias("tokens"))


def _by_library(model, word: str) -> list[int]:
    """Ids of one stretch; the library puts a mark in front, and digits are pieces of their own."""
    return model.encode(word[1:]) if word[0] == SPACE else model.encode("0" + word)[2:]


def with_bytes(encoded: DataFrame, model_path: str) -> DataFrame:
    """``word, n, ids``: tokens as little-endian uint16 ids; a character without piece is its bytes, a word without
    tokens is encoded by the library."""

    def run(batches):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        first_byte = next(i for i in range(model.get_piece_size()) if model.is_byte(i))
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            ids = flat & NO_ID
            data, words = ids.astype("<u2").tobytes(), batch.column(0)
            out = [data[2 * a : 2 * b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            odd = np.unique(np.searchsorted(upto, np.flatnonzero(ids == NO_ID), "right") - 1)
            for k in odd.tolist():
                word, got = words[k].as_py(), []
                for t in flat[upto[k] : upto[k + 1]].tolist():
                    at, i = t >> 24, t & NO_ID
                    got += [first_byte + b for b in word[at].encode()] if i == NO_ID else [i]
                out[k] = np.array(got, "<u2").tobytes()
            for k in np.flatnonzero(sizes == 0).tolist():
                out[k] = np.array(_by_library(model, words[k].as_py()), "<u2").tobytes()
            yield pa.RecordBatch.from_arrays([words, batch.column(1), pa.array(out, pa.binary())], ["word", "n", "ids"])

    return encoded.mapInArrow(run, "word string, n long, ids binary")


@contextmanager
def _staging(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STAGING}
    for k, v in STAGING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def encode_stretches(counts: DataFrame, model_path: str) -> DataFrame:
    """``word, n, ids`` for the different stretches ``wid, word, n`` of a staged table."""
    spark = counts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), counts.count() // WORDS_PER_PART + 1)
    fits = (F.length("word") <= LONGEST) & ~F.col("word").startswith(SPACE * (MARKS + 1))
    folded = encode_words(counts.filter(fits), piece_table(spark, model_path), parts)
    others = counts.filter(~fits).select("word", "n", F.lit(None).cast("array<bigint>").alias("tokens"))
    return with_bytes(folded.unionByName(others), model_path)


def vocabulary(docs: DataFrame, model_path: str, known_words: int) -> tuple[pa.Table, DataFrame]:
    """``word, ids`` of the most frequent stretches, ``known_words`` at most, as a table; of all others staged."""
    step = F.floor(F.log2("n") * 16)
    with _staging(docs.sparkSession):
        counts = stage(count_stretches(docs).withColumn("wid", F.monotonically_increasing_id()), "pieces-words")
        left, least = known_words, None
        for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
            left -= r["count"]
            if left < 0:
                break
            least = r["step"]
        frequent = F.lit(False) if least is None else step >= least
        known = encode_stretches(counts.filter(frequent), model_path).toArrow()
        others = stage(encode_stretches(counts.filter(~frequent), model_path).select("word", "ids"), "pieces-ids")
        discard(counts)
    order = pc.sort_indices(known, [("n", "descending"), ("word", "ascending")])
    return known.select(["word", "ids"]).take(order).combine_chunks(), others


class Known:
    """Frequent stretches and their ids in two columns; a task makes of them what it needs."""

    def __init__(self, table: pa.Table):
        self.words, self.ids = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns)

    def codes(self) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Codes of stretches with a mark in front, without that mark, and of all others."""
        marked, plain = {}, {}
        for place, s in enumerate(self.words.to_pylist(), 1):
            code = place.to_bytes(3, "little")
            if s[0] == SPACE:
                marked[s[1:]] = code
            else:
                plain[s] = code
        return marked, plain

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each code end."""
        sizes = pc.binary_length(self.ids).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        return np.frombuffer(b"".join(self.ids.to_pylist()), "<u2"), np.concatenate([[0, 0], np.cumsum(sizes)])


def _coder(marked: dict[str, bytes], plain: dict[str, bytes]) -> Callable[[list[str]], tuple[bytes, list[str]]]:
    """The codes of words in a row, with a hole for each stretch that is not held, and those stretches."""
    cache: dict[str, bytes] = {}

    def run(words: list[str]) -> tuple[bytes, list[str]]:
        if len(cache) > CACHED:
            cache.clear()
        found, late = list(map(marked.get, words)), []
        if None in found:
            for k in [k for k, f in enumerate(found) if f is None]:
                word = words[k]
                code = cache.get(word)
                if code is None:
                    cut = stretches(word)
                    got = [marked.get(s[1:]) if s[0] == SPACE else plain.get(s) for s in cut]
                    if None in got:  # a word with a hole is rare itself
                        late += [s for s, f in zip(cut, got, strict=True) if f is None]
                        code = b"".join(f or HOLE for f in got)
                    else:
                        code = cache[word] = b"".join(got)
                found[k] = code
        return b"".join(found), late

    return run


def _planes(codes: bytes) -> bytes:
    """First, second and third bytes of the codes apart, which packs better."""
    return np.frombuffer(codes, np.uint8).reshape(-1, 3).T.tobytes()


def _places(planes: bytes) -> np.ndarray:
    low, middle, high = np.frombuffer(planes, np.uint8).reshape(3, -1).astype(np.int64)
    return low | middle << 8 | high << 16


def _filled(places: np.ndarray, flat: np.ndarray, ends: np.ndarray, late: list[bytes]) -> bytes:
    """The ids of codes in a row; ``late`` are the ids for the holes, in order."""
    starts, sizes = ends[places], ends[np.minimum(places + 1, len(ends) - 1)] - ends[places]
    holes = np.flatnonzero(places == 0)
    if len(late) != len(holes):
        raise ValueError(f"{len(holes)} holes, ids for {len(late)}")
    if late:
        own = np.fromiter(map(len, late), np.int64, len(late)) // 2
        starts[holes] = len(flat) + np.cumsum(own) - own
        sizes[holes] = own
        flat = np.concatenate([flat, np.frombuffer(b"".join(late), "<u2")])
    upto = np.cumsum(sizes)
    return flat[np.repeat(starts - upto + sizes, sizes) + np.arange(int(sizes.sum()))].tobytes()


def encode(docs: DataFrame, model_path: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """``doc_id, ids`` (little-endian uint16) of every row: its text in pieces of the vocabulary.

    The text is taken as it is, with a space before it. It is cut where no piece of the vocabulary
    crosses, and different stretches are encoded once (:func:`encode_words`). Tasks hold the pieces of at most
    ``known_words`` frequent stretches; every occurrence of another one is joined with the
    table by the stretch, and fills its hole in the document. One pass over the texts gives each
    document's codes and rare stretches; these rows are shuffled once, read for the join and again to be filled,
    and meet by a hash of text and ``doc_id``, so a task run again gives the same rows.

    The ids are those of the library for the same model. Stretches over ``LONGEST``
    code points or with over ``MARKS`` spaces in front are encoded by the library itself, once each. NULL and
    empty texts have no pieces; repeated rows are encoded each; NULL ids stay; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    table, others = vocabulary(docs, model_path, min(known_words, MOST_CODES))
    shared = spark.sparkContext.broadcast(Known(table))

    def cut(batches):
        code, pack = _coder(*shared.value.codes()), zstandard.ZstdCompressor(3).compress
        for batch in batches:
            at = 0
            for texts in _groups(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                found = [code(words_of(t)) for t in texts]
                # Rare stretches hang on the text alone; the id is in the hash so that copies spread.
                marks = [xxhash.xxh64_intdigest(t.encode(), (i or 0) & ALL_BITS) >> 1 for i, t in zip(ids.to_pylist(), texts, strict=True)]
                blobs = [pack(_planes(codes)) for codes, _ in found]
                late = [" ".join(rare) for _, rare in found]  # no stretch holds a space
                columns = [ids, pa.array(marks, pa.int64()), pa.array(blobs, pa.binary()), pa.array(late, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "blob", "late"])

    cuts = id_text(docs).select("doc_id", "text").mapInArrow(cut, "doc_id long, mark long, blob binary, late string")
    # No NULL in the key, or the join would drop rows before they are shuffled.
    cuts = cuts.select(F.coalesce("mark", F.lit(0)).alias("mark"), "doc_id", "blob", "late").repartition("mark")
    # Both readers take every column: then what is shuffled for them is the same, and Spark does it once.
    # (Where nothing is late, a NULL id gives the empty word, which is no stretch.)
    some = F.col("blob").isNotNull() & (F.col("doc_id").isNull() | (F.length("late") > 0))
    rare = F.when(some, F.split("late", " "))
    late = cuts.select("mark", F.posexplode(rare).alias("place", "word"))
    late = late.join(others.hint("merge"), "word").select("mark", "place", "ids")
    # One row for nearly every text and place: added up only behind the shuffle.
    late = late.repartition("mark").groupBy("mark").agg(F.collect_set(F.struct("place", "ids")).alias("found"))
    whole = cuts.join(late.hint("merge"), "mark", "left").select("doc_id", "blob", (F.length("late") > 0).alias("holes"), "found")

    def assemble(batches):
        flat, ends = shared.value.spans()
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            docs, out, held = [], [], 0
            for k, (doc, blob, holes) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)):
                fill = []
                if holes:
                    found = batch.column(3)[k].values
                    order = np.argsort(found.field("place").to_numpy())
                    fill = found.field("ids").take(pa.array(order)).to_pylist()
                data = _filled(_places(unpack(blob)), flat, ends, fill)
                docs.append(doc)
                out.append(data)
                held += len(data)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "ids"])
                    docs, out, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return whole.mapInArrow(assemble, "doc_id long, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, text``: the texts that :func:`encode` was given; a space mark in a text comes back as a space."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    first = next(i for i in range(size) if model.is_byte(i))
    table = [
        bytes([i - first]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)
    ]

    def run(batches):
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                raw = b"".join(map(table.__getitem__, np.frombuffer(ids, "<u2").tolist()))
                texts.append(raw[1:].decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


