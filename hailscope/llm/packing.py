"""Documents cut and packed into windows of several context sizes."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hailscope.llm.common import id_text
from hailscope.llm.tokens import encoder, small_groups

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
#: Tokens of a step group: 16 of the longest windows, or as many shorter ones.
STEP_TOKENS = 65_536
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window long, step_group long"


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start, ids, total):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self):
        return len(self.ids)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(
            self.doc, self.start + n, self.ids[n:], self.total
        )


class Packer:
    """Packs the pieces of one partition; holds at most one open window per tier.

    ``first`` is the number of the first window. Windows are emitted as
    (number, size, step group, pieces).
    """

    def __init__(self, tiers=TIERS, step_tokens: int = STEP_TOKENS, first: int = 0):
        self.tiers, self.longest = sorted(tiers), max(tiers)
        self.step_tokens, self.next, self.first = step_tokens, first, first
        self.waiting: dict[int, list[Piece]] = {t: [] for t in self.tiers}
        self.filled = {t: 0 for t in self.tiers}
        self.groups, self.group_of = 0, {}

    def _tier(self, n: int) -> int:
        return self.tiers[bisect.bisect_left(self.tiers, n)]

    def route(self, piece: Piece) -> None:
        bisect.insort(self.waiting[self._tier(len(piece))], piece, key=len)

    def _close(self, size: int, pieces: list[Piece]):
        """Windows of one size fill a step group of their own, so full groups weigh the same."""
        if size not in self.group_of or self.filled[size] + size > self.step_tokens:
            self.group_of[size], self.filled[size] = self.first + self.groups, 0
            self.groups += 1
        self.filled[size] += size
        self.next += 1
        return self.next - 1, size, self.group_of[size], pieces

    def add(self, doc, ids: np.ndarray):
        """Whole windows of the longest size leave at once; the rest goes to its tier."""
        total, start = len(ids), 0
        while total - start >= self.longest:
            yield self._close(self.longest, [Piece(doc, start, ids[start : start + self.longest], total)])
            start += self.longest
        if start < total:
            self.route(Piece(doc, start, ids[start:], total))

    def _fill(self, gap: int, below: int) -> list[Piece]:
        """Pieces of this and shorter tiers for a gap, the last one cut; less only if nothing waits."""
        got = []
        while gap:
            for t in [t for t in reversed(self.tiers) if t <= below]:
                row = self.waiting[t]
                if at := bisect.bisect_right(row, gap, key=len):
                    got.append(row.pop(at - 1))
                    break
            else:
                row = next((self.waiting[t] for t in self.tiers if t <= below and self.waiting[t]), None)
                if row is None:
                    break
                head, tail = row.pop(0).cut(gap)
                got.append(head)
                self.route(tail)
            gap -= len(got[-1])
        return got

    def pack(self, spare: int):
        """Fill windows from the longest tier down, while at least ``spare`` tokens wait to fill gaps."""
        for t in reversed(self.tiers):
            row = self.waiting[t]
            while row and sum_below(self.waiting, t, spare + t):
                piece = row.pop()
                pieces = [piece, *self._fill(t - len(piece), t)]
                if (n := sum(map(len, pieces))) < t:  # nothing else waits: try later
                    for p in pieces:
                        self.route(p)
                    assert n < t
                    break
                yield self._close(t, pieces)

    def finish(self):
        """What is left is cut into windows of falling powers of two, which need no padding."""
        yield from self.pack(0)
        left = [p for t in reversed(self.tiers) for p in reversed(self.waiting[t])]
        self.waiting = {t: [] for t in self.tiers}
        size, last, used = self.longest, None, 0
        n = sum(map(len, left))
        while n:
            while size > n:
                size //= 2
            pieces, gap = [], size
            while gap:
                piece = left.pop(0)
                if len(piece) > gap:
                    piece, rest = piece.cut(gap)
                    left.insert(0, rest)
                pieces.append(piece)
                gap -= len(piece)
            n -= size
            if last is None or used + size > self.step_tokens:
                last, used = self.first + self.groups, 0
                self.groups += 1
            used += size
            self.next += 1
            yield self.next - 1, size, last, pieces


def sum_below(waiting: dict[int, list[Piece]], tier: int, least: int) -> bool:
    """Whether the pieces of this and shorter tiers hold ``least`` tokens."""
    total = 0
    for t in sorted(waiting, reverse=True):
        if t <= tier:
            for p in waiting[t]:
                total += len(p)
                if total >= least:
                    return True
    return False


def _batch(windows) -> Iterator[pa.RecordBatch]:
    rows = [
        (p.doc, p.start, len(p), p.ids.tobytes(), p.total, number, size, group)
        for number, size, group, pieces in windows
        for p in pieces
    ]
    if not rows:
        return
    doc, start, length, ids, total, number, size, group = zip(*rows, strict=True)
    offset, at, last = [], 0, None
    for n, s in zip(length, number, strict=True):
        at = at if s == last else 0
        offset.append(at)
        at, last = at + n, s
    columns = [doc, start, length, ids, total, number, offset, size, group]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
    names = [x.split()[0] for x in PIECE.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian uint32), ``doc_tokens,
    sequence_id, offset, window, step_group``.

    A document is its token ids and ``end_id``. It gives as many of the longest
    windows as it fills; the rest is routed to the smallest tier that holds it.
    From the longest tier down, a window takes a waiting piece, its gap takes the
    largest pieces of shorter tiers that fit, and the last of them is cut to the
    gap. Every window is full, so there is no padding; the tail of a partition is
    cut into windows of falling powers of two. Step groups hold windows of one size
    and ``step_tokens`` tokens (the last ones of a partition less).

    Packing is done within each partition in one pass with bounded memory and no
    shuffle. Window numbers are unique: they begin at partition number * 2^32.
    NULL and empty texts give their end id alone; repeated rows are packed each;
    a NULL ``doc_id`` stays NULL; an empty table gives no rows. Other columns are
    not read.
    """
    sizes = sorted(tiers)
    if any(t & (t - 1) for t in sizes):
        raise ValueError("tiers are powers of two")

    def run(batches):
        encode = encoder(tokenizer_path).encode
        packer = Packer(sizes, step_tokens, TaskContext.get().partitionId() << 32)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, end in small_groups(texts):
                tokens, counts = encode(texts[begin:end])
                windows, at = [], 0
                for doc, n in zip(ids[begin:end], counts, strict=True):
                    windows += packer.add(doc, np.append(tokens[at : at + n], np.uint32(end_id)))
                    at += n
                windows += packer.pack(4 * sizes[-1])
                yield from _batch(windows)
        yield from _batch(packer.finish())

    return id_text(docs).mapInArrow(run, PIECE)
